"""Rows that can join are kept before they are shuffled.

:func:`reduced` is a semi-join behind a Bloom filter made at run time: each key sets one bit of a hash, sixteen times as many
bits as keys, and the words that have a bit (``most_bits / 64`` rows at most, so the broadcast is bounded whatever the data) go
to every task. About one in seventeen other rows passes, and the exact semi-join takes these out. With more keys than an
eighth of ``most_bits`` the filter would let too much through; then the exact semi-join is all there is. Keys whose counted
number stays below Spark's own broadcast threshold are sent whole instead, which is the exact filter at once.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from refnet.plans.skew import balanced_join

MOST_BITS = 1 << 26
KEY_BYTES = 32  # a key and a hash table's overhead


def _place(key: str, bits: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(bits))


def _bit(place: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), place.bitwiseAND(F.lit(63).cast("long")).cast("int"))


def bloom_words(keys: DataFrame, key: str, bits: int) -> DataFrame:
    """(_word, _bits): the words of a filter of ``bits`` bits that have any."""
    place = keys.select(_place(key, bits).alias("_place"))
    return place.groupBy(F.shiftright("_place", 6).alias("_word")).agg(F.bit_or(_bit(F.col("_place"))).alias("_bits"))


def may_hold(df: DataFrame, words: DataFrame, key: str, bits: int) -> DataFrame:
    """The rows of ``df`` whose key the filter holds, and some others."""
    place = _place(key, bits)
    met = df.withColumn("_at", F.shiftright(place, 6)).join(F.broadcast(words), F.col("_at") == F.col("_word"))
    return met.filter(F.col("_bits").bitwiseAND(_bit(place)) != 0).drop("_at", "_word", "_bits")


def reduced(df: DataFrame, keys: DataFrame, key: str, n: int, salt: list[str], hot: Callable[[], DataFrame] | None = None, most_bits: int = MOST_BITS) -> DataFrame:
    """The rows of ``df`` whose ``key`` is among ``keys``, exactly; ``keys`` are distinct and ``n`` at most. ``hot`` gives the
    list of ``df``'s hot keys, if it is needed."""
    if n * KEY_BYTES <= df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold():
        return df.join(F.broadcast(keys), key, "left_semi")
    if 8 * n <= most_bits:
        bits = 1 << max(6, (16 * n - 1).bit_length())
        df = may_hold(df, bloom_words(keys, key, bits), key, bits)
    return balanced_join(df, keys, [key], "left_semi", left_salt=salt, hot=hot and hot())
