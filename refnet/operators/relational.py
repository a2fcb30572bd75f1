"""General relational operators (survey C1, B9/C9, C10, B10, A10)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from refnet.functions.columns import case_label
from refnet.plans.skew import balanced_join


def _on(on: str | Sequence[str]) -> list[str]:
    return [on] if isinstance(on, str) else list(on)


def left_anti(left: DataFrame, right: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Rows of ``left`` with no match in ``right`` on ``on`` (``NOT EXISTS``); a null key never matches."""
    return left.join(right.select(*_on(on)).distinct(), on=_on(on), how="left_anti")


def left_join_filter(left: DataFrame, right: DataFrame, on: str | Sequence[str], keep: Column) -> DataFrame:
    """Left outer join, then a filter that may look at the right side (survey C1)."""
    return left.join(right, on=_on(on), how="left").filter(keep)


def lookup_filter(left: DataFrame, right: DataFrame, on: str | Sequence[str], keep: Column) -> DataFrame:
    """:func:`left_join_filter` with a right side of unique keys and other column names: a key with very many left rows is
    dealt over several tasks."""
    return balanced_join(left, right, _on(on), "left").filter(keep)


def unmatched(left: DataFrame, right: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Rows of ``left`` whose outer-join partner is null (survey B9, C9). The right side is reduced to its distinct keys, so
    each left row meets one right row at most, and a key with very many left rows is dealt over several tasks."""
    keys = right.select(*_on(on)).distinct().withColumn("_matched", F.lit(True))
    return balanced_join(left, keys, _on(on), "left").filter(F.col("_matched").isNull()).select(*left.columns)


def with_case_label(df: DataFrame, name: str, cases: Sequence[tuple[Column, Column | str | int]], otherwise=None) -> DataFrame:
    """Adds ``name`` = CASE WHEN ... END (survey B10)."""
    return df.withColumn(name, case_label(cases, otherwise))


def to_width(df: DataFrame, n: int, *keys: str) -> DataFrame:
    """``df`` in ``n`` partitions, dealt by ``keys`` if given (survey A10)."""
    return df.repartition(n, *keys)
