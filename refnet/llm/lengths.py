"""Exact token-length histograms.

Documents are encoded whole and counted by encoded length, first within each task, so that a row for each length and task
is shuffled and no text. Suffix sums over the histogram, in two levels (blocks of neighbouring lengths, then within each
block), answer for every context limit how many documents are longer and how many tokens are left after truncation.

Defined results: null and empty texts have length 0; repeated rows count each; an empty table has an empty histogram.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from refnet.llm.common import pieces, stored, utf8
from refnet.llm.tokens import TOKENIZER, Encoder, tokenizer_path

BLOCK = 1024


def histogram(docs: DataFrame, tokenizer: str = TOKENIZER) -> DataFrame:
    """(length, n_docs)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, total = Encoder.of(tokenizer_path(tokenizer)), Counter()
        for part in pieces(batches, "_utf8", 1 << 20):
            _, at = encoder.encode(part.column("_utf8"))
            total.update(np.diff(at).tolist())
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int64()), pa.array(list(total.values()), pa.int64())], names=["length", "n"])

    found = docs.select(utf8("text").alias("_utf8")).mapInArrow(count, "length long, n long").groupBy("length").agg(F.sum("n").alias("n_docs"))
    return stored(found, "histogram")  # texts are encoded once, whatever is asked of it


def suffix_sums(hist: DataFrame) -> DataFrame:
    """For every length that occurs, as a context limit: (length, n_docs, n_tokens, docs_over, tokens_over, total_docs,
    total_tokens, truncated_tokens): documents longer than it, their tokens, and all tokens after truncation to it."""
    hist = hist.withColumn("n_tokens", F.col("length") * F.col("n_docs")).withColumn("block", F.floor(F.col("length") / BLOCK))
    blocks = hist.groupBy("block").agg(F.sum("n_docs").alias("docs"), F.sum("n_tokens").alias("tokens"))
    # One row for each BLOCK lengths: few enough for one task.
    after, whole = Window.orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    blocks = blocks.select(
        F.col("block").alias("_block"),
        F.coalesce(F.sum("docs").over(after), F.lit(0)).alias("docs_after"),
        F.coalesce(F.sum("tokens").over(after), F.lit(0)).alias("tokens_after"),
        F.sum("docs").over(whole).alias("total_docs"),
        F.sum("tokens").over(whole).alias("total_tokens"),
    )
    longer = Window.partitionBy("block").orderBy(F.desc("length")).rowsBetween(Window.unboundedPreceding, -1)
    over = hist.join(blocks, F.col("block") == F.col("_block")).select(
        "length",
        "n_docs",
        "n_tokens",
        (F.coalesce(F.sum("n_docs").over(longer), F.lit(0)) + F.col("docs_after")).alias("docs_over"),
        (F.coalesce(F.sum("n_tokens").over(longer), F.lit(0)) + F.col("tokens_after")).alias("tokens_over"),
        "total_docs",
        "total_tokens",
    )
    return over.withColumn("truncated_tokens", F.col("total_tokens") - F.col("tokens_over") + F.col("length") * F.col("docs_over"))


def truncated_totals(sums: DataFrame, limits: list[int]) -> DataFrame:
    """(context, total_docs, total_tokens, docs_over, truncated_tokens) for any limits: a limit has the suffix sums of the
    longest length within it."""
    asked = sums.sparkSession.createDataFrame([(int(c),) for c in sorted(set(limits))], "context long")
    all_of = sums.agg(F.max("total_docs").alias("total_docs"), F.max("total_tokens").alias("total_tokens"))
    parts = [F.max(F.when(F.col("length") <= c, F.struct("length", "docs_over", "tokens_over"))).alias(f"c{c}") for c in sorted(set(limits))]
    row = sums.agg(*parts) if parts else sums.agg(F.lit(None).alias("none"))
    at = F.coalesce(*(F.when(F.col("context") == c, F.col(f"c{c}")) for c in sorted(set(limits)))) if parts else F.lit(None)
    known = asked.join(F.broadcast(row)).join(F.broadcast(all_of)).withColumn("at", at)
    docs_over, tokens_over = F.coalesce(F.col("at.docs_over"), F.col("total_docs")), F.coalesce(F.col("at.tokens_over"), F.col("total_tokens"))
    return known.select(
        "context", "total_docs", "total_tokens", docs_over.alias("docs_over"), (F.col("total_tokens") - tokens_over + F.col("context") * docs_over).alias("truncated_tokens")
    )


def quantiles(sums: DataFrame, shares: list[float]) -> DataFrame:
    """(share, length): the smallest length that at least that share of the documents doesn't exceed."""
    covered = F.col("total_docs") - F.col("docs_over")
    parts = [F.min(F.when(covered >= F.ceil(F.lit(float(q)) * F.col("total_docs")), F.col("length"))) for q in shares]
    return sums.agg(F.array(*parts).alias("v")).select(F.explode(F.arrays_zip(F.array(*(F.lit(float(q)) for q in shares)).alias("share"), F.col("v").alias("length"))).alias("r")).select("r.share", "r.length")
