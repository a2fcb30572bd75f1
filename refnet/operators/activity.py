"""Who did what where, in one pass over the log: the table that all stages of the network start from.

The raw log is read once. Push rows are de-duplicated as whole rows (their counts are a bag); of pull-request rows, which
feed sets alone, only the repository, the actor and the second stand, so that copies collapse before the shuffle and no other
column moves. What is left is added up by repository and actor:

* kind 1, pushes: how many, the first and the last;
* kind 2, pull requests: a row for each second (null for a time that doesn't parse).

The pull requests that a stage needs are then put into sorted arrays, one for each repository, actor and span of ``SPAN_DAYS``
days, so an array has at most one time for each second of a span (4.3 million), whatever an actor does.

With ``every`` all event types are de-duplicated as whole rows and the rest is counted too, as kind 0; then the sum of ``n``
is the size of the normalised log.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from refnet.functions.columns import parse_created_at
from refnet.operators.normalize import dedup_raw
from refnet.schema import PULL, PUSH, TIMESTAMP_TEXT_LENGTH

OTHER, PUSHES, PULLS = 0, 1, 2
SPAN_DAYS = 50


def _kind() -> Column:
    return F.when(F.col("Type") == PUSH, PUSHES).when(F.col("Type") == PULL, PULLS).otherwise(OTHER)


def _narrow(raw: DataFrame) -> DataFrame:
    """Push and pull-request rows; of the latter only what sets need."""
    push, rows = F.col("Type") == PUSH, raw.filter(F.col("Type").isin(PUSH, PULL))
    kept = {"repo_id", "actor_id", "type"}
    columns = []
    for name in raw.columns:
        own = F.col(f"`{name}`")
        if name.lower() == "created_at":
            own = F.when(push, own).otherwise(F.substring(own, 1, TIMESTAMP_TEXT_LENGTH))
        elif name.lower() not in kept:
            own = F.when(push, own)
        columns.append(own.alias(name))
    return rows.select(*columns)


def activity(raw: DataFrame, dedup_keys: Sequence[str] | None = None, every: bool = False) -> DataFrame:
    """(repo_id, actor_id, n, first, last, kind) from the raw log; nulls are kept. A pull request's time is its first and last."""
    rows = dedup_raw(raw, dedup_keys) if every or dedup_keys else dedup_raw(_narrow(raw))
    kinds = rows.select(_kind().alias("kind"), "repo_id", "actor_id", parse_created_at("created_at").alias("at"))
    if every:
        known = F.col("kind") != OTHER
        kinds = kinds.select("kind", *(F.when(known, F.col(c)).alias(c) for c in ("repo_id", "actor_id", "at")))
    else:
        kinds = kinds.filter(F.col("kind") != OTHER)
    second = F.when(F.col("kind") == PULLS, F.col("at")).alias("second")
    found = kinds.groupBy("kind", "repo_id", "actor_id", second).agg(F.count(F.lit(1)).alias("n"), F.min("at").alias("first"), F.max("at").alias("last"))
    return found.select("repo_id", "actor_id", "n", "first", "last", "kind")


def pushes(table: DataFrame) -> DataFrame:
    """As ``core.push_activity``: (repo_id, actor_id, NO_OF_PUSH_EVENT, min_d, max_d)."""
    own = table.filter(F.col("kind") == PUSHES)
    return own.select("repo_id", "actor_id", F.col("n").alias("NO_OF_PUSH_EVENT"), F.col("first").alias("min_d"), F.col("last").alias("max_d"))


def pull_pairs(table: DataFrame) -> DataFrame:
    """(repo_id, actor_id): who opened pull requests where; a set, nulls kept."""
    return table.filter(F.col("kind") == PULLS).select("repo_id", "actor_id").distinct()


def pull_rows(table: DataFrame) -> DataFrame:
    """(repo_id, actor_id, at): the distinct pull requests that can match a tenure (no null part)."""
    return table.filter(F.col("kind") == PULLS).select("repo_id", "actor_id", F.col("first").alias("at")).dropna()


def pull_spans(rows: DataFrame) -> DataFrame:
    """(pr_repo_id, actor_id, first, last, times, before) from :func:`pull_rows`: the sorted times of a span, and the last time
    of the span before, null in the first."""
    span = F.floor(F.datediff(F.col("at").cast("date"), F.lit("1970-01-01").cast("date")) / SPAN_DAYS).cast("int")
    spans = rows.groupBy("repo_id", "actor_id", span.alias("span")).agg(F.min("at").alias("first"), F.max("at").alias("last"), F.array_sort(F.collect_list("at")).alias("times"))
    order = Window.partitionBy("actor_id", "repo_id").orderBy("first")
    return spans.select(F.col("repo_id").alias("pr_repo_id"), "actor_id", "first", "last", "times", F.lag("last").over(order).alias("before"))


def first_from(times: Column, at: Column) -> Column:
    """The first of the sorted ``times`` that is not before ``at`` (null: none), by binary search."""
    low, high = F.lit(0), F.size(times)

    def step(s: Column, _: Column) -> Column:
        middle = F.floor((s["low"] + s["high"]) / 2).cast("int")
        later = F.get(times, middle) < at
        return F.when(s["low"] >= s["high"], s).otherwise(F.struct(F.when(later, middle + 1).otherwise(s["low"]).alias("low"), F.when(later, s["high"]).otherwise(middle).alias("high")))

    steps = F.sequence(F.lit(0), F.ceil(F.log2(F.size(times) + 1)).cast("int"))
    found = F.aggregate(steps, F.struct(low.alias("low"), high.alias("high")), step)
    return F.get(times, found["low"])
