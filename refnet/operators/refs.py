"""Focal references (survey G5-G7, C3, B7, B8, E2).

Repository F references repository D when a core contributor of F opened a pull-request event in D (D != F) at a
time within their push tenure in F (both ends inclusive). The result is a set of (F, D) pairs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from refnet.operators.activity import first_from
from refnet.operators.core import core_tenure
from refnet.operators.normalize import pull_events
from refnet.plans.skew import balanced_join


def pull_times(log: DataFrame) -> DataFrame:
    """(pr_repo_id, actor_id, pr_at): the distinct pull-request events that can match a tenure (no null part)."""
    events = pull_events(log).select(F.col("repo_id").alias("pr_repo_id"), "actor_id", F.col("created_at").alias("pr_at"))
    return events.dropna().distinct()


def focal_refs_from(tenure: DataFrame, pulls: DataFrame, hot: DataFrame | None = None) -> DataFrame:
    """(focal_repo_id, repo_id) from a core tenure table and :func:`pull_times`.

    Equi-join on ``actor_id`` with ``focal != repo`` and the closed time range as the rest of the condition; the actor
    equality already deals out the work, so no range binning. Hot actors are dealt by pairs of both sides.
    """

    def within():
        return (F.col("focal_repo_id") != F.col("pr_repo_id")) & F.col("pr_at").between(F.col("min_d"), F.col("max_d"))

    joined = balanced_join(pulls, tenure, ["actor_id"], condition=within, right_salt=["focal_repo_id", "actor_id"], hot=hot)
    return joined.select("focal_repo_id", F.col("pr_repo_id").alias("repo_id")).distinct()


def tenure_spans(tenure: DataFrame, spans: DataFrame, hot: DataFrame | None = None) -> DataFrame:
    """(focal_repo_id, repo_id, actor_id, first, times, min_d, max_d): each core tenure with the one span of each other
    repository in which its actor's first pull request from the tenure's start on may lie; from a core tenure table and
    ``activity.pull_spans``.

    An actor's tenures meet the sorted times of each repository, not the single events, and the span is known by its bounds
    (the start is after the span before, and up to its own last). So one row at most for a tenure and repository leaves the
    join, however many events there are, and the join compares four times alone, in generated code.
    """

    def here():
        after = F.col("before").isNull() | (F.col("before") < F.col("min_d"))
        return (F.col("focal_repo_id") != F.col("pr_repo_id")) & (F.col("min_d") <= F.col("last")) & after & (F.col("first") <= F.col("max_d"))

    joined = balanced_join(spans, tenure, ["actor_id"], condition=here, left_salt=["pr_repo_id", "first"], right_salt=["focal_repo_id"], hot=hot)
    return joined.select("focal_repo_id", F.col("pr_repo_id").alias("repo_id"), "actor_id", "first", "times", "min_d", "max_d")


def focal_refs_by_times(tenure: DataFrame, spans: DataFrame, hot: DataFrame | None = None) -> DataFrame:
    """(focal_repo_id, repo_id): the focal-reference set. In the span of :func:`tenure_spans` the first time from the tenure's
    start on is searched, and the pair counts if that is within the tenure. The search is part of the aggregate that makes
    the pairs a set, so it stays out of the join."""
    start = F.when(F.col("first") >= F.col("min_d"), F.col("first")).otherwise(first_from(F.col("times"), F.col("min_d")))
    pairs = tenure_spans(tenure, spans, hot).groupBy("focal_repo_id", "repo_id").agg(F.bool_or(start <= F.col("max_d")).alias("within"))
    return pairs.filter("within").select("focal_repo_id", "repo_id")


def focal_refs(log: DataFrame, pull_log: DataFrame | None = None) -> DataFrame:
    """(focal_repo_id, repo_id): the focal-reference set. ``pull_log`` may be the log without de-duplication."""
    return focal_refs_from(core_tenure(log), pull_times(log if pull_log is None else pull_log))


def focal_edges(refs: DataFrame) -> DataFrame:
    """(focal_repo_id, source_repo, destination_repo_id): ``source_repo`` repeats the focal repository."""
    return refs.select(
        "focal_repo_id",
        F.col("focal_repo_id").alias("source_repo"),
        F.col("repo_id").alias("destination_repo_id"),
    )


def focal_counts(refs: DataFrame) -> DataFrame:
    """(focal_repo_id, count_focal_repo_id): references per focal repository."""
    return refs.groupBy("focal_repo_id").agg(F.count(F.lit(1)).alias("count_focal_repo_id"))


def top_n(df: DataFrame, n: int, order: list) -> DataFrame:
    """Deterministic preview: the first ``n`` rows under a total order (TakeOrderedAndProject, no global sort)."""
    return df.orderBy(*order).limit(n)


def top_focal(counts: DataFrame, n: int = 20) -> DataFrame:
    """Focal repositories with the most references, ties broken by id."""
    return top_n(counts, n, [F.desc("count_focal_repo_id"), F.asc("focal_repo_id")])
