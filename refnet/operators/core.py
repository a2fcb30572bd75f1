"""Core contributors and push tenure (survey G2-G4, D1-D3, B6, C1, C2).

A core contributor of a repository is an actor whose push count there is at least the repository's mean pushes per
distinct actor: ``n(repo, actor) >= count(*) / count(distinct actor_id)`` over the repository's push events.
Null actors count in the numerator only, so they raise the bar; a null actor may pass as its own group. A repository
whose pushers are all null has no mean (null, not an error) and no core contributor.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from refnet.functions.columns import safe_ratio
from refnet.operators.normalize import push_events
from refnet.operators.relational import lookup_filter
from refnet.plans.skew import balanced_join

N = "NO_OF_PUSH_EVENT"
AVG = "AVG_PUSH_EVENT"
BUCKETS = 1024  # of a repository's actors, in the window form


def push_activity(log: DataFrame) -> DataFrame:
    """(repo_id, actor_id, NO_OF_PUSH_EVENT, min_d, max_d): count, first and last push per (repo, actor).

    One hash aggregate with partial aggregation serves the counts (D1) and the tenure (D3), so no later join of the two is
    needed (C2).
    """
    return push_events(log).groupBy("repo_id", "actor_id").agg(
        F.count(F.lit(1)).alias(N),
        F.min("created_at").alias("min_d"),
        F.max("created_at").alias("max_d"),
    )


def push_counts(log: DataFrame) -> DataFrame:
    """(actor_id, repo_id, NO_OF_PUSH_EVENT)."""
    return push_events(log).groupBy("actor_id", "repo_id").agg(F.count(F.lit(1)).alias(N))


def push_tenure(log: DataFrame) -> DataFrame:
    """(repo_id, actor_id, min_d, max_d) for every pusher, null actors included."""
    return push_activity(log).select("repo_id", "actor_id", "min_d", "max_d")


def repo_means(activity: DataFrame) -> DataFrame:
    """(repo_id, AVG_PUSH_EVENT) from :func:`push_activity`: each (repo, actor) is one row there, so counting the non-null
    actors equals the distinct count."""
    return activity.groupBy("repo_id").agg(safe_ratio(F.sum(N), F.count("actor_id")).alias(AVG))


def avg_push(log: DataFrame) -> DataFrame:
    """(repo_id, AVG_PUSH_EVENT) = pushes / distinct pushers."""
    return repo_means(push_activity(log))


def core_of(activity: DataFrame, hot: DataFrame | None = None) -> DataFrame:
    """The rows of :func:`push_activity` that meet their repository's mean.

    The mean has one row per repository, so a repository with very many actors is dealt over several tasks and the mean
    copied to them.
    """
    means = repo_means(activity).filter(F.col("repo_id").isNotNull() & F.col(AVG).isNotNull())
    met = balanced_join(activity, means, ["repo_id"], "left", left_salt=["repo_id", "actor_id"], hot=hot)
    return met.filter(F.col(N) >= F.col(AVG)).drop(AVG)


def core_by_window(activity: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """As :func:`core_of`, with the mean from a window. A repository's actors are summed by bucket first, so the window sees
    ``buckets`` rows of a repository at most, and each bucket is joined with its own copy of the mean."""
    bucket = F.pmod(F.xxhash64("actor_id"), F.lit(buckets))
    sums = activity.groupBy("repo_id", bucket.alias("_bucket")).agg(F.sum(N).alias("_n"), F.count("actor_id").alias("_actors"))
    repo = Window.partitionBy("repo_id")
    means = sums.select("repo_id", "_bucket", safe_ratio(F.sum("_n").over(repo), F.sum("_actors").over(repo)).alias(AVG))
    met = activity.withColumn("_bucket", bucket).join(means, ["repo_id", "_bucket"])
    return met.filter(F.col(N) >= F.col(AVG)).drop(AVG, "_bucket")


def core_contributors(log: DataFrame) -> DataFrame:
    """(repo_id, actor_id): the core-contributor set; unique already, after the aggregate."""
    return core_of(push_activity(log)).select("repo_id", "actor_id")


def core_by_outer_join(log: DataFrame) -> DataFrame:
    """The core-contributor set by the general outer join and filter (survey C1)."""
    activity = push_activity(log).select("repo_id", "actor_id", N)
    return lookup_filter(activity, repo_means(activity), "repo_id", F.col(N) >= F.col(AVG)).select("repo_id", "actor_id")


def tenure_of(core: DataFrame) -> DataFrame:
    """(focal_repo_id, actor_id, min_d, max_d) of the core rows with a non-null actor; the tenure rides along in the
    aggregate that decides who is core."""
    return core.filter(F.col("actor_id").isNotNull()).select(F.col("repo_id").alias("focal_repo_id"), "actor_id", "min_d", "max_d")


def core_tenure(log: DataFrame) -> DataFrame:
    return tenure_of(core_of(push_activity(log)))
