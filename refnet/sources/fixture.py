"""The activity log derived from the ``events`` table of the test data.

Mapping (fixed, so that an independent SQL engine derives the very same rows):

* ``repo_id``    = (user_id div 3) * 40 + (props.k mod 40)
* ``repo_name``  = ``org/repo_<repo_id>``
* ``actor_id``   = user_id
* ``Type``       = ``click`` -> PushEvent, ``purchase`` -> PullRequestEvent, other types unchanged
* ``created_at`` = ``yyyy-MM-dd HH:mm:ss UTC`` text of ``ts``
* ``event_id``   kept, so that only true copies are duplicates
* every event whose id ends in 0 appears twice, so that de-duplication has work to do

``null_actor_every`` (tests only) blanks the actor of every user whose id is a multiple of it.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from refnet.schema import PULL, PUSH

# Fixed values of the mapping above.
REPOS_PER_USER_GROUP = 40
USERS_PER_GROUP = 3
COPY_EVERY = 10


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def activity_log_from_events(events: DataFrame, null_actor_every: int | None = None) -> DataFrame:
    """Raw activity log (event_id, repo_id, repo_name, actor_id, Type, created_at text) from ``events``."""
    k = F.get_json_object("props", "$.k").cast("bigint")
    repo_id = F.expr(f"user_id div {USERS_PER_GROUP}") * REPOS_PER_USER_GROUP + k % REPOS_PER_USER_GROUP
    actor = F.col("user_id")
    if null_actor_every:
        actor = F.when(F.col("user_id") % null_actor_every != 0, F.col("user_id"))
    event_type = (
        F.when(F.col("event_type") == "click", F.lit(PUSH))
        .when(F.col("event_type") == "purchase", F.lit(PULL))
        .otherwise(F.col("event_type"))
    )
    base = events.select(
        F.col("event_id"),
        repo_id.alias("repo_id"),
        actor.cast("bigint").alias("actor_id"),
        event_type.alias("Type"),
        F.concat(F.substring(F.col("ts").cast("timestamp_ntz").cast("string"), 1, 19), F.lit(" UTC")).alias("created_at"),
    ).withColumn("repo_name", F.concat(F.lit("org/repo_"), F.col("repo_id").cast("string")))
    base = base.select("event_id", "repo_id", "repo_name", "actor_id", "Type", "created_at")
    # One scan: each row once or twice.
    times = F.when(F.col("event_id") % COPY_EVERY == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return base.withColumn("_copy", F.explode(times)).drop("_copy")


def raw_log(spark: SparkSession, sf_dir: str, null_actor_every: int | None = None) -> DataFrame:
    """Raw activity log for one test-data directory."""
    return activity_log_from_events(read_table(spark, sf_dir, "events"), null_actor_every)
