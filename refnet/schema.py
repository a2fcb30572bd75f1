"""Column names, event types and schemas of the activity log and of the edge tables."""

from __future__ import annotations

from pyspark.sql import types as T

# Event types and timestamp layout that the input log uses.
PUSH = "PushEvent"
PULL = "PullRequestEvent"
TIMESTAMP_TEXT_PATTERN = r"^\d{4}-\d\d-\d\d \d\d:\d\d:\d\d$"  # created_at looks like "2016-01-15 18:39:47 UTC"
TIMESTAMP_TEXT_LENGTH = 19  # characters up to the seconds; the zone suffix is dropped

# Columns of the raw log that stages name. ``created_at`` stays text until it is parsed without a zone.
RAW_LOG_SCHEMA = T.StructType(
    [
        T.StructField("repo_id", T.LongType()),
        T.StructField("repo_name", T.StringType()),
        T.StructField("actor_id", T.LongType()),
        T.StructField("Type", T.StringType()),
        T.StructField("created_at", T.StringType()),
    ]
)

CORE_SCHEMA = T.StructType([T.StructField("cc_repo_id", T.LongType()), T.StructField("actor_id", T.LongType())])

FOCAL_EDGE_SCHEMA = T.StructType(
    [
        T.StructField("focal_repo_id", T.LongType()),
        T.StructField("source_repo", T.LongType()),
        T.StructField("destination_repo_id", T.LongType()),
    ]
)
