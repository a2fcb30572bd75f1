"""Log normalisation (survey G1, B1, B4, D7, F1, F2) and the event filters (B5)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from refnet.functions.columns import event_type_is, parse_created_at
from refnet.schema import PULL, PUSH


def dedup_raw(raw: DataFrame, keys: Sequence[str] | None = None) -> DataFrame:
    """Full-row de-duplication of the raw log (or on ``keys`` when an id is known to identify an event).

    Hash aggregation with map-side partial aggregation: exact copies collapse before the shuffle, so a row copied
    many times costs no more than one.
    """
    return raw.dropDuplicates(list(keys)) if keys else raw.dropDuplicates()


def normalize_log(raw: DataFrame, dedup: bool = True, dedup_keys: Sequence[str] | None = None) -> DataFrame:
    """(repo_id, repo_name, actor_id, Type, created_at timestamp) from the raw log.

    De-duplication runs on the *raw* rows, before the projection: rows that agree on the five kept columns but
    differ elsewhere (or in the fraction of a second) stay separate and are counted separately (a bag).

    ``dedup=False`` skips it; use that only for consumers that are set-valued anyway (pull-request pairs and focal
    references), where a duplicate cannot change the result.
    """
    rows = dedup_raw(raw, dedup_keys) if dedup else raw
    return rows.select(
        F.col("repo_id"),
        F.col("repo_name"),
        F.col("actor_id"),
        F.col("Type").alias("Type"),
        parse_created_at("created_at").alias("created_at"),
    )


def filter_event(log: DataFrame, event: str) -> DataFrame:
    """Rows of one event type; Catalyst pushes the predicate into the scan and below the de-duplication."""
    return log.filter(event_type_is(event))


def push_events(log: DataFrame) -> DataFrame:
    return filter_event(log, PUSH)


def pull_events(log: DataFrame) -> DataFrame:
    return filter_event(log, PULL)
