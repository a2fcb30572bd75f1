"""Sources and sinks: delimited/columnar readers, the dataset writer, and the log derived from ``events``."""

from refnet.sources.delimited import (  # noqa: F401
    read_activity_log,
    read_delimited,
    read_drifting_log,
    read_edges,
    read_pipe_delimited,
    read_with_schema,
    write_dataset,
)
from refnet.sources.fixture import activity_log_from_events, raw_log, read_table  # noqa: F401

__all__ = [
    "activity_log_from_events",
    "raw_log",
    "read_activity_log",
    "read_delimited",
    "read_drifting_log",
    "read_edges",
    "read_pipe_delimited",
    "read_table",
    "read_with_schema",
    "write_dataset",
]
