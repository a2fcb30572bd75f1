"""Column expressions; all built-in Spark functions, so they stay inside whole-stage codegen."""

from refnet.functions.columns import (  # noqa: F401
    case_label,
    event_type_is,
    parse_created_at,
    safe_ratio,
    timestamp_key,
    timestamp_text,
)

__all__ = ["case_label", "event_type_is", "parse_created_at", "safe_ratio", "timestamp_key", "timestamp_text"]
