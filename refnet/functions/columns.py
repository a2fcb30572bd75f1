"""Scalar column expressions used by the operators (survey rows F1-F4, B5, B10)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from refnet.schema import TIMESTAMP_TEXT_LENGTH, TIMESTAMP_TEXT_PATTERN


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_created_at(c: str | Column = "created_at") -> Column:
    """First 19 characters of the text, ``yyyy-MM-dd HH:mm:ss``, as a timestamp without zone.

    Drops a fraction of a second and a zone suffix such as `` UTC``. The log is in UTC throughout, and a type without zone
    compares and prints the same under any session zone, also within an hour that the session's zone skips. Text that does
    not parse becomes null instead of failing the job under ANSI mode.
    """
    head = F.substring(_col(c), 1, TIMESTAMP_TEXT_LENGTH)
    return F.when(head.rlike(TIMESTAMP_TEXT_PATTERN), head.try_cast("timestamp_ntz"))


def timestamp_text(c: str | Column) -> Column:
    """A zone-less timestamp as ``yyyy-MM-dd HH:mm:ss`` text (for exchange with other engines and CSV sinks)."""
    return F.substring(_col(c).cast("timestamp_ntz").cast("string"), 1, TIMESTAMP_TEXT_LENGTH)


def timestamp_key(c: str | Column = "created_at") -> Column:
    """First two space-separated tokens joined by ``_``: ``2016-01-15 18:39:47 UTC`` -> ``2016-01-15_18:39:47``.

    Null when the text has fewer than two tokens.
    """
    parts = F.split(_col(c), " ")
    return F.when(F.size(parts) >= 2, F.concat_ws("_", parts.getItem(0), parts.getItem(1)))


def safe_ratio(numerator: str | Column, denominator: str | Column) -> Column:
    """Floating division that yields null (not an error) for a zero or null denominator."""
    return F.try_divide(_col(numerator).cast("double"), _col(denominator).cast("double"))


def event_type_is(event: str, c: str | Column = "Type") -> Column:
    """``Type == event``; the column is found case-insensitively under the default analyser settings."""
    return _col(c) == F.lit(event)


def case_label(
    cases: Sequence[tuple[Column, Column | str | int]], otherwise: Column | str | int | None = None
) -> Column:
    """``CASE WHEN c1 THEN v1 WHEN c2 THEN v2 ... ELSE otherwise END`` from (condition, value) pairs."""
    if not cases:
        raise ValueError("case_label needs at least one (condition, value) pair")
    lit = lambda v: v if isinstance(v, Column) else F.lit(v)
    expr = F.when(cases[0][0], lit(cases[0][1]))
    for cond, value in cases[1:]:
        expr = expr.when(cond, lit(value))
    return expr.otherwise(lit(otherwise)) if otherwise is not None else expr
