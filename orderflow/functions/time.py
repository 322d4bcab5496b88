"""Time parsing and duration helpers (built-in expressions only)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_ts(col: str | Column, strict: bool = False) -> Column:
    """Event-time text -> TIMESTAMP.

    Tolerant by default: bad text gives NULL (``try_to_timestamp``).
    ``strict=True`` uses ``to_timestamp``, which fails the job on bad
    text under ANSI mode.
    """
    c = F.col(col) if isinstance(col, str) else col
    return F.to_timestamp(c) if strict else F.try_to_timestamp(c)


def minutes_between(start: str | Column, end: str | Column) -> Column:
    """(unix_timestamp(end) - unix_timestamp(start)) / 60, whole seconds."""
    s = F.col(start) if isinstance(start, str) else start
    e = F.col(end) if isinstance(end, str) else end
    return (F.unix_timestamp(e) - F.unix_timestamp(s)) / 60
