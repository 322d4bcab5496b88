"""Comparable output columns: rounded doubles, text times, sorted arrays."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

TS_TEXT = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def ts_text(col: str | Column) -> Column:
    return F.date_format(_c(col), TS_TEXT)


def day_text(col: str | Column) -> Column:
    return F.date_format(_c(col), "yyyy-MM-dd")


def money(col: str | Column, digits: int = 2) -> Column:
    return F.round(_c(col).cast("double"), digits)


def sorted_text(col: str | Column, sep: str = ",") -> Column:
    return F.array_join(F.array_sort(_c(col)), sep)
