"""Scalar helpers and SQL functions."""

from .time import minutes_between, parse_ts
from .output import day_text, money, sorted_text, ts_text

__all__ = ["parse_ts", "minutes_between", "ts_text", "day_text", "money", "sorted_text"]
