"""Mergeable forms of the gold tables.

A rollup keeps partial aggregates that can be merged: sums, counts, sets
and HyperLogLog sketches.  ``partial`` aggregates item rows, ``merge``
combines partial rows of any number of loads, ``final`` gives the table's
columns.  Partial rows of one day add up to those of a month without
reading an item again.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Sketch size (log2 of its registers) and the relative standard error it has.
SKETCH_LOG_K = 12
SKETCH_RSD = 1.04 / 2 ** (SKETCH_LOG_K / 2)


def _merge_sets(c: str) -> Column:
    return F.array_distinct(F.flatten(F.collect_list(c)))


# kind -> (partial aggregate of a source column, merge of partial rows, final value)
KINDS = {
    "sum": (F.sum, F.sum, F.col),
    "count": (F.count, F.sum, F.col),
    "set": (F.collect_set, _merge_sets, F.col),
    "distinct": (lambda c: F.hll_sketch_agg(c, F.lit(SKETCH_LOG_K)), F.hll_union_agg, F.hll_sketch_estimate),
}


@dataclass(frozen=True)
class Rollup:
    """Keys (name -> expression over item rows), the day key that tables
    are partitioned by, and measures (name, kind, source column)."""

    name: str
    keys: tuple[tuple[str, Column], ...]
    day: str
    measures: tuple[tuple[str, str, str], ...]

    def key_names(self) -> list[str]:
        return [k for k, _ in self.keys]

    def partial(self, items: DataFrame) -> DataFrame:
        return items.groupBy(*[e.alias(k) for k, e in self.keys]).agg(
            *[KINDS[kind][0](src).alias(m) for m, kind, src in self.measures])

    def merge(self, parts: DataFrame, *by: Column) -> DataFrame:
        """Partial rows with equal keys become one; ``by`` replaces the keys."""
        return parts.groupBy(*(by or self.key_names())).agg(
            *[KINDS[kind][1](m).alias(m) for m, kind, _ in self.measures])

    def final(self, parts: DataFrame) -> DataFrame:
        own = {m: KINDS[kind][2](m).alias(m) for m, kind, _ in self.measures}
        return parts.select(*[own.get(c, F.col(c)) for c in parts.columns])


def _cols(*names: str) -> tuple[tuple[str, Column], ...]:
    return tuple((n, F.col(n)) for n in names)


def order_header() -> Rollup:
    return Rollup("order_header", _cols("order_id", "gk_id", "location", "order_day"), "order_day", (
        ("order_revenue", "sum", "extended_price"), ("total_qty", "sum", "qty"),
        ("total_items", "count", "item_id"), ("brands_in_order", "set", "brand_id")))


def item_sales_day() -> Rollup:
    return Rollup("item_sales_day", (*_cols("item_id", "menu_id", "category_id", "brand_id"),
                                     ("day", F.col("order_day"))), "day", (
        ("units_sold", "sum", "qty"), ("gross_revenue", "sum", "extended_price")))


def brand_sales_day() -> Rollup:
    return Rollup("brand_sales_day", (*_cols("brand_id"), ("day", F.col("order_day"))), "day", (
        ("orders", "distinct", "order_id"), ("items_sold", "sum", "qty"),
        ("brand_revenue", "sum", "extended_price")))


def location_sales_hourly() -> Rollup:
    return Rollup("location_sales_hourly", (
        *_cols("location"), ("hour_ts", F.date_trunc("hour", "order_ts")), ("day", F.to_date("order_ts"))), "day", (
        ("orders", "distinct", "order_id"), ("revenue", "sum", "extended_price")))


def all_rollups() -> dict[str, Rollup]:
    return {r.name: r for r in (order_header(), item_sales_day(), brand_sales_day(), location_sales_hourly())}


def orders_by(parts: DataFrame, *by: Column) -> DataFrame:
    """Distinct orders of any grouping of a partial table with an
    ``orders`` sketch: per month, over all brands, over everything.

    Distinct counts of days do not add up; their sketches do.  The
    estimate has the relative standard error ``SKETCH_RSD``.
    """
    return parts.groupBy(*by).agg(F.hll_sketch_estimate(F.hll_union_agg("orders")).alias("orders"))
