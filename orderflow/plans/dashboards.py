"""Dashboard datasets over the gold tables, and widget rollups.

``day`` / ``since`` are values passed in (never the clock); left as
None the datasets are all-time, as shipped.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Tile labels and the revenue-goal default.
GROSS_REVENUE_LABEL = "Gross Revenue Today"
ORDERS_LABEL = "Orders Today (HLL ±2 %)"
DEFAULT_GOAL = "250000"


def _on_day(df: DataFrame, col: str, day: str | dt.date | None) -> DataFrame:
    return df if day is None else df.filter(F.col(col) == F.lit(day).cast("date"))


def gross_revenue(brand_sales: DataFrame, day=None) -> DataFrame:
    return (_on_day(brand_sales, "day", day)
            .agg(F.sum("brand_revenue").alias("value"))
            .select("value", F.lit(GROSS_REVENUE_LABEL).alias("label")))


def order_count(header: DataFrame, day=None) -> DataFrame:
    return (_on_day(header, "order_day", day)
            .agg(F.count("order_id").alias("value"))
            .select("value", F.lit(ORDERS_LABEL).alias("label")))


def basket(header: DataFrame, day=None) -> DataFrame:
    return (_on_day(header, "order_day", day)
            .select("order_id", "total_qty", "order_revenue")
            .agg(F.round(F.avg("total_qty"), 2).alias("avg_basket_qty"),
                 F.round(F.avg("order_revenue"), 2).alias("avg_basket_total_price")))


def run_rate(brand_sales: DataFrame, goal: str = DEFAULT_GOAL, day=None) -> DataFrame:
    """Revenue, the goal parameter (STRING, as a named SQL parameter) and
    revenue / goal."""
    src = _on_day(brand_sales, "day", day)
    return src.sparkSession.sql(
        "SELECT SUM(brand_revenue) AS revenue, :goal_dollars AS goal, "
        "SUM(brand_revenue) / :goal_dollars AS pct FROM {src}",
        args={"goal_dollars": goal}, src=src)


def hourly_trend(location_sales: DataFrame, since=None) -> DataFrame:
    src = location_sales
    if since is not None:
        src = src.filter(F.col("hour_ts") >= F.date_trunc("day", F.lit(since).cast("timestamp")))
    return (src.groupBy("hour_ts", "location").agg(F.sum("revenue").alias("revenue"))
            .orderBy("hour_ts", "location"))


def widget(df: DataFrame, keys: list[str], measure: str | None = None,
           descending: bool = False) -> DataFrame:
    """A widget's query on its dataset.

    With a measure, the other fields become group keys and the measure
    is summed (column ``sum(<measure>)``); without one the fields pass
    through.  ``descending`` sorts by the measure, largest first.
    """
    if measure is None:
        return df.select(*keys)
    name = f"sum({measure})"
    out = df.groupBy(*keys).agg(F.sum(measure).alias(name))
    return out.orderBy(F.col(f"`{name}`").desc()) if descending else out
