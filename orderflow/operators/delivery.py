"""Delivery timing: per-order times, durations and location percentiles."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.time import minutes_between, parse_ts
from ..schemas import CREATED_BODY
from .joins import broadcast_if_small

QUANTILES = (0.50, 0.75, 0.99)


def order_rollup(events: DataFrame) -> DataFrame:
    """Everything the delivery and refund jobs need per order, in one pass.

    One hash aggregation by (order_id, location): created and delivered
    times (conditional max), first and last event time, a delivered flag,
    and revenue summed from the items of the ``order_created`` bodies
    (no explode; equal to the order header's revenue).  Percentiles,
    durations and decisions all derive from this one frame, so the event
    log is scanned and shuffled once.
    """
    ts = parse_ts("ts")
    created = F.col("event_type") == "order_created"
    items = F.from_json("body", CREATED_BODY).getField("items")
    revenue = F.aggregate(items, F.lit(0.0),
                          lambda acc, x: acc + F.coalesce(x["price"] * x["qty"], F.lit(0.0)))
    return events.groupBy("order_id", "location").agg(
        F.max(F.when(created, ts)).alias("order_created_time"),
        F.max(F.when(F.col("event_type") == "delivered", ts)).alias("delivered_time"),
        F.min(ts).alias("first_ts"), F.max(ts).alias("last_ts"),
        F.max((F.col("event_type") == "delivered").cast("int")).alias("delivered"),
        F.sum(F.when(created, revenue)).alias("order_revenue"))


def percentiles_from(times: DataFrame, approx: bool = False, accuracy: int = 10000) -> DataFrame:
    """P50 / P75 / P99 per location from per-order created/delivered times."""
    t = (times.filter(F.col("order_created_time").isNotNull() & F.col("delivered_time").isNotNull())
         .select("location", minutes_between("order_created_time", "delivered_time")
                 .alias("total_order_time_minutes")))
    x = F.col("total_order_time_minutes")
    qs = F.array(*[F.lit(q) for q in QUANTILES])
    agg = (F.percentile_approx(x, qs, accuracy) if approx else F.percentile(x, qs)).alias("p")
    return t.groupBy("location").agg(agg).select(
        "location", *[F.col("p")[i].cast("double").alias(n) for i, n in enumerate(["P50", "P75", "P99"])])


def order_times(events: DataFrame) -> DataFrame:
    """Created and delivered time per (order, location): conditional max,
    one hash aggregation instead of a self-join."""
    ts = parse_ts("ts")
    return (events.groupBy("order_id", "location")
            .agg(F.max(F.when(F.col("event_type") == "order_created", ts))
                 .alias("order_created_time"),
                 F.max(F.when(F.col("event_type") == "delivered", ts))
                 .alias("delivered_time")))


def delivery_percentiles(events: DataFrame, approx: bool = False,
                         accuracy: int = 10000) -> DataFrame:
    """P50 / P75 / P99 of created -> delivered minutes per location.

    Exact by default (``percentile``, linear interpolation).  Its buffer
    is a value -> count map merged across tasks; durations are whole
    seconds / 60, so the map is bounded by the spread of durations, not
    by the number of orders, and a hot location stays cheap.
    ``approx=True`` uses ``percentile_approx`` (returns existing values).
    """
    return percentiles_from(order_times(events), approx, accuracy)


def order_durations(events: DataFrame) -> DataFrame:
    """First and last event time per order, and the minutes between
    (any event type; also for undelivered orders)."""
    ts = parse_ts("ts")
    t = events.groupBy("order_id").agg(F.min(ts).alias("creation_time"),
                                       F.max(ts).alias("delivery_time"))
    secs = F.unix_timestamp("delivery_time") - F.unix_timestamp("creation_time")
    return t.select("order_id", "creation_time", "delivery_time",
                    F.try_divide(secs, F.lit(60)).cast("float").alias("duration_minutes"))


def order_details(events: DataFrame, order_ids: DataFrame) -> DataFrame:
    """All events of the given orders (semi-join on order_id).

    ``order_ids`` is broadcast only when its estimated size is small;
    otherwise the semi-join shuffles both sides on order_id.  Duplicate
    keys need no ``distinct`` (a semi-join returns each event once).
    """
    keys = broadcast_if_small(order_ids.select("order_id"))
    return (events.join(keys, "order_id", "left_semi")
            .select("body", "event_type", "order_id", "ts", "location"))
