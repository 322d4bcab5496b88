"""Data quality and timing of the order lifecycle."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.time import minutes_between, parse_ts
from ..schemas import BODY

# Lifecycle stages as (name, from event, to event).
STAGES = [
    ("created_to_started", "order_created", "gk_started"),
    ("started_to_finished", "gk_started", "gk_finished"),
    ("finished_to_ready", "gk_finished", "gk_ready"),
    ("ready_to_picked", "gk_ready", "driver_picked_up"),
    ("picked_to_delivered", "driver_picked_up", "delivered"),
    ("created_to_delivered", "order_created", "delivered"),
]

# Allowed missing-field rates per (event type, body field).
DQ_THRESHOLDS = [
    ("driver_ping", "loc_lat", 0.01),
    ("driver_ping", "loc_lon", 0.01),
    ("driver_ping", "progress_pct", 0.02),
    ("driver_picked_up", "route_points", 0.03),
    ("order_created", "items", 0.02),
    ("order_created", "customer_addr", 0.01),
]


def stage_times(events: DataFrame) -> DataFrame:
    """First time each lifecycle event type occurs, per order (one pass)."""
    ts = parse_ts("ts")
    kinds = sorted({s for _, a, b in STAGES for s in (a, b)})
    return events.groupBy("order_id", "location").agg(
        *[F.min(F.when(F.col("event_type") == k, ts)).alias(k) for k in kinds])


def stage_durations(events: DataFrame) -> DataFrame:
    """Minutes spent in each stage per order (NULL when an end is missing)."""
    t = stage_times(events)
    return t.select("order_id", "location",
                    *[minutes_between(a, b).alias(n) for n, a, b in STAGES])


def stage_summary(events: DataFrame) -> DataFrame:
    """Mean and sample standard deviation of each stage per location."""
    d = stage_durations(events)
    aggs = []
    for n, _, _ in STAGES:
        aggs += [F.avg(n).alias(f"{n}_mean"), F.stddev_samp(n).alias(f"{n}_std"),
                 F.count(n).alias(f"{n}_n")]
    return d.groupBy("location").agg(*aggs)


def missing_field_rate(events: DataFrame, thresholds=DQ_THRESHOLDS) -> DataFrame:
    """Share of events of a type whose body lacks a field, against a limit.

    An array field that is empty counts as missing (an order_created
    event without items is dropped by the silver layer).  The body is
    parsed once; the measured fields are unpivoted in place and
    aggregated with partial aggregation per (event type, field); the
    limits are attached as a literal expression (no join).
    """
    types = sorted({t for t, _, _ in thresholds})
    body = F.from_json("body", BODY)
    parsed = (events.filter(F.col("event_type").isin(*types))
              .select("event_type", body.alias("b")))
    kinds = {f.name: f.dataType.typeName() for f in BODY.fields}

    def missing(f: str):
        v = F.col("b").getField(f)
        if kinds[f] == "array":
            return v.isNull() | (F.size(v) == 0)
        return v.isNull()

    arrays = None
    for t in types:
        a = F.array(*[F.struct(F.lit(f).alias("field"), missing(f).alias("missing"))
                      for tt, f, _ in thresholds if tt == t])
        arrays = (F.when(F.col("event_type") == t, a) if arrays is None
                  else arrays.when(F.col("event_type") == t, a))
    long = parsed.select("event_type", F.explode(arrays).alias("m"))
    rates = (long.groupBy("event_type", F.col("m.field").alias("field"))
             .agg(F.count(F.lit(1)).alias("events"),
                  F.sum(F.col("m.missing").cast("int")).cast("bigint").alias("missing")))
    # The limits are a small fixed table: attach them as a literal CASE
    # expression instead of a join.
    limit = None
    for t, f, th in thresholds:
        cond = (F.col("event_type") == t) & (F.col("field") == f)
        limit = (F.when(cond, F.lit(float(th))) if limit is None
                 else limit.when(cond, F.lit(float(th))))
    return (rates.withColumn("threshold", limit)
            .withColumn("rate", F.col("missing") / F.col("events"))
            .withColumn("exceeded", F.col("rate") > F.col("threshold")))


def with_sequence(events: DataFrame) -> DataFrame:
    """0-based position of each event within its order, by (ts, event_id).

    One window per order: an order is a handful of events, and a window
    sorts with spill to disk.  Events without an order id are no order:
    they get no number (and do not meet in one task).  Bad time text
    sorts last.
    """
    order = [parse_ts("ts").asc_nulls_last(), F.col("event_id").asc_nulls_last()]
    w = Window.partitionBy("order_id").orderBy(*order)
    number = (F.row_number().over(w) - 1).cast("bigint")
    numbered = events.filter(F.col("order_id").isNotNull()).withColumn("sequence", number)
    rest = events.filter(F.col("order_id").isNull()).withColumn(
        "sequence", F.lit(None).cast("bigint"))
    return numbered.unionByName(rest)


def time_audit(events: DataFrame) -> DataFrame:
    """Per event type: rows, rows whose time text does not parse (they
    carry no hour and reach no hourly table) and rows without order id."""
    return events.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("rows"),
        F.count(F.when(parse_ts("ts").isNull(), 1)).alias("no_time"),
        F.count(F.when(F.col("order_id").isNull(), 1)).alias("no_order"))
