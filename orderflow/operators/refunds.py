"""Refund decisions for all delivered orders, request routing and checks.

One plan answers every order: durations and percentiles are
aggregations over the event log, joined by location.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .delivery import order_rollup, percentiles_from
from .joins import broadcast_if_small, left_join_nonnull
from ..session import stored

# Decision classes and the id pattern in request text.
CLASSES = ("none", "partial", "full")
ORDER_HASH_PATTERN = "[0-9a-f]{32}"

DECISION_SCHEMA = T.StructType([
    T.StructField("refund_usd", T.DoubleType()),
    T.StructField("refund_class", T.StringType()),
    T.StructField("reason", T.StringType()),
])


def _minutes(c: Column) -> Column:
    return F.round(c.cast("double"), 0).cast("bigint").cast("string")


def durations_from(rollup: DataFrame) -> DataFrame:
    """First -> last event minutes (FLOAT) of delivered orders."""
    secs = F.unix_timestamp("last_ts") - F.unix_timestamp("first_ts")
    return (rollup.filter("delivered = 1")
            .select("order_id", "location", "order_revenue",
                    F.try_divide(secs, F.lit(60)).cast("float").alias("duration_minutes")))


def refund_decisions(events: DataFrame, header: DataFrame | None = None,
                     percentiles: DataFrame | None = None,
                     partial: float = 0.5, full: float = 1.0,
                     materialize: bool = True) -> DataFrame:
    """Decision per delivered order.

    duration < P75 -> none; P75 <= duration < P99 -> partial
    (``partial`` x order revenue); duration >= P99 -> full (``full`` x
    revenue).  No percentiles for the location -> none.

    Durations, percentiles and (without ``header``) revenue come from one
    per-order rollup of the event log.  With ``materialize`` the rollup
    (one row per order) and the percentiles (one row per location) are
    written to shared scratch Parquet: the log is read and shuffled once
    although two branches use it, each branch scans the columns it needs,
    and the join by location, a key with few values, is a broadcast behind
    a check of the written size instead of a shuffle of all orders.
    Without it the plan is lazy and reads the log twice.  Passing
    ``header`` takes revenue from the order header table.
    """
    rollup = order_rollup(events)
    if materialize:
        rollup = stored(rollup, "order-rollup")
    if percentiles is None:
        percentiles = percentiles_from(rollup)
        if materialize:
            percentiles = stored(percentiles, "percentiles")
    return decide(rollup, percentiles, header, partial, full)


def decide(rollup: DataFrame, percentiles: DataFrame, header: DataFrame | None = None,
           partial: float = 0.5, full: float = 1.0) -> DataFrame:
    """Decisions from a per-order rollup (``order_rollup``) and percentiles."""
    d = durations_from(rollup).join(broadcast_if_small(percentiles.select("location", "P75", "P99")), "location", "left")
    if header is not None:
        # Same grain as the rollup: an order seen at two locations is paid once each.
        rev = header.groupBy("order_id", "location").agg(F.sum("order_revenue").alias("_rev"))
        d = (d.join(rev, ["order_id", "location"], "left")
             .withColumn("order_revenue", F.col("_rev")).drop("_rev"))
    dur = F.col("duration_minutes").cast("double")
    cls = (F.when(F.col("P99").isNotNull() & (dur >= F.col("P99")), "full")
           .when(F.col("P75").isNotNull() & (dur >= F.col("P75")), "partial")
           .otherwise("none"))
    factor = (F.when(cls == "full", F.lit(full)).when(cls == "partial", F.lit(partial))
              .otherwise(F.lit(0.0)))
    reason = (F.when(F.col("P75").isNull() | dur.isNull(),
                     F.lit("no delivery-time reference for this location"))
              .when(cls == "full", F.concat(F.lit("late: "), _minutes(dur),
                                            F.lit(" min, beyond P99 of "), _minutes(F.col("P99")),
                                            F.lit(" min")))
              .when(cls == "partial", F.concat(F.lit("late: "), _minutes(dur),
                                               F.lit(" min, beyond P75 of "),
                                               _minutes(F.col("P75")), F.lit(" min")))
              .otherwise(F.concat(F.lit("on time: "), _minutes(dur),
                                  F.lit(" min, within P75 of "), _minutes(F.col("P75")),
                                  F.lit(" min"))))
    # Money in DECIMAL: the refund is rounded to the cent exactly (HALF_UP).
    revenue = F.coalesce(F.col("order_revenue"), F.lit(0.0)).cast("decimal(18,2)")
    refund = F.round(revenue * factor.cast("decimal(9,4)"), 2).cast("double")
    return d.select("order_id", "location", "duration_minutes",
                    refund.alias("refund_usd"),
                    cls.alias("refund_class"), reason.alias("reason"))


def match_requests(requests: DataFrame, decisions: DataFrame,
                   text_col: str = "content") -> DataFrame:
    """Find the 32-hex order id in each request and route it.

    route: ``no_order_id`` (no id in the text), ``no_decision`` (id of an
    order that is unknown or not delivered), else the decision class.
    """
    h = F.regexp_extract(F.lower(F.col(text_col)), ORDER_HASH_PATTERN, 0)
    req = requests.withColumn("order_hash", F.when(h != "", h))
    dec = decisions.select(F.md5("order_id").alias("_hash"), "order_id",
                           "refund_usd", "refund_class", "reason")
    # Requests without an id never match; they skip the shuffle join.
    j = left_join_nonnull(req, dec, "order_hash", "_hash").drop("_hash")
    route = (F.when(F.col("order_hash").isNull(), "no_order_id")
             .when(F.col("refund_class").isNull(), "no_decision")
             .otherwise(F.col("refund_class")))
    return j.select(*requests.columns, "order_hash", "order_id", "refund_usd",
                    "refund_class", route.alias("route"))


def to_json_line(decisions: DataFrame) -> DataFrame:
    """Decision as one-line JSON: refund_usd, refund_class, reason."""
    return decisions.withColumn(
        "decision_json", F.to_json(F.struct("refund_usd", "refund_class", "reason")))


def valid_json(df: DataFrame, col: str = "decision_json") -> DataFrame:
    """Parse a decision line back and flag whether it is well formed."""
    p = F.from_json(F.col(col), DECISION_SCHEMA)
    ok = (p.isNotNull() & p.getField("refund_usd").isNotNull()
          & p.getField("refund_class").isin(*CLASSES) & p.getField("reason").isNotNull())
    return df.withColumn("parsed", p).withColumn("valid", F.coalesce(ok, F.lit(False)))


def policy_check(decisions: DataFrame, percentiles: DataFrame) -> DataFrame:
    """A refund must rest on timing: pass when no money is given, or the
    duration reached the location's P75."""
    j = decisions.join(broadcast_if_small(percentiles.select("location", "P75")), "location", "left")
    ok = (F.col("refund_usd") == 0) | (F.col("duration_minutes").cast("double") >= F.col("P75"))
    return j.withColumn("pass", F.coalesce(ok, F.lit(False)))


def policy_rate(checked: DataFrame, by: list[str] | None = None) -> DataFrame:
    g = checked.groupBy(*(by or []))
    return g.agg(F.count(F.lit(1)).alias("decisions"),
                 F.sum(F.col("pass").cast("int")).cast("bigint").alias("passed"),
                 F.avg(F.col("pass").cast("double")).alias("pass_rate"))
