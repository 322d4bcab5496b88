"""SQL objects over an events table: the delivery view and three table
functions (order details, order delivery time, location timings).

They are TEMPORARY so they may reference temporary views.  The
analyser inlines a SQL table function, so ``LATERAL f(keys.id)`` over
many keys is planned as a join / aggregation, not a loop.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from ..operators.delivery import delivery_percentiles, order_durations

DELIVERY_VIEW = "order_delivery_times_per_location_view"


def create_delivery_view(spark: SparkSession, events_table: str,
                         view: str = DELIVERY_VIEW) -> str:
    """``delivery_percentiles`` of an events table, as a view."""
    delivery_percentiles(spark.table(events_table)).createOrReplaceTempView(view)
    return view


def register_functions(spark: SparkSession, events_table: str,
                       view: str = DELIVERY_VIEW) -> list[str]:
    """Create the delivery view and the three table functions.

    ``get_order_delivery_time`` reads a view over ``order_durations``; an
    unknown id gives one row of NULLs.  For many keys use the set forms
    ``order_durations`` and ``order_details`` instead.
    """
    create_delivery_view(spark, events_table, view)
    durations = f"{view}_durations"
    order_durations(spark.table(events_table)).createOrReplaceTempView(durations)
    functions = {
        "get_order_details": (
            "oid STRING", "body STRING, event_type STRING, order_id STRING, ts STRING, location STRING",
            f"SELECT body, event_type, order_id, ts, location FROM {events_table} e WHERE e.order_id = oid"),
        "get_order_delivery_time": (
            "oid STRING", "order_id STRING, creation_time TIMESTAMP, delivery_time TIMESTAMP, "
                          "duration_minutes FLOAT",
            "SELECT k.oid, d.creation_time, d.delivery_time, d.duration_minutes "
            f"FROM (SELECT oid) k LEFT JOIN {durations} d ON d.order_id = k.oid"),
        "get_location_timings": (
            "loc STRING", "location STRING, P50 FLOAT, P75 FLOAT, P99 FLOAT",
            f"SELECT location, P50, P75, P99 FROM {view} v WHERE v.location = loc"),
    }
    for name, (args, columns, body) in functions.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({args}) RETURNS TABLE ({columns}) RETURN {body}")
    return list(functions)
