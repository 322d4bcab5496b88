"""Named queries: each takes (spark, sf_dir) and returns a DataFrame.

Every query reads the driver's tables, derives the order-event log with
Spark (``sources.fixtures``), runs library operators over all of it and
ends in a comparable projection (rounded doubles, text times, sorted
arrays) that matches the DuckDB SQL of the same name in ``oracle.py``.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.output import day_text, money, sorted_text, ts_text
from ..functions import sql as sql_objects
from ..functions.time import minutes_between
from ..operators import delivery, dims, gold, quality, refunds, rollups, silver, sketches
from . import dashboards
from ..session import cut_lineage, prepare, scratch_path
from ..sources import fixtures
from ..sources.events import read_events, read_events_stream, read_lines_stream, write_events
from ..sources.tables import load_once, write_event_log
from ..streaming import layers, merged, routed, stateful
from ..streaming.sinks import read_aggregate, run_append

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(name: str) -> Callable[[Query], Query]:
    def deco(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            prepare(spark)
            return fn(spark, sf_dir)
        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        return run
    return deco


def within_bound(approx: Column, exact: Column, rsd: float) -> Column:
    """Estimate is within 4 standard errors (plus one) of the exact count."""
    return F.abs(approx - exact) <= F.lit(4 * rsd) * exact + 1


def silver_a(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.order_items(fixtures.sales_events(spark, sf_dir))


def silver_b(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.order_items(fixtures.lifecycle_events(spark, sf_dir))


def silver_view(items: DataFrame) -> DataFrame:
    return items.select(
        "order_id", "gk_id", "location", ts_text("order_ts").alias("order_ts"),
        day_text("order_day").alias("order_day"), "item_id", "menu_id", "category_id",
        "brand_id", "item_name", "price", "qty", money("extended_price").alias("extended_price"))


def header_view(header: DataFrame) -> DataFrame:
    return header.select(
        "order_id", "gk_id", "location", day_text("order_day").alias("order_day"),
        money("order_revenue").alias("order_revenue"), "total_qty", "total_items",
        sorted_text("brands_in_order").alias("brands_in_order"))


# ---- step 1: events -> silver -> order header -------------------------

@query("silver_order_items")
def q_silver_order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mapping A order events exploded to item rows."""
    return silver_view(silver_a(spark, sf_dir))


@query("gold_order_header")
def q_gold_order_header(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Revenue, quantity, item rows and brands per order (flagship)."""
    return header_view(gold.order_header(silver_a(spark, sf_dir)))


# ---- step 2: other gold tables ------------------------------------------

@query("gold_item_sales_day")
def q_gold_item_sales_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = gold.item_sales_day(silver_a(spark, sf_dir))
    return t.select("item_id", "menu_id", "category_id", "brand_id",
                    day_text("day").alias("day"), "units_sold",
                    money("gross_revenue").alias("gross_revenue"))


@query("gold_brand_sales_day")
def q_gold_brand_sales_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Brand/day table; the HLL order estimate is checked against the
    exact distinct count (``orders_ok``), the other measures are exact."""
    t = gold.brand_sales_day(silver_a(spark, sf_dir), watermark=None, exact=True)
    return t.select("brand_id", day_text("day").alias("day"), "items_sold",
                    money("brand_revenue").alias("brand_revenue"),
                    within_bound(F.col("orders"), F.col("exact_orders"),
                                 gold.DEFAULT_RSD).alias("orders_ok"))


@query("gold_location_hourly")
def q_gold_location_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = gold.location_sales_hourly(silver_b(spark, sf_dir), watermark=None, exact=True)
    return t.select("location", ts_text("hour_ts").alias("hour_ts"),
                    money("revenue").alias("revenue"),
                    within_bound(F.col("orders"), F.col("exact_orders"),
                                 gold.DEFAULT_RSD).alias("orders_ok"))


# ---- step 3: dashboards --------------------------------------------------

def brand_sales_a(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.brand_sales_day(silver_a(spark, sf_dir), watermark=None)


def header_a(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.order_header(silver_a(spark, sf_dir))


def hourly_b(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dashboards.hourly_trend(gold.location_sales_hourly(silver_b(spark, sf_dir),
                                                              watermark=None))


@query("dash_gross_revenue")
def q_dash_gross_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = dashboards.gross_revenue(brand_sales_a(spark, sf_dir))
    return d.select(money("value").alias("value"), "label")


@query("dash_orders")
def q_dash_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dashboards.order_count(header_a(spark, sf_dir))


@query("dash_basket")
def q_dash_basket(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dashboards.basket(header_a(spark, sf_dir))


@query("dash_run_rate")
def q_dash_run_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = dashboards.run_rate(brand_sales_a(spark, sf_dir))
    return d.select(money("revenue").alias("revenue"), "goal", money("pct", 6).alias("pct"))


@query("dash_hourly")
def q_dash_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = hourly_b(spark, sf_dir)
    return d.select(ts_text("hour_ts").alias("hour_ts"), "location",
                    money("revenue").alias("revenue"))


@query("dash_widget_hourly")
def q_dash_widget_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line chart widget: location and hour become keys, revenue summed."""
    w = dashboards.widget(hourly_b(spark, sf_dir), ["location", "hour_ts"], "revenue")
    return w.select("location", ts_text("hour_ts").alias("hour_ts"),
                    money("`sum(revenue)`").alias("sum(revenue)"))


@query("dash_widget_bar")
def q_dash_widget_bar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bar widget: label key, SUM(value), sorted by the measure descending."""
    d = dashboards.gross_revenue(brand_sales_a(spark, sf_dir))
    w = dashboards.widget(d, ["label"], "value", descending=True)
    return w.select("label", money("`sum(value)`").alias("sum(value)"))


@query("dash_widget_counter")
def q_dash_widget_counter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counter widget: one field passed through (disaggregated)."""
    return dashboards.widget(dashboards.basket(header_a(spark, sf_dir)), ["avg_basket_qty"])


# ---- step 4: delivery times and SQL table functions ----------------------

def events_b_view(spark: SparkSession, sf_dir: str, name: str = "all_events") -> str:
    fixtures.lifecycle_events(spark, sf_dir).createOrReplaceTempView(name)
    return name


@query("order_times")
def q_order_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = delivery.order_times(fixtures.lifecycle_events(spark, sf_dir))
    return t.select("order_id", "location",
                    ts_text("order_created_time").alias("order_created_time"),
                    ts_text("delivered_time").alias("delivered_time"))


@query("delivery_percentiles")
def q_delivery_percentiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = delivery.delivery_percentiles(fixtures.lifecycle_events(spark, sf_dir))
    return p.select("location", *[money(c, 4).alias(c) for c in ("P50", "P75", "P99")])


@query("delivery_view_sql")
def q_delivery_view_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same percentiles through the SQL view."""
    view = sql_objects.create_delivery_view(spark, events_b_view(spark, sf_dir))
    return spark.table(view).select(
        "location", *[money(c, 4).alias(c) for c in ("P50", "P75", "P99")])


@query("order_durations")
def q_order_durations(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = delivery.order_durations(fixtures.lifecycle_events(spark, sf_dir))
    return d.select("order_id", ts_text("creation_time").alias("creation_time"),
                    ts_text("delivery_time").alias("delivery_time"),
                    money("duration_minutes", 4).alias("duration_minutes"))


UNKNOWN_ORDER = "no-such-order"
UNKNOWN_LOCATION = "no-such-location"


@query("order_details_fn")
def q_order_details_fn(spark: SparkSession, sf_dir: str) -> DataFrame:
    """get_order_details applied to every order id (LATERAL), plus an
    unknown id that must return nothing."""
    sql_objects.register_functions(spark, events_b_view(spark, sf_dir))
    return spark.sql(f"""
        SELECT d.order_id, d.event_type, d.ts, d.location, d.body
        FROM (SELECT DISTINCT order_id FROM all_events
              UNION ALL SELECT '{UNKNOWN_ORDER}') k,
             LATERAL get_order_details(k.order_id) d""")


@query("order_delivery_time_fn")
def q_order_delivery_time_fn(spark: SparkSession, sf_dir: str) -> DataFrame:
    """get_order_delivery_time for every order id plus an unknown id
    (one row of NULLs)."""
    sql_objects.register_functions(spark, events_b_view(spark, sf_dir))
    d = spark.sql(f"""
        SELECT d.*
        FROM (SELECT DISTINCT order_id FROM all_events
              UNION ALL SELECT '{UNKNOWN_ORDER}') k,
             LATERAL get_order_delivery_time(k.order_id) d""")
    return d.select("order_id", ts_text("creation_time").alias("creation_time"),
                    ts_text("delivery_time").alias("delivery_time"),
                    money("duration_minutes", 4).alias("duration_minutes"))


@query("location_timings_fn")
def q_location_timings_fn(spark: SparkSession, sf_dir: str) -> DataFrame:
    """get_location_timings for every location plus an unknown one (no row)."""
    sql_objects.register_functions(spark, events_b_view(spark, sf_dir))
    d = spark.sql(f"""
        SELECT d.*
        FROM (SELECT DISTINCT location FROM all_events
              UNION ALL SELECT '{UNKNOWN_LOCATION}') k,
             LATERAL get_location_timings(k.location) d""")
    return d.select("location", *[money(c, 4).alias(c) for c in ("P50", "P75", "P99")])


# ---- step 5: dimensions ----------------------------------------------------

@query("dims_loaded")
def q_dims_loaded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dimensions derived from part, written as tables, counted back."""
    location = scratch_path(spark, "dims")
    db = "orderflow_dims_" + location.rsplit("-", 1)[-1]
    names = dims.load_dims(spark, fixtures.dims_from_part(spark, sf_dir), db, location)
    parts = [spark.table(t).agg(F.count(F.lit(1)).alias("rows"))
             .select(F.lit(n).alias("table"), "rows") for n, t in names.items()]
    return reduce(DataFrame.unionByName, parts)


@query("dims_integrity")
def q_dims_integrity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Declared constraints over the derived dimensions.  Each dimension is
    used by several checks, so it is materialised once (reliable
    checkpoint) instead of being re-derived from ``part`` per check."""
    derived = {k: cut_lineage(v) for k, v in fixtures.dims_from_part(spark, sf_dir).items()}
    return dims.check_integrity(derived)


@query("brand_sales_enriched")
def q_brand_sales_enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = dims.enrich(brand_sales_a(spark, sf_dir), fixtures.dims_from_part(spark, sf_dir))
    return e.select("brand_id", "brand_name", day_text("day").alias("day"), "items_sold",
                    money("brand_revenue").alias("brand_revenue"))


@query("item_sales_enriched")
def q_item_sales_enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = gold.item_sales_day(silver_a(spark, sf_dir))
    e = dims.enrich(t, fixtures.dims_from_part(spark, sf_dir))
    return e.select("item_id", "item_name", "menu_name", "category_name", "brand_name",
                    day_text("day").alias("day"), "units_sold",
                    money("gross_revenue").alias("gross_revenue"))


# ---- step 8: refunds ---------------------------------------------------------

def decisions_b(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Decisions from one per-order rollup of the event log (revenue from
    the order bodies, equal to the order header's)."""
    return refunds.refund_decisions(fixtures.lifecycle_events(spark, sf_dir))


@query("refund_decisions")
def q_refund_decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = decisions_b(spark, sf_dir)
    return d.select("order_id", "location", money("duration_minutes", 4).alias("duration_minutes"),
                    "refund_usd", "refund_class", "reason")


@query("refund_requests")
def q_refund_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = refunds.match_requests(fixtures.refund_requests(spark, sf_dir), decisions_b(spark, sf_dir))
    return m.select("request_id", "order_hash", "order_id", "route", "refund_usd")


@query("refund_json_valid")
def q_refund_json_valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = refunds.valid_json(refunds.to_json_line(decisions_b(spark, sf_dir)))
    return v.select("order_id", F.col("parsed.refund_class").alias("refund_class"),
                    F.col("parsed.refund_usd").alias("refund_usd"), "valid")


@query("refund_policy_rate")
def q_refund_policy_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    rollup = cut_lineage(delivery.order_rollup(fixtures.lifecycle_events(spark, sf_dir)))
    pct = delivery.percentiles_from(rollup)
    checked = refunds.policy_check(refunds.decide(rollup, pct), pct)
    r = refunds.policy_rate(checked, ["location"])
    return r.select("location", "decisions", "passed", money("pass_rate", 4).alias("pass_rate"))


# ---- step 9: quality ---------------------------------------------------------

@query("stage_durations")
def q_stage_durations(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = quality.stage_durations(fixtures.lifecycle_events(spark, sf_dir))
    return d.select("order_id", "location", *[money(n, 4).alias(n) for n, _, _ in quality.STAGES])


@query("stage_summary")
def q_stage_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = quality.stage_summary(fixtures.lifecycle_events(spark, sf_dir))
    return d.select(*[money(c, 4).alias(c) if c.endswith(("_mean", "_std")) else F.col(c)
                      for c in d.columns])


def _missing_view(df: DataFrame) -> DataFrame:
    return df.select("event_type", "field", "events", "missing", money("rate", 4).alias("rate"),
                     "threshold", "exceeded")


@query("missing_field_rate")
def q_missing_field_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _missing_view(quality.missing_field_rate(fixtures.lifecycle_events(spark, sf_dir)))


@query("missing_items_sales")
def q_missing_items_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders that silver drops for lack of items (mapping A)."""
    return _missing_view(quality.missing_field_rate(fixtures.sales_events(spark, sf_dir)))


@query("event_sequence")
def q_event_sequence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All columns of every event, with its position in the order."""
    return quality.with_sequence(fixtures.lifecycle_events(spark, sf_dir))


@query("event_time_audit")
def q_event_time_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that no hourly table can hold, on a log in which one location
    writes broken times and one has lost its order ids."""
    ev = fixtures.lifecycle_events(spark, sf_dir)
    ev = (ev.withColumn("ts", F.when(F.col("location") == "loc1", F.lit("not a time")).otherwise(F.col("ts")))
          .withColumn("order_id", F.when(F.col("location") != "loc2", F.col("order_id"))))
    return quality.time_audit(ev)


# ---- step 6: streaming tables ------------------------------------------------

def land_b(spark: SparkSession, sf_dir: str, tag: str) -> tuple[str, str]:
    """Write mapping B as JSON event files into a new landing folder
    (one file per input partition: no shuffle, file count grows with the data)."""
    root = scratch_path(spark, tag)
    landing = f"{root}/landing"
    write_events(fixtures.lifecycle_events(spark, sf_dir), landing)
    return landing, root


def exact_orders_hourly(items: DataFrame) -> DataFrame:
    return (items.groupBy("location", F.date_trunc("hour", "order_ts").alias("hour_ts"))
            .agg(F.count_distinct("order_id").alias("exact_orders")))


@query("stream_silver_eq_batch")
def q_stream_silver_eq_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landing files -> bronze stream -> silver stream, read back."""
    landing, root = land_b(spark, sf_dir, "stream-silver")
    layout = layers.Layout(root)
    layers.run_bronze(spark, landing, layout)
    layers.run_silver(spark, layout)
    return silver_view(spark.read.parquet(layout.table("silver")))


@query("stream_header_complete")
def q_stream_header_complete(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order header kept by a complete-mode stream (versioned table)."""
    landing, root = land_b(spark, sf_dir, "stream-header")
    layout = layers.run_layers(spark, landing, root, tables=["order_header"], windowed=False)
    return header_view(read_aggregate(spark, layout.table("order_header")))


@query("stream_brand_sales_complete")
def q_stream_brand_sales_complete(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Brand/day table from the stream (watermark set, complete mode)."""
    landing, root = land_b(spark, sf_dir, "stream-brand")
    layout = layers.run_layers(spark, landing, root, tables=["brand_sales_day"], windowed=False)
    t = read_aggregate(spark, layout.table("brand_sales_day"))
    items = spark.read.parquet(layout.table("silver"))
    exact = (items.groupBy("brand_id", F.col("order_day").alias("day"))
             .agg(F.count_distinct("order_id").alias("exact_orders")))
    j = t.join(exact, ["brand_id", "day"])
    return j.select("brand_id", day_text("day").alias("day"), "items_sold",
                    money("brand_revenue").alias("brand_revenue"),
                    within_bound(F.col("orders"), F.col("exact_orders"),
                                 gold.DEFAULT_RSD).alias("orders_ok"))


@query("stream_hourly_windowed_append")
def q_stream_hourly_windowed_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly windows under a 3 h watermark, append mode: only hours the
    watermark has closed are written."""
    landing, root = land_b(spark, sf_dir, "stream-windowed")
    layout = layers.run_layers(spark, landing, root, tables=[], windowed=True)
    t = spark.read.parquet(layout.table("location_sales_windowed"))
    exact = exact_orders_hourly(spark.read.parquet(layout.table("silver")))
    j = t.join(exact, ["location", "hour_ts"])
    return j.select("location", ts_text("hour_ts").alias("hour_ts"),
                    money("revenue").alias("revenue"),
                    within_bound(F.col("orders"), F.col("exact_orders"),
                                 gold.DEFAULT_RSD).alias("orders_ok"))


# ---- step 7: stateful orders ---------------------------------------------------

def order_summary(df: DataFrame, *more: str) -> DataFrame:
    """Counts, times and a hash of the ordered (type, time, body) lines."""
    ts = F.transform("events", lambda e: e["ts"])
    lines = F.transform("events", lambda e: F.concat_ws("|", e["event_type"], ts_text(e["ts"]), e["body"]))
    return df.select("order_id", "location", *more, F.size("events").cast("bigint").alias("n_events"),
                     F.md5(F.array_join(lines, "\n")).alias("events_md5"),
                     ts_text(F.array_min(ts)).alias("first_ts"),
                     ts_text(F.array_max(ts)).alias("last_ts"))


def run_collector(spark: SparkSession, sf_dir: str, tag: str) -> tuple[str, str]:
    landing, root = land_b(spark, sf_dir, tag)
    out, ckpt = f"{root}/completed_orders", f"{root}/_checkpoints/completed_orders"
    run_append(stateful.completed_orders(read_events_stream(spark, landing)), out, ckpt)
    return out, ckpt


@query("completed_orders")
def q_completed_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Delivered orders released by the stateful stream."""
    out, _ = run_collector(spark, sf_dir, "stateful-completed")
    return order_summary(spark.read.parquet(out))


@query("orders_in_progress")
def q_orders_in_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders left in the stream's state, read from its checkpoint."""
    _, ckpt = run_collector(spark, sf_dir, "stateful-progress")
    return order_summary(stateful.orders_in_progress(spark, ckpt))


@query("completed_orders_batch")
def q_completed_orders_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_summary(stateful.completed_orders_batch(fixtures.lifecycle_events(spark, sf_dir)))


@query("completed_orders_table")
def q_completed_orders_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The collector fed by a stream of the bronze catalog table."""
    landing, root = land_b(spark, sf_dir, "stateful-table")
    layout = catalog_layout(root)
    layers.run_bronze(spark, landing, layout)
    out = f"{root}/completed_orders"
    run_append(stateful.completed_orders(layers.bronze_stream(spark, layout)), out,
               f"{root}/_checkpoints/completed_orders")
    return order_summary(spark.read.parquet(out))


# ---- catalog tables, bulk loads, day filters ------------------------------------

def catalog_layout(root: str) -> layers.Layout:
    return layers.Layout(root, "orderflow_" + root.rsplit("-", 1)[-1])


@query("stream_item_sales_table")
def q_stream_item_sales_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Item/day table kept by the stream, read by its catalog name."""
    landing, root = land_b(spark, sf_dir, "stream-items")
    layout = layers.run_layers(spark, landing, root, tables=["item_sales_day"], windowed=False,
                               database=catalog_layout(root).database)
    t = spark.table(layout.table_name("item_sales_day"))
    return t.select("item_id", "menu_id", "category_id", "brand_id",
                    day_text(F.col("day").cast("date")).alias("day"), "units_sold",
                    money("gross_revenue").alias("gross_revenue"))


@query("stream_hourly_table")
def q_stream_hourly_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly location table kept by the stream, read by its catalog name."""
    landing, root = land_b(spark, sf_dir, "stream-hourly")
    layout = layers.run_layers(spark, landing, root, tables=["location_sales_hourly"], windowed=False,
                               database=catalog_layout(root).database)
    t = spark.table(layout.table_name("location_sales_hourly"))
    return t.select("location", ts_text("hour_ts").alias("hour_ts"), money("revenue").alias("revenue"))


@query("events_gzip_bulk")
def q_events_gzip_bulk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bulk read of gzip event files, loaded once as a table, then silver
    with strict time parsing.  A second load leaves the table alone."""
    root = scratch_path(spark, "gzip-bulk")
    write_events(fixtures.lifecycle_events(spark, sf_dir), f"{root}/gz", compression="gzip")
    bulk = read_events(spark, f"{root}/gz", partitions=int(spark.conf.get("spark.sql.shuffle.partitions")))
    name = "all_events_" + root.rsplit("-", 1)[-1]
    load_once(spark, bulk, name, path=f"{root}/table")
    load_once(spark, bulk.limit(0), name, path=f"{root}/table")
    return silver_view(silver.order_items(spark.table(name), strict=True))


@query("dims_files")
def q_dims_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dimensions written as the four files, read back, with their values."""
    root = scratch_path(spark, "dim-files")
    for name, df in fixtures.dims_from_part(spark, sf_dir).items():
        dims.conform(name, df).write.parquet(f"{root}/{dims.DIM_FILES[name]}.parquet")
    parts = [df.select(F.lit(n).alias("table"), "id", "name") for n, df in dims.read_dims(spark, root).items()]
    return reduce(DataFrame.unionByName, parts)


@query("parsed_bodies")
def q_parsed_bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed body fields of every event."""
    p = silver.parse_bodies(fixtures.lifecycle_events(spark, sf_dir))
    return p.select("event_id", F.when(F.col("b_items").isNotNull(), F.size("b_items")).cast("bigint").alias("n_items"),
                    F.get("b_items", F.lit(0))["id"].alias("item_id"),
                    F.get("b_items", F.lit(0))["name"].alias("item_name"), "b_eta_mins")


@query("order_details_set")
def q_order_details_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events of the delivered orders (set form of get_order_details)."""
    ev = fixtures.lifecycle_events(spark, sf_dir)
    wanted = ev.filter(F.col("event_type") == "delivered").select("order_id")
    return delivery.order_details(ev, wanted)


DAY_A, DAY_B = "1996-03-05", "2024-01-20"


@query("dash_gross_revenue_day")
def q_dash_gross_revenue_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = dashboards.gross_revenue(brand_sales_a(spark, sf_dir), DAY_A)
    return d.select(money("value").alias("value"), "label")


@query("dash_orders_day")
def q_dash_orders_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dashboards.order_count(header_a(spark, sf_dir), DAY_A)


@query("dash_hourly_since")
def q_dash_hourly_since(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = dashboards.hourly_trend(gold.location_sales_hourly(silver_b(spark, sf_dir), watermark=None), DAY_B)
    return t.select(ts_text("hour_ts").alias("hour_ts"), "location", money("revenue").alias("revenue"))


@query("gold_brand_sales_plain")
def q_gold_brand_sales_plain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Brand/day table as it runs in production: one exchange, no audit."""
    t = gold.brand_sales_day(silver_a(spark, sf_dir), watermark=None)
    return t.select("brand_id", day_text("day").alias("day"), "items_sold",
                    money("brand_revenue").alias("brand_revenue"), (F.col("orders") > 0).alias("has_orders"))


@query("gold_hourly_plain")
def q_gold_hourly_plain(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = gold.location_sales_hourly(silver_b(spark, sf_dir), watermark=None)
    return t.select("location", ts_text("hour_ts").alias("hour_ts"), money("revenue").alias("revenue"),
                    (F.col("orders") > 0).alias("has_orders"))


# ---- checks that meet violations --------------------------------------------------

@query("dims_integrity_planted")
def q_dims_integrity_planted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Declared constraints over items with repeated keys, orphans and gaps."""
    d = fixtures.dims_from_part(spark, sf_dir)
    k = F.col("id") % 50
    item = (d["item"].withColumn("brand_id", F.when(k == 3, F.lit(-1).cast("bigint")).otherwise(F.col("brand_id")))
            .withColumn("name", F.when(k != 5, F.col("name"))))
    d["item"] = item.unionByName(item.filter(k == 1))
    return dims.check_integrity({n: cut_lineage(x) for n, x in d.items()})


def _odd():
    """Orders chosen for a planted fault."""
    return F.length("order_id") % 2 == 1


@query("refund_json_planted")
def q_refund_json_planted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Decision lines, some cut off: those must be flagged."""
    line = refunds.to_json_line(decisions_b(spark, sf_dir)).withColumn(
        "decision_json", F.when(_odd(), F.substring("decision_json", 1, 9)).otherwise(F.col("decision_json")))
    return refunds.valid_json(line).select("order_id", "valid")


@query("refund_policy_planted")
def q_refund_policy_planted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Policy check where some orders are paid without a reason."""
    rollup = cut_lineage(delivery.order_rollup(fixtures.lifecycle_events(spark, sf_dir)))
    pct = delivery.percentiles_from(rollup)
    paid = refunds.decide(rollup, pct).withColumn(
        "refund_usd", F.when(_odd(), F.col("refund_usd") + 1).otherwise(F.col("refund_usd")))
    r = refunds.policy_rate(refunds.policy_check(paid, pct), ["location"])
    return r.select("location", "decisions", "passed", money("pass_rate", 4).alias("pass_rate"))


@query("refund_requests_planted")
def q_refund_requests_planted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests without an id or with the id of an unknown order."""
    req = fixtures.refund_requests(spark, sf_dir)
    req = req.withColumn("content", F.when(F.substring("request_id", 1, 1) < "4", "Where is my food?").when(
        F.substring("request_id", 1, 1) < "8", F.concat(F.lit("refund "), F.md5("request_id"))).otherwise(F.col("content")))
    m = refunds.match_requests(req, decisions_b(spark, sf_dir))
    return m.select("request_id", "order_hash", "order_id", "route", "refund_usd")


@query("refund_two_locations")
def q_refund_two_locations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Revenue from the order header, for orders whose events come from two
    locations: each (order, location) is paid from its own revenue."""
    ev = fixtures.lifecycle_events(spark, sf_dir).withColumn(
        "location", F.when(F.col("event_id") < "8", F.col("location")).otherwise(F.lit("loc9")))
    header = gold.order_header(silver.order_items(ev))
    d = refunds.refund_decisions(ev, header=header)
    return d.groupBy("location").agg(F.count(F.lit(1)).alias("orders"),
                                     money(F.sum("refund_usd")).alias("refunds"))


# ---- gold tables merged per day ------------------------------------------------------

MERGE_BATCHES = 4


def merged_gold(spark: SparkSession, sf_dir: str, rollup: rollups.Rollup) -> merged.MergedTable:
    """The events in several files, one micro-batch each, merged into a
    gold table with a catalog name."""
    root = scratch_path(spark, f"merged-{rollup.name}".replace("_", "-"))
    write_events(fixtures.lifecycle_events(spark, sf_dir).repartition(MERGE_BATCHES, F.col("event_id")), f"{root}/landing")
    database = catalog_layout(root).database
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{root}/_database'")
    t = merged.MergedTable(rollup, f"{root}/{rollup.name}", f"{root}/_checkpoints/{rollup.name}",
                           f"{database}.{rollup.name}")
    merged.run_merged(silver.order_items(read_events_stream(spark, f"{root}/landing", max_files=1)), t)
    return t


@query("merged_order_header")
def q_merged_order_header(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order header read by name after several merged micro-batches."""
    return header_view(spark.table(merged_gold(spark, sf_dir, rollups.order_header()).name))


@query("merged_item_sales")
def q_merged_item_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = spark.table(merged_gold(spark, sf_dir, rollups.item_sales_day()).name)
    return t.select("item_id", "menu_id", "category_id", "brand_id", day_text("day").alias("day"), "units_sold",
                    money("gross_revenue").alias("gross_revenue"))


@query("merged_brand_sales")
def q_merged_brand_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Brand/day table from merged sketches, held against the exact count."""
    t = spark.table(merged_gold(spark, sf_dir, rollups.brand_sales_day()).name)
    exact = silver_b(spark, sf_dir).groupBy("brand_id", F.col("order_day").alias("day")).agg(
        F.count_distinct("order_id").alias("exact_orders"))
    return t.join(exact, ["brand_id", "day"]).select(
        "brand_id", day_text("day").alias("day"), "items_sold", money("brand_revenue").alias("brand_revenue"),
        within_bound(F.col("orders"), F.col("exact_orders"), rollups.SKETCH_RSD).alias("orders_ok"))


@query("merged_hourly")
def q_merged_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = spark.table(merged_gold(spark, sf_dir, rollups.location_sales_hourly()).name)
    exact = exact_orders_hourly(silver_b(spark, sf_dir))
    return t.join(exact, ["location", "hour_ts"]).select(
        "location", ts_text("hour_ts").alias("hour_ts"), money("revenue").alias("revenue"),
        within_bound(F.col("orders"), F.col("exact_orders"), rollups.SKETCH_RSD).alias("orders_ok"))


# ---- distinct orders from day sketches -------------------------------------------------

def brand_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The brand/day partial table (sums and sketches), as a stored table."""
    return cut_lineage(rollups.brand_sales_day().partial(silver_a(spark, sf_dir)))


@query("orders_by_month_sketch")
def q_orders_by_month_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct orders of a month over all brands, from the sketches of days
    and brands; held against the exact count of the items."""
    month = F.date_format("day", "yyyy-MM").alias("month")
    est = rollups.orders_by(brand_parts(spark, sf_dir), month)
    exact = silver_a(spark, sf_dir).groupBy(F.date_format("order_day", "yyyy-MM").alias("month")).agg(
        F.count_distinct("order_id").alias("exact_orders"))
    return exact.join(est, "month").select(
        "month", "exact_orders", within_bound(F.col("orders"), F.col("exact_orders"), rollups.SKETCH_RSD).alias("orders_ok"))


@query("orders_by_brand_sketch")
def q_orders_by_brand_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct orders of a brand over all days, and of all brands, from day sketches."""
    parts = brand_parts(spark, sf_dir)
    est = rollups.orders_by(parts, F.col("brand_id").cast("string").alias("brand")).unionByName(
        rollups.orders_by(parts, F.lit("all").alias("brand")))
    items = silver_a(spark, sf_dir)
    exact = items.groupBy(F.col("brand_id").cast("string").alias("brand")).agg(
        F.count_distinct("order_id").alias("exact_orders")).unionByName(
        items.agg(F.count_distinct("order_id").alias("exact_orders")).withColumn("brand", F.lit("all")))
    return exact.join(est, "brand").select(
        "brand", "exact_orders", within_bound(F.col("orders"), F.col("exact_orders"), rollups.SKETCH_RSD).alias("orders_ok"))


# ---- stateful orders over several loads ------------------------------------------------

#: Hours of the day that land together, one load after the other.
LOADS = ((0, 8), (8, 16), (16, 24))


def load_of(spark: SparkSession, sf_dir: str, hours: tuple[int, int]) -> DataFrame:
    """Events of some hours of every day."""
    hour = F.substring("ts", 12, 2).cast("int")
    return fixtures.lifecycle_events(spark, sf_dir).filter((hour >= hours[0]) & (hour < hours[1]))


def run_in_loads(spark: SparkSession, sf_dir: str, tag: str, stream, loads=LOADS) -> tuple[str, str]:
    """Land and run the loads in turn; (output, checkpoint)."""
    root = scratch_path(spark, tag)
    for hours in loads:
        write_events(load_of(spark, sf_dir, hours), f"{root}/landing")
        run_append(stream(read_events_stream(spark, f"{root}/landing")), f"{root}/out", f"{root}/_checkpoint")
    return f"{root}/out", f"{root}/_checkpoint"


@query("orders_expiring")
def q_orders_expiring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Delivered orders, orders given up two days after their latest event,
    and flags of delivered orders dropped after the same time."""
    out, _ = run_in_loads(spark, sf_dir, "stateful-expiring", stateful.expiring_orders, [(0, 24)])
    return order_summary(spark.read.parquet(out), "outcome")


@query("completed_orders_seeded")
def q_completed_orders_seeded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first load as a batch: its delivered orders, and its open orders
    as the initial state of the stream of the later loads."""
    history = cut_lineage(load_of(spark, sf_dir, LOADS[0]))
    opened = stateful.open_orders_batch(history)
    out, _ = run_in_loads(spark, sf_dir, "stateful-seeded",
                          lambda s: stateful.completed_orders(s, opened=opened), LOADS[1:])
    return order_summary(stateful.completed_orders_batch(history)).unionByName(order_summary(spark.read.parquet(out)))


@query("event_sequence_stream")
def q_event_sequence_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event numbers that go on from load to load."""
    out, _ = run_in_loads(spark, sf_dir, "stateful-sequence", stateful.numbered_events)
    return spark.read.parquet(out)


@query("orders_opened_closed")
def q_orders_opened_closed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders opened and closed by each load (change feed of the state), and
    orders open after it (state as of that batch)."""
    _, ckpt = run_in_loads(spark, sf_dir, "stateful-changes", stateful.completed_orders)
    open_after = reduce(DataFrame.unionByName, [
        stateful.orders_in_progress(spark, ckpt, b).agg(F.count(F.lit(1)).alias("open_after"))
        .select(F.lit(b).cast("bigint").alias("batch_id"), "open_after") for b in range(len(LOADS))])
    changes = stateful.orders_opened_closed(spark, ckpt).groupBy("batch_id").agg(
        *[F.count(F.when(F.col("change") == c, 1)).alias(c) for c in ("opened", "closed")])
    return changes.join(open_after, "batch_id")


# ---- stored day summaries ----------------------------------------------------------------

def stored_days(df: DataFrame, tag: str) -> DataFrame:
    """A day table on shared storage, partitioned by day, and read back."""
    path = scratch_path(df.sparkSession, tag)
    df.write.partitionBy("day").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@query("percentiles_by_sketch")
def q_percentiles_by_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Delivery percentiles of all days and of a range of days from day
    sketches.  Each is a value whose exact ranks (share of orders below it,
    and up to it) enclose the rank asked for, but for the rank error."""
    ev = fixtures.lifecycle_events(spark, sf_dir)
    days = stored_days(sketches.duration_sketches(ev), "duration-sketches")
    ranges = {"all": F.lit(True), "range": F.col("day") >= DAY_B}
    t = delivery.order_times(ev).filter("order_created_time IS NOT NULL AND delivered_time IS NOT NULL").select(
        "location", F.to_date("order_created_time").alias("day"),
        minutes_between("order_created_time", "delivered_time").alias("m"))
    names = dict(zip(("P50", "P75", "P99"), delivery.QUANTILES))
    parts = []
    for name, chosen in ranges.items():
        got = sketches.percentiles_of(days.filter(chosen), F.col("location"))
        ranks = t.filter(chosen).join(got, "location").groupBy("location", "orders").agg(*[
            F.avg(c.cast("int")).alias(f"{n}_{k}") for n in names
            for k, c in (("below", F.col("m") < F.col(n)), ("upto", F.col("m") <= F.col(n)))])
        e = sketches.KLL_RANK_ERROR
        parts.append(ranks.select(F.lit(name).alias("days"), "location", "orders", *[
            ((F.col(f"{n}_below") <= q + e) & (F.col(f"{n}_upto") >= q - e)).alias(f"{n}_ok") for n, q in names.items()]))
    return reduce(DataFrame.unionByName, parts)


@query("stage_summary_merged")
def q_stage_summary_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stage means and deviations from day moments of three loads."""
    ev = fixtures.lifecycle_events(spark, sf_dir)
    path = scratch_path(spark, "stage-moments")
    load = F.pmod(F.dayofyear(F.to_date("ts")), F.lit(3))
    for k in range(3):
        part = sketches.stage_moments(ev.filter(load == k))
        part.write.mode("append").partitionBy("day").parquet(path)
    d = sketches.moments_summary(spark.read.schema(part.schema).parquet(path), "location")
    return d.select(*[money(c, 4).alias(c) if c.endswith(("_mean", "_std")) else F.col(c) for c in d.columns])


# ---- routed streams ------------------------------------------------------------------------

@query("late_rows_routed")
def q_late_rows_routed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Item rows of three loads by route: on time, late for a closed hour,
    without a time (one location writes broken times)."""
    root = scratch_path(spark, "late-rows")
    table = routed.late_rows(f"{root}/routed", f"{root}/_checkpoint")
    for hours in LOADS:
        part = load_of(spark, sf_dir, hours)
        write_events(part.withColumn("ts", F.when(F.col("location") != "loc1", F.col("ts")).otherwise("not a time")),
                     f"{root}/landing")
        table.run(silver.order_items(read_events_stream(spark, f"{root}/landing")))
    rows = table.read(spark, layers.silver_schema(spark))
    totals = table.ledger(spark)["totals"]
    counted = F.create_map(*[F.lit(x) for n in table.names for x in (n, totals[n])])
    return rows.groupBy("route").agg(F.count(F.lit(1)).alias("rows"), money(F.sum("extended_price")).alias("revenue")).select(
        "route", "rows", "revenue", counted[F.col("route")].cast("bigint").alias("ledger_rows"))


def _spoilt_lines(events: DataFrame) -> DataFrame:
    """Event lines, some cut off, some blank, no object, or of a wrong type."""
    kind = F.substring("event_id", 1, 1)
    line = F.to_json(F.struct(*events.columns))
    return events.select(
        F.when(kind == "0", F.expr("substring(to_json(struct(*)), 1, 40)")).when(kind == "1", F.lit("  "))
        .when(kind == "2", F.concat(F.lit("["), line, F.lit("]")))
        .when(kind == "3", F.concat(F.lit('{"sequence": "first", "event_id": "'), F.col("event_id"), F.lit('"}')))
        .otherwise(line).alias("value"))


@query("events_quarantined")
def q_events_quarantined(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of a log with planted faults by what became of them; all lines
    of the log are accounted for."""
    root = scratch_path(spark, "quarantine")
    _spoilt_lines(fixtures.lifecycle_events(spark, sf_dir)).write.text(f"{root}/landing")
    table = routed.quarantine(f"{root}/routed", f"{root}/_checkpoint")
    lines = routed.event_lines(read_lines_stream(spark, f"{root}/landing"))
    table.run(lines)
    rows = table.read(spark, lines.schema)
    total = table.ledger(spark)["totals"]["input"]
    return rows.groupBy("route").agg(
        F.count(F.lit(1)).alias("lines"), F.count_distinct("event_id").alias("events"),
        F.count("line").alias("kept_lines")).withColumn("lines_in", F.lit(total).cast("bigint"))


# ---- the log clustered by order ---------------------------------------------------------------

def clustered_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lifecycle events as a table bucketed and sorted by order_id."""
    root = scratch_path(spark, "event-log")
    name = "event_log_" + root.rsplit("-", 1)[-1]
    write_event_log(fixtures.lifecycle_events(spark, sf_dir), name, root,
                    int(spark.conf.get("spark.sql.shuffle.partitions")))
    return spark.table(name)


@query("log_order_header")
def q_log_order_header(spark: SparkSession, sf_dir: str) -> DataFrame:
    return header_view(gold.order_header(silver.order_items(clustered_log(spark, sf_dir))))


@query("log_order_times")
def q_log_order_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = delivery.order_times(clustered_log(spark, sf_dir))
    return t.select("order_id", "location", ts_text("order_created_time").alias("order_created_time"),
                    ts_text("delivered_time").alias("delivered_time"))


@query("log_event_sequence")
def q_log_event_sequence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.with_sequence(clustered_log(spark, sf_dir))


@query("log_completed_orders")
def q_log_completed_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_summary(stateful.completed_orders_batch(clustered_log(spark, sf_dir)))


# ---- dimensions, widgets and streams in full ---------------------------------------------------

@query("dims_loaded_values")
def q_dims_loaded_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dimensions loaded into tables twice (the second load replaces the
    first), with their values."""
    location = scratch_path(spark, "dims-values")
    db = "orderflow_dims_" + location.rsplit("-", 1)[-1]
    for _ in range(2):
        names = dims.load_dims(spark, fixtures.dims_from_part(spark, sf_dir), db, location)
    parts = []
    for n, t in names.items():
        df = spark.table(t)
        parts.append(df.select(F.lit(n).alias("table"), "id", "name", *[
            (F.col(c) if c in df.columns else F.lit(None)).cast(kind).alias(c)
            for c, kind in (("price", "double"), ("brand_id", "bigint"), ("menu_id", "bigint"), ("category_id", "bigint"))]))
    return reduce(DataFrame.unionByName, parts)


@query("dash_widget_bar_brands")
def q_dash_widget_bar_brands(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bar widget over a dataset of several labels: revenue by brand, largest first."""
    d = brand_sales_a(spark, sf_dir).select(F.col("brand_id").cast("string").alias("label"),
                                            F.col("brand_revenue").alias("value"))
    w = dashboards.widget(d, ["label"], "value", descending=True)
    return w.select("label", money("`sum(value)`").alias("sum(value)"))


@query("stream_items_enriched")
def q_stream_items_enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Item rows of a stream joined with the dimension tables (stream-static)."""
    root = scratch_path(spark, "stream-enriched")
    write_events(fixtures.sales_events(spark, sf_dir), f"{root}/landing")
    layout = layers.Layout(root)
    layers.run_bronze(spark, f"{root}/landing", layout)
    items = silver.order_items(layers.bronze_stream(spark, layout)).drop("item_name")
    run_append(dims.enrich(items, fixtures.dims_from_part(spark, sf_dir)), f"{root}/enriched", f"{root}/_checkpoints/enriched")
    return spark.read.parquet(f"{root}/enriched").select(
        "order_id", "item_id", "item_name", "menu_name", "category_name", "brand_name", "qty",
        money("extended_price").alias("extended_price"))
