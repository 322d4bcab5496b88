"""Streams over several landed files / runs, compared with batch forms."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from orderflow.operators import gold, silver
from orderflow.session import scratch_path
from orderflow.sources.events import read_events_stream, write_events
from orderflow.streaming import layers, stateful
from orderflow.streaming.sinks import read_aggregate, run_append

ITEM = '{"items":[{"id":1,"category_id":111,"menu_id":11,"brand_id":1,"name":"a","price":2.0,"qty":1}]}'


def created(events, oid, ts, loc="x"):
    return events([("order_created", ts, oid, loc, ITEM)])


def test_stream_equals_batch_over_many_files(spark):
    """A1-A4 kept by complete-mode streams over one file per micro-batch
    equal the batch forms (approximate counts excluded)."""
    from orderflow.sources import fixtures
    ev = fixtures.lifecycle_events(spark, "/root/testdata/sf0.001")
    root = scratch_path(spark, "test-many")
    write_events(ev.repartition(5), f"{root}/landing")
    layout = layers.Layout(root)
    layers.run_bronze(spark, f"{root}/landing", layout, max_files=1)
    layers.run_silver(spark, layout)
    layers.run_gold(spark, layout, windowed=False)
    items = silver.order_items(ev)
    checks = {
        "order_header": (gold.order_header(items),
                         ["order_id", "total_qty", "total_items"], "order_revenue"),
        "item_sales_day": (gold.item_sales_day(items),
                           ["item_id", "day", "units_sold"], "gross_revenue"),
        "brand_sales_day": (gold.brand_sales_day(items, watermark=None),
                            ["brand_id", "day", "items_sold"], "brand_revenue"),
        "location_sales_hourly": (gold.location_sales_hourly(items, watermark=None),
                                  ["location", "hour_ts"], "revenue"),
    }
    for name, (want, keys, money_col) in checks.items():
        got = read_aggregate(spark, layout.table(name))
        cols = keys + [F.round(money_col, 2).alias("m")]
        assert got.count() == want.count(), name
        assert got.select(cols).exceptAll(want.select(cols)).count() == 0, name


def test_late_row_dropped_by_window_counted_by_date_trunc(spark, events):
    root = scratch_path(spark, "test-late")
    landing = f"{root}/landing"
    write_events(events([("order_created", f"2024-01-01 {h:02d}:10:00.000000", f"a{h}", "x", ITEM)
                         for h in range(10, 21)]), landing)
    for _ in range(2):
        layout = layers.run_layers(spark, landing, root, tables=["location_sales_hourly"])
        # second pass: a row for 12:xx arrives after the watermark reached 17:10
        write_events(events([("order_created", "2024-01-01 12:30:00.000000", "late", "x", ITEM)]),
                     landing)
    win = {str(r.hour_ts): r.revenue for r in spark.read.parquet(
        layout.table("location_sales_windowed")).collect()}
    trunc = {str(r.hour_ts): r.revenue for r in read_aggregate(
        spark, layout.table("location_sales_hourly")).collect()}
    assert win["2024-01-01 12:00:00"] == 2.0       # late row dropped
    assert trunc["2024-01-01 12:00:00"] == 4.0     # late row counted
    assert "2024-01-01 20:00:00" not in win        # still open under the watermark


@pytest.mark.parametrize("pandas", [False, True])
def test_collector_after_delivered_and_second_delivered(spark, events, pandas):
    root = scratch_path(spark, "test-collector")
    landing, out, ckpt = f"{root}/landing", f"{root}/out", f"{root}/ckpt"

    def run():
        run_append(stateful.completed_orders(read_events_stream(spark, landing), pandas=pandas),
                   out, ckpt)

    write_events(events([("order_created", "2024-01-01 10:00:00.000000", "o1", "x", ITEM),
                         ("delivered", "2024-01-01 10:30:00.000000", "o1", "x", "{}"),
                         ("order_created", "2024-01-01 10:00:00.000000", "o2", "x", ITEM)]), landing)
    run()
    assert [r.order_id for r in stateful.orders_in_progress(spark, ckpt).collect()] == ["o2"]
    # a ping after delivery opens new state; then a second delivered releases a second row
    write_events(events([("driver_ping", "2024-01-01 10:40:00.000000", "o1", "x", "{}")]), landing)
    run()
    assert sorted(r.order_id for r in stateful.orders_in_progress(spark, ckpt).collect()) == ["o1", "o2"]
    write_events(events([("delivered", "2024-01-01 10:50:00.000000", "o1", "x", "{}")]), landing)
    run()
    done = spark.read.parquet(out).filter("order_id = 'o1'").collect()
    assert len(done) == 2
    assert sorted(len(r.events) for r in done) == [2, 2]
    first = min(done, key=lambda r: len(r.events) and r.events[0].ts)
    assert [e.event_type for e in first.events] == ["order_created", "delivered"]


def test_batch_collector_sorts_events(spark, events):
    ev = events([("delivered", "2024-01-01 10:30:00.000000", "o1", "x", "{}"),
                 ("order_created", "2024-01-01 10:00:00.000000", "o1", "x", ITEM)])
    r = stateful.completed_orders_batch(ev).collect()[0]
    assert [e.event_type for e in r.events] == ["order_created", "delivered"]


def test_layers_on_catalog_tables_and_stream_static_enrich(spark):
    """Append layers as catalog tables (toTable / readStream.table), and a
    stream-static join of silver with a dimension."""
    from orderflow.operators import dims
    from orderflow.sources import fixtures
    ev = fixtures.lifecycle_events(spark, "/root/testdata/sf0.001")
    root = scratch_path(spark, "test-catalog")
    db = "orderflow_test_" + root.rsplit("-", 1)[-1]
    write_events(ev.repartition(2), f"{root}/landing")
    layout = layers.run_layers(spark, f"{root}/landing", root, tables=[], windowed=False,
                               database=db)
    got = layout.read(spark, "silver")
    assert got.count() == silver.order_items(ev).count()
    brands = spark.createDataFrame([(i, f"b{i}") for i in range(1, 11)], "id bigint, name string")
    enriched = dims.enrich(layers.silver_stream(spark, layout), {"brand": brands})
    run_append(enriched, f"{root}/enriched", f"{root}/_checkpoints/enriched")
    out = spark.read.parquet(f"{root}/enriched")
    assert out.count() == got.count()
    assert out.filter(F.col("brand_name").isNull() & F.col("brand_id").isNotNull()).count() == 0


def test_collector_remembers_delivered_orders(spark, events):
    """Opt-in: events after delivery are dropped instead of reopening state."""
    root = scratch_path(spark, "test-remember")
    landing, out, ckpt = f"{root}/landing", f"{root}/out", f"{root}/ckpt"

    def run():
        run_append(stateful.completed_orders(read_events_stream(spark, landing),
                                             remember_delivered=True), out, ckpt)

    write_events(events([("order_created", "2024-01-01 10:00:00.000000", "o1", "x", ITEM),
                         ("delivered", "2024-01-01 10:30:00.000000", "o1", "x", "{}")]), landing)
    run()
    write_events(events([("driver_ping", "2024-01-01 10:40:00.000000", "o1", "x", "{}"),
                         ("delivered", "2024-01-01 10:50:00.000000", "o1", "x", "{}")]), landing)
    run()
    assert spark.read.parquet(out).count() == 1
    assert stateful.orders_in_progress(spark, ckpt).count() == 0


def test_aggregate_versions_are_bounded(spark):
    """Complete-mode tables keep only the newest versions; reads stay right."""
    import os
    from orderflow.sources import fixtures
    ev = fixtures.lifecycle_events(spark, "/root/testdata/sf0.001")
    root = scratch_path(spark, "test-versions")
    write_events(ev.repartition(4), f"{root}/landing")
    layout = layers.Layout(root)
    layers.run_bronze(spark, f"{root}/landing", layout, max_files=1)
    layers.run_silver(spark, layout)
    from orderflow.streaming.sinks import run_aggregate
    stream = (spark.readStream.schema(layers.silver_schema(spark))
              .option("maxFilesPerTrigger", "10").parquet(layout.table("silver")))
    run_aggregate(gold.order_header(stream), layout.table("hdr"), layout.checkpoint("hdr"))
    local = layout.table("hdr").removeprefix("file:")
    batches = os.listdir(layout.checkpoint("hdr").removeprefix("file:") + "/commits")
    versions = sorted(d for d in os.listdir(local) if d.startswith("v"))
    assert len(batches) > 2 and len(versions) == 2
    got = read_aggregate(spark, layout.table("hdr"))
    assert got.count() == gold.order_header(silver.order_items(ev)).count()
