"""Gold tables merged per day: equal to batch, idempotent, day by day."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from orderflow.operators import gold, rollups, silver
from orderflow.session import scratch_path
from orderflow.sources import fixtures
from orderflow.sources.events import write_events
from orderflow.streaming import files, layers, merged
from orderflow.streaming.merged import MergedTable, read_ledger, run_merged

ITEM = '{"items":[{"id":%d,"category_id":111,"menu_id":11,"brand_id":%d,"name":"a","price":2.0,"qty":1}]}'


def rows(df):
    def plain(v):
        if isinstance(v, list):
            return tuple(sorted(v))
        return round(v, 4) if isinstance(v, float) else v
    return sorted((tuple(plain(v) for v in r) for r in df.collect()), key=str)


@pytest.fixture(scope="module")
def built(spark):
    """Silver of all events in ten files, gold kept over ten micro-batches, by name."""
    ev = fixtures.lifecycle_events(spark, "/root/testdata/sf0.001").withColumn(
        "ts", F.when(F.substring("event_id", 1, 1) == "a", F.lit("no time")).otherwise(F.col("ts"))).filter("order_id LIKE '%-2024010%'")
    root = scratch_path(spark, "test-merged")
    layout = layers.Layout(root, "orderflow_merged_" + root.rsplit("-", 1)[-1])
    spark.sql(f"CREATE DATABASE {layout.database} LOCATION '{root}/_database'")
    items = silver.order_items(ev)
    items.repartition(10).write.saveAsTable(layout.table_name("silver"))
    tables = layers.run_gold_merged(spark, layout, max_files=1)
    return layout, tables, items


def test_all_tables_equal_batch_after_ten_batches(spark, built):
    layout, tables, items = built
    batch = {"order_header": gold.order_header(items), "item_sales_day": gold.item_sales_day(items),
             "brand_sales_day": gold.brand_sales_day(items, watermark=None, exact=True),
             "location_sales_hourly": gold.location_sales_hourly(items, watermark=None, exact=True)}
    for name, want in batch.items():
        assert read_ledger(spark, tables[name].path)["batch"] == 9
        by_name, by_ledger = spark.table(layout.table_name(name)), layers.merged_table(spark, layout, name)
        assert rows(by_name.select(*by_ledger.columns)) == rows(by_ledger)
        keys = [c for c in want.columns if c not in ("orders", "exact_orders")]
        assert rows(by_name.select(*keys)) == rows(want.select(*keys)), name
        if "exact_orders" in want.columns:
            own = [k for k in keys if not k.endswith("revenue") and k != "items_sold"]
            j = by_name.join(want.withColumnRenamed("orders", "o"), [F.expr("true")] if not own else own)
            bad = j.filter(F.abs(F.col("orders") - F.col("exact_orders")) >
                           4 * rollups.SKETCH_RSD * F.col("exact_orders") + 1)
            assert bad.count() == 0


def test_only_touched_days_are_written_and_old_versions_go(spark, built):
    layout, tables, _ = built
    t = tables["order_header"]
    for day in files.names(spark, t.path):
        if day.startswith("order_day="):
            ledger = read_ledger(spark, t.path)["days"][day.split("=")[1]]
            versions = [int(v[2:]) for v in files.names(spark, f"{t.path}/{day}")]
            assert 1 <= len(versions) <= 2 and max(versions) == ledger["v"]
    before = read_ledger(spark, t.path)
    one = spark.table(layout.table_name("silver")).filter("order_day = '2024-01-03'")
    assert one.count() > 0
    t.apply(one, 10)
    after = read_ledger(spark, t.path)
    assert after["touched"] == ["2024-01-03"]
    moved = [d for d in after["days"] if after["days"][d] != before["days"][d]]
    assert moved == ["2024-01-03"]
    by_day = spark.table(layout.table_name("order_header")).filter("order_day = DATE'2024-01-03'")
    assert rows(by_day) == rows(layers.merged_table(spark, layout, "order_header", ["2024-01-03"]).select(*by_day.columns))
    assert "order_day" in by_day._jdf.queryExecution().executedPlan().toString().split("PartitionFilters")[1][:60]


def test_replayed_batch_changes_nothing(spark, events):
    root = scratch_path(spark, "test-replay")
    ev = events([("order_created", f"2024-01-0{d} 10:00:00.000000", f"o{d}{k}", "x", ITEM % (k, k))
                 for d in (1, 2) for k in (1, 2, 3)])
    silver.order_items(ev).repartition(4).write.parquet(f"{root}/silver")
    stream = (spark.readStream.schema(layers.silver_schema(spark)).option("maxFilesPerTrigger", "1")
              .parquet(f"{root}/silver"))
    t = MergedTable(rollups.brand_sales_day(), f"{root}/t", f"{root}/ckpt")
    seen = []

    def twice(batch, batch_id):  # a run that fails after its ledger entry repeats the batch
        t.apply(batch, batch_id)
        once = read_ledger(spark, t.path)
        t.apply(batch, batch_id)
        t.apply(batch, max(0, batch_id - 1))
        assert read_ledger(spark, t.path) == once
        seen.append(batch_id)

    run_merged(stream, t, twice)
    assert len(seen) > 1
    schema = t.rollup.partial(silver.order_items(ev)).schema
    got = merged.read_merged(spark, t.path, t.rollup, schema)
    assert rows(got.select("brand_id", "orders", "items_sold")) == sorted([(k, 1, 1) for k in (1, 2, 3)] * 2)


def test_failure_before_the_ledger_is_redone(spark, events, monkeypatch):
    root = scratch_path(spark, "test-crash")
    silver.order_items(events([("order_created", "2024-01-01 10:00:00.000000", "o1", "x", ITEM % (1, 1))])).write.parquet(
        f"{root}/silver")
    t = MergedTable(rollups.order_header(), f"{root}/t", f"{root}/ckpt")

    def stream():
        return spark.readStream.schema(layers.silver_schema(spark)).parquet(f"{root}/silver")

    with monkeypatch.context() as m:
        m.setattr(files, "write_text", lambda *a: 1 / 0)
        with pytest.raises(Exception):
            run_merged(stream(), t)
    assert read_ledger(spark, t.path) is None
    run_merged(stream(), t)
    schema = t.rollup.partial(spark.read.parquet(f"{root}/silver")).schema
    assert merged.read_merged(spark, t.path, t.rollup, schema).collect()[0].order_revenue == 2.0
    other = MergedTable(rollups.order_header(), f"{root}/t", f"{root}/ckpt2")  # a lost checkpoint
    with pytest.raises(Exception, match="another stream"):
        run_merged(stream(), other)


def test_large_days_get_several_files(spark, events):
    root = scratch_path(spark, "test-shares")
    ev = events([("order_created", "2024-01-01 10:00:00.000000", f"o{k}", "x", ITEM % (1, 1)) for k in range(60)]
                + [("order_created", "2024-01-02 10:00:00.000000", "p", "x", ITEM % (1, 1))])
    silver.order_items(ev).write.parquet(f"{root}/silver")
    t = MergedTable(rollups.order_header(), f"{root}/t", f"{root}/ckpt", rows_per_file=10)
    run_merged(spark.readStream.schema(layers.silver_schema(spark)).parquet(f"{root}/silver"), t)
    days = read_ledger(spark, t.path)["days"]
    assert {d: x["rows"] for d, x in days.items()} == {"2024-01-01": 60, "2024-01-02": 1}
    parts = [n for n in files.names(spark, f"{t.path}/order_day=2024-01-01/v=0") if n.startswith("part-")]
    assert len(parts) == 6


def test_silver_files_follow_the_parameter(spark, events):
    root = scratch_path(spark, "test-silver-shares")
    write_events(events([("order_created", "2024-01-01 10:00:00.000000", f"o{k}", "x", ITEM % (1, 1))
                         for k in range(200)]), f"{root}/landing")
    layout = layers.Layout(root)
    layers.run_bronze(spark, f"{root}/landing", layout)
    layers.run_silver(spark, layout, files_per_day=3)
    sizes = [r["count"] for r in spark.read.parquet(layout.table("silver")).groupBy(F.input_file_name()).count().collect()]
    assert len(sizes) == 3 and sum(sizes) == 200 and max(sizes) < 100


def test_complete_tables_stay_readable_by_name(spark, events):
    """Each commit moves the view on before older versions go: after a first
    load, several more micro-batches and a run that fails midway."""
    root = scratch_path(spark, "test-named")
    layout = layers.Layout(root, "orderflow_named_" + root.rsplit("-", 1)[-1])
    landing, name = f"{root}/landing", layout.table_name("order_header")
    for k in range(5):
        write_events(events([("order_created", "2024-01-01 10:00:00.000000", f"o{k}", "x", ITEM % (1, 1))]).coalesce(1), landing)
        layers.run_bronze(spark, landing, layout)
        layers.run_silver(spark, layout)
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {layout.database}")
    layers.run_gold(spark, layout, ["order_header"], windowed=False, max_files=1)
    assert spark.table(name).count() == 5
    write_events(events([("order_created", "2024-01-02 10:00:00.000000", "late", "x", ITEM % (1, 1))]), landing)
    layers.run_bronze(spark, landing, layout)
    layers.run_silver(spark, layout)
    from orderflow.streaming import sinks
    removed, sinks._delete_older = sinks._delete_older, lambda *a: 1 / 0
    try:
        with pytest.raises(Exception):
            layers.run_gold(spark, layout, ["order_header"], windowed=False, max_files=1)
    finally:
        sinks._delete_older = removed
    assert spark.table(name).count() == 6  # the view moved on with the commit
    layers.run_gold(spark, layout, ["order_header"], windowed=False, max_files=1)
    assert spark.table(name).count() == 6
