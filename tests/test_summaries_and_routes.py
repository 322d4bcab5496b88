"""Day summaries, routed streams and the clustered log on small inputs."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from orderflow.operators import delivery, gold, quality, silver, sketches
from orderflow.session import scratch_path
from orderflow.sources import fixtures
from orderflow.sources.events import read_events_stream, read_lines_stream, write_events
from orderflow.sources.tables import write_event_log
from orderflow.streaming import layers, routed, stateful
from orderflow.streaming.sinks import run_append

SF = "/root/testdata/sf0.001"
ITEM = '{"items":[{"id":1,"category_id":111,"menu_id":11,"brand_id":1,"name":"a","price":2.0,"qty":1}]}'


def test_moments_equal_the_summary_over_several_loads(spark):
    ev = fixtures.lifecycle_events(spark, SF)
    load = F.pmod(F.dayofyear(F.to_date("ts")), F.lit(4))
    parts = None
    for k in range(4):
        m = sketches.stage_moments(ev.filter(load == k))
        parts = m if parts is None else parts.unionByName(m)
    got = {r.location: r for r in sketches.moments_summary(parts, "location").collect()}
    want = {r.location: r for r in quality.stage_summary(ev).collect()}
    assert got.keys() == want.keys()
    for loc, r in want.items():
        for c in r.asDict():
            a, b = got[loc][c], r[c]
            assert a == b or abs(a - b) <= 1e-9 * max(1.0, abs(b)), (loc, c, a, b)


def test_moments_do_not_lose_small_deviations(spark):
    """Far means with tiny spread: sums of squares would cancel."""
    def stage(n, mean, m2):
        return (n, mean, m2)
    rows = [("x", *[stage(2, 1e9 + d, 0.5)] * len(sketches.STAGE_NAMES)) for d in (0.0, 1.0)]
    schema = "location string, " + ", ".join(f"{n} struct<n:bigint,mean:double,m2:double>" for n in sketches.STAGE_NAMES)
    r = sketches.moments_summary(spark.createDataFrame(rows, schema), "location").collect()[0]
    assert abs(r.created_to_delivered_std - (2 / 3) ** 0.5) < 1e-9 and r.created_to_delivered_n == 4


def test_sketch_percentiles_over_many_values(spark):
    n = 60_000
    times = spark.range(n).select(
        F.col("id").cast("string").alias("order_id"), F.lit("x").alias("location"),
        F.timestamp_seconds(F.lit(1704067200) + F.col("id") % 5 * 86400).alias("c"),
        (F.pmod(F.xxhash64("id"), F.lit(100_000)) * 6).alias("s"))
    ev = times.select("order_id", "location", F.inline(F.array(
        F.struct(F.lit("order_created").alias("event_type"), F.date_format("c", "yyyy-MM-dd HH:mm:ss").alias("ts")),
        F.struct(F.lit("delivered").alias("event_type"), F.date_format(
            F.timestamp_seconds(F.unix_timestamp("c") + F.col("s")), "yyyy-MM-dd HH:mm:ss").alias("ts")))))
    days = sketches.duration_sketches(ev)
    assert days.count() == 5
    r = sketches.percentiles_of(days, F.col("location")).collect()[0]
    m = sorted(x.s / 60 for x in times.select("s").collect())
    for name, q in zip(("P50", "P75", "P99"), delivery.QUANTILES):
        rank = sum(x <= r[name] for x in m) / n
        assert abs(rank - q) <= sketches.KLL_RANK_ERROR + 1 / n
    assert r.orders == n


def test_late_rows_are_those_a_windowed_stream_drops(spark, events):
    root = scratch_path(spark, "test-routes")
    landing = f"{root}/landing"
    table = routed.late_rows(f"{root}/routed", f"{root}/ckpt")
    loads = [["01 10:10:00", "01 13:30:00", "bad time"], ["01 10:59:00", "01 09:10:00", "01 15:10:00", "01 11:10:00"],
             ["01 10:00:00", "01 11:59:00", "01 12:00:00", None], ["02 10:10:00"], ["02 11:10:00"]]
    for k, times in enumerate(loads):
        write_events(events([("order_created", f"2024-01-{t}.000000" if t else None, f"o{k}{i}", "x", ITEM)
                             for i, t in enumerate(times)]), landing)
        items = silver.order_items(read_events_stream(spark, landing))
        table.run(items)
        run_append(gold.location_sales_windowed(items), f"{root}/windowed", f"{root}/windowed-ckpt")
    rows = table.read(spark, layers.silver_schema(spark))
    got = sorted((r.route, str(r.order_ts)[8:16]) for r in rows.collect())
    assert [x for x in got if x[0] != "on_time"] == [
        ("late", "01 09:10"), ("late", "01 10:00"), ("late", "01 11:59"), ("no_time", ""), ("no_time", "")]
    ledger = table.ledger(spark)
    assert ledger["totals"] == {"input": 13, "on_time": 8, "late": 3, "no_time": 2}
    # the same rows are missing from the hours that the windowed stream has closed
    on_time = rows.filter("route = 'on_time'").groupBy(F.date_trunc("hour", "order_ts").alias("hour_ts")).agg(
        F.sum("extended_price").alias("r"))
    closed = {r.hour_ts: r.revenue for r in spark.read.parquet(f"{root}/windowed").collect()}
    assert closed and all(closed[h] == v for h, v in ((r.hour_ts, r.r) for r in on_time.collect()) if h in closed)
    assert len(closed) == 5


def test_routes_are_written_once(spark, events):
    root = scratch_path(spark, "test-routes-once")
    table = routed.late_rows(f"{root}/routed", f"{root}/ckpt")
    batch = silver.order_items(events([("order_created", "2024-01-01 10:00:00.000000", "o", "x", ITEM)]))
    for batch_id in (0, 0, 1, 0):
        table.apply(batch, batch_id)
    assert table.ledger(spark)["totals"]["input"] == 2
    assert table.read(spark, batch.schema, "on_time").count() == 2


LINES = ['{"event_id":"a","event_type":"order_created","ts":"t","gk_id":"g","location":"x","order_id":"o","sequence":1,"body":"{}"}',
         "", "   ", '{"event_id":"b"', "not json", '[{"event_id":"c"}]', "[]", "5", '"text"', "null", '{"event_id":"d","sequence":"x"}',
         '{"event_id":{"deep":1}}', "{}", ' {"event_id":"e","more":[1,2]} ', '{"event_id":"f"} trailing',
         '{"event_id":"g"}{"event_id":"h"}', '{"event_id":"i"},{"event_id":"j"}']


def test_every_line_is_accounted_for(spark):
    root = scratch_path(spark, "test-lines")
    spark.createDataFrame([(x,) for x in LINES], "value string").write.text(f"{root}/landing")
    table = routed.quarantine(f"{root}/routed", f"{root}/ckpt")
    lines = routed.event_lines(read_lines_stream(spark, f"{root}/landing"))
    table.run(lines)
    got = table.read(spark, lines.schema)
    by = {}
    for r in got.collect():
        by.setdefault(r.route, []).append(r.line if r.line is not None else r.event_id)
    assert sum(map(len, by.values())) == len(LINES) == table.ledger(spark)["totals"]["input"]
    assert sorted(map(str, by["good"])) == ["None", "a", "e", '{"deep":1}']
    assert sorted(by["blank"]) == ["", "   "]
    assert {'{"event_id":"b"', "not json", '[{"event_id":"c"}]', "[]", "5", '"text"', "null",
            '{"event_id":"f"} trailing', '{"event_id":"g"}{"event_id":"h"}', '{"event_id":"i"},{"event_id":"j"}'} == set(by["broken"])
    assert '{"event_id":"d","sequence":"x"}' in by["wrong_type"]
    whole = got.filter("event_id = 'a'").collect()[0]
    assert (whole.sequence, whole.body, whole.ts) == (1, "{}", "t")


@pytest.fixture(scope="module")
def log(spark):
    root = scratch_path(spark, "test-log")
    name = "event_log_" + root.rsplit("-", 1)[-1]
    ev = fixtures.lifecycle_events(spark, SF).withColumn("order_id", F.when(F.col("location") != "loc2", F.col("order_id")))
    write_event_log(ev, name, root, 4)
    return spark.table(name), spark.table(f"{name}_no_order"), ev


def test_log_is_split_and_whole(spark, log):
    by_order, rest, ev = log
    assert by_order.filter("order_id IS NULL").count() == 0 and rest.filter("order_id IS NOT NULL").count() == 0
    assert by_order.unionByName(rest).exceptAll(ev).count() == 0 and by_order.count() + rest.count() == ev.count()


def test_work_per_order_needs_no_exchange(spark, log):
    by_order = log[0]
    plans = {"header": gold.order_header(silver.order_items(by_order)), "times": delivery.order_times(by_order),
             "sequence": quality.with_sequence(by_order), "collected": stateful.completed_orders_batch(by_order),
             "rollup": delivery.order_rollup(by_order), "stages": quality.stage_durations(by_order)}
    for key, value in (("spark.sql.autoBroadcastJoinThreshold", "-1"),):
        old = spark.conf.get(key)
        spark.conf.set(key, value)
        try:
            for name, df in plans.items():
                plan = df._jdf.queryExecution().executedPlan().toString()
                assert "Exchange" not in plan, (name, plan)
        finally:
            spark.conf.set(key, old)
