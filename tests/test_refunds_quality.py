from __future__ import annotations

from orderflow.operators import quality, refunds

ITEM = '{"items":[{"id":1,"category_id":111,"menu_id":11,"brand_id":1,"name":"a","price":10.01,"qty":1}]}'


def log(events):
    rows = []
    # Five delivered orders at x taking 10, 20, 30, 40, 100 minutes.
    for i, m in enumerate([10, 20, 30, 40, 100]):
        rows += [("order_created", "2024-01-01 10:00:00.000000", f"o{i}", "x", ITEM),
                 ("delivered", f"2024-01-01 {10 + m // 60:02d}:{m % 60:02d}:00.000000", f"o{i}", "x", "{}")]
    rows.append(("order_created", "2024-01-01 10:00:00.000000", "open", "x", ITEM))
    return events(rows)


def test_decision_classes_and_money(spark, events):
    from orderflow.operators import gold, silver
    ev = log(events)
    header = gold.order_header(silver.order_items(ev))
    d = {r.order_id: r for r in refunds.refund_decisions(ev, header).collect()}
    assert "open" not in d  # not delivered
    assert d["o0"].refund_class == "none" and d["o0"].refund_usd == 0.0
    assert d["o3"].refund_class == "partial" and d["o3"].refund_usd == 5.01  # 10.01 / 2, HALF_UP
    assert d["o4"].refund_class == "full" and d["o4"].refund_usd == 10.01
    assert d["o4"].reason.startswith("late: 100 min, beyond P99")


def test_json_lines_valid_and_invalid(spark, events):
    dec = refunds.refund_decisions(log(events))
    v = refunds.valid_json(refunds.to_json_line(dec))
    assert v.filter("NOT valid").count() == 0
    bad = spark.createDataFrame([('{"refund_usd": 1}',), ("nope",), ('{"refund_usd":1,"refund_class":"x","reason":"r"}',)],
                                "decision_json string")
    assert refunds.valid_json(bad).filter("valid").count() == 0


def test_requests_routing(spark, events):
    ev = log(events)
    dec = refunds.refund_decisions(ev)
    import hashlib
    h = hashlib.md5(b"o4").hexdigest()
    req = spark.createDataFrame([("r1", f"late! {h.upper()}"), ("r2", "where is my food"),
                                 ("r3", "refund " + "0" * 32)], "request_id string, content string")
    routes = {r.request_id: r.route for r in refunds.match_requests(req, dec).collect()}
    assert routes == {"r1": "full", "r2": "no_order_id", "r3": "no_decision"}


def test_policy(spark, events):
    from orderflow.operators.delivery import delivery_percentiles
    ev = log(events)
    pct = delivery_percentiles(ev)
    checked = refunds.policy_check(refunds.refund_decisions(ev, None, pct), pct)
    r = refunds.policy_rate(checked).collect()[0]
    assert r.decisions == 5 and r.passed == 5 and r.pass_rate == 1.0


def test_all_stages_set(events):
    names = ["order_created", "gk_started", "gk_finished", "gk_ready", "driver_picked_up",
             "driver_ping", "delivered"]
    ev = events([(n, f"2024-01-01 10:{i * 5:02d}:00.000000", "o1", "x", "{}")
                 for i, n in enumerate(names)])
    r = quality.stage_durations(ev).collect()[0]
    assert (r.created_to_started, r.started_to_finished, r.finished_to_ready,
            r.ready_to_picked, r.picked_to_delivered, r.created_to_delivered) == (5, 5, 5, 5, 10, 30)


def test_missing_field_rate(events):
    ev = events([("driver_ping", "2024-01-01 10:00:00.000000", "o1", "x", '{"loc_lat":1,"loc_lon":2}'),
                 ("driver_ping", "2024-01-01 10:01:00.000000", "o1", "x", "{}"),
                 ("order_created", "2024-01-01 10:00:00.000000", "o1", "x", '{"items":[]}')])
    m = {(r.event_type, r.field): (r.events, r.missing, r.exceeded)
         for r in quality.missing_field_rate(ev).collect()}
    assert m[("driver_ping", "loc_lat")] == (2, 1, True)
    assert m[("driver_ping", "progress_pct")] == (2, 2, True)
    assert m[("order_created", "items")] == (1, 1, True)
    assert ("driver_picked_up", "route_points") not in m


def test_sequence_by_time(events):
    ev = events([("delivered", "2024-01-01 10:30:00.000000", "o1", "x", "{}"),
                 ("order_created", "2024-01-01 10:00:00.000000", "o1", "x", "{}"),
                 ("order_created", "2024-01-01 09:00:00.000000", "o2", "x", "{}")])
    s = {(r.order_id, r.event_type): r.sequence for r in quality.with_sequence(ev).collect()}
    assert s == {("o1", "order_created"): 0, ("o1", "delivered"): 1, ("o2", "order_created"): 0}


def test_sequence_of_a_long_order_and_of_no_order(events):
    rows = [("driver_ping", f"2024-01-01 10:{i // 60:02d}:{i % 60:02d}.000000", "hot", "x", "{}")
            for i in range(600)]
    rows.append(("order_created", "2024-01-01 09:00:00.000000", None, "x", "{}"))
    got = quality.with_sequence(events(rows)).collect()
    assert sorted(r.sequence for r in got if r.order_id == "hot") == list(range(600))
    assert [r.sequence for r in got if r.order_id is None] == [None]


def test_sequence_keeps_every_row_and_column(spark):
    from orderflow.sources import fixtures
    from pyspark.sql import functions as F
    ev = fixtures.lifecycle_events(spark, "/root/testdata/sf0.1").cache()
    got = quality.with_sequence(ev.repartition(8))
    assert got.columns == ev.columns and got.count() == ev.count()
    assert got.drop("sequence").exceptAll(ev.drop("sequence")).count() == 0
    bad = got.groupBy("order_id").agg(F.count("*").alias("n"), F.max("sequence").alias("top"),
                                      F.count_distinct("sequence").alias("d")).filter("n <> top + 1 or n <> d")
    assert bad.count() == 0


def test_header_pays_each_location_once(events):
    from orderflow.operators import gold, refunds, silver
    body = '{"items": [{"id": 1, "price": 20.0, "qty": 1}]}'
    rows = []
    for loc in ("a", "b"):
        rows += [("order_created", "2024-01-01 10:00:00.000000", "o1", loc, body),
                 ("delivered", "2024-01-01 11:00:00.000000", "o1", loc, "{}")]
    ev = events(rows)
    d = refunds.refund_decisions(ev, header=gold.order_header(silver.order_items(ev))).collect()
    assert sorted((r.location, r.refund_usd) for r in d) == [("a", 20.0), ("b", 20.0)]


def test_left_join_nonnull_keeps_null_keys(spark):
    from orderflow.operators.joins import left_join_nonnull
    left = spark.createDataFrame([(1, "a"), (None, "b"), (3, "c")], "k int, v string")
    right = spark.createDataFrame([(1, "one")], "rk int, name string")
    rows = sorted(left_join_nonnull(left, right, "k", "rk").collect(), key=lambda r: r.v)
    assert [(r.v, r.name) for r in rows] == [("a", "one"), ("b", None), ("c", None)]
