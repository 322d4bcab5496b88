from __future__ import annotations

from orderflow.functions import sql as sql_objects
from orderflow.operators import delivery

T0 = "2024-01-01 10:00:00.000000"


def lifecycle(events):
    return events([
        ("order_created", T0, "o1", "x", "{}"),
        ("gk_started", "2024-01-01 10:02:30.000000", "o1", "x", "{}"),
        ("delivered", "2024-01-01 10:30:00.000000", "o1", "x", "{}"),
        ("order_created", T0, "o2", "x", "{}"),
        ("delivered", "2024-01-01 11:00:00.000000", "o2", "x", "{}"),
        ("order_created", T0, "o3", "y", "{}"),
    ])


def test_percentiles_interpolate(events):
    p = {r.location: r for r in delivery.delivery_percentiles(lifecycle(events)).collect()}
    assert set(p) == {"x"}  # y has no delivered order
    assert p["x"].P50 == 45.0 and p["x"].P75 == 52.5


def test_approx_percentiles_return_existing_values(events):
    p = delivery.delivery_percentiles(lifecycle(events), approx=True).collect()[0]
    assert p.P50 in (30.0, 60.0)


def test_sql_functions_unknown_keys(spark, events):
    lifecycle(events).createOrReplaceTempView("edge_events")
    sql_objects.register_functions(spark, "edge_events")
    assert spark.sql("SELECT * FROM get_order_details('nope')").count() == 0
    rows = spark.sql("SELECT * FROM get_order_delivery_time('nope')").collect()
    assert len(rows) == 1 and rows[0].order_id == "nope" and rows[0].duration_minutes is None
    assert spark.sql("SELECT * FROM get_location_timings('nope')").count() == 0
    r = spark.sql("SELECT * FROM get_order_delivery_time('o1')").collect()[0]
    assert abs(r.duration_minutes - 30.0) < 1e-6
    assert spark.sql("SELECT * FROM get_order_details('o1')").count() == 3
    t = spark.sql("SELECT * FROM get_location_timings('x')").collect()[0]
    assert abs(t.P50 - 45.0) < 1e-6


def test_lateral_keeps_unmatched_keys_with_left_join(spark, events):
    lifecycle(events).createOrReplaceTempView("edge_events")
    sql_objects.register_functions(spark, "edge_events")
    df = spark.sql("""SELECT k.id, d.location FROM VALUES ('x'), ('nope') AS k(id)
                      LEFT JOIN LATERAL get_location_timings(k.id) d""")
    assert sorted((r.id, r.location) for r in df.collect()) == [("nope", None), ("x", "x")]


def test_order_details_set_form(spark, events):
    ev = lifecycle(events)
    keys = spark.createDataFrame([("o2",), ("zz",)], "order_id string")
    assert delivery.order_details(ev, keys).count() == 2


def test_durations_whole_seconds(events):
    ev = events([("order_created", "2024-01-01 10:00:00.900000", "o1", "x", "{}"),
                 ("delivered", "2024-01-01 10:01:00.100000", "o1", "x", "{}")])
    r = delivery.order_durations(ev).collect()[0]
    assert r.duration_minutes == 1.0  # unix_timestamp drops fractions
