from __future__ import annotations

import datetime as dt

from orderflow.plans import dashboards


def brand_sales(spark):
    return spark.createDataFrame(
        [(1, dt.date(2024, 1, 1), 3, 100.0), (2, dt.date(2024, 1, 2), 1, 25.0)],
        "brand_id int, day date, items_sold bigint, brand_revenue double")


def test_day_filter_and_all_time(spark):
    assert dashboards.gross_revenue(brand_sales(spark)).collect()[0].value == 125.0
    assert dashboards.gross_revenue(brand_sales(spark), day="2024-01-02").collect()[0].value == 25.0


def test_run_rate_parameter_types(spark):
    r = dashboards.run_rate(brand_sales(spark), goal="500").collect()[0]
    assert r.goal == "500" and abs(r.pct - 0.25) < 1e-12
    df = dashboards.run_rate(brand_sales(spark))
    assert dict(df.dtypes) == {"revenue": "double", "goal": "string", "pct": "double"}


def test_hourly_since_and_order(spark):
    ls = spark.createDataFrame(
        [("b", dt.datetime(2024, 1, 2, 5), 1.0), ("a", dt.datetime(2024, 1, 2, 5), 2.0),
         ("a", dt.datetime(2024, 1, 1, 5), 4.0)],
        "location string, hour_ts timestamp, revenue double")
    rows = dashboards.hourly_trend(ls, since="2024-01-02 12:00:00").collect()
    assert [(r.location, r.revenue) for r in rows] == [("a", 2.0), ("b", 1.0)]


def test_widget_rollup_and_sort(spark):
    df = spark.createDataFrame([("x", 1.0), ("y", 5.0), ("x", 2.0)], "label string, value double")
    rows = dashboards.widget(df, ["label"], "value", descending=True).collect()
    assert [(r.label, r["sum(value)"]) for r in rows] == [("y", 5.0), ("x", 3.0)]
    assert dashboards.widget(df, ["label"]).count() == 3
