from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from orderflow.operators import gold, silver

ITEMS = ('{"items":[{"id":1,"category_id":111,"menu_id":11,"brand_id":1,"name":"a","price":2.5,"qty":2},'
         '{"id":2,"category_id":221,"menu_id":22,"brand_id":2,"name":"b","price":1.0,"qty":3}]}')


def test_silver_explodes_and_prices(events):
    ev = events([("order_created", "2024-01-01 10:15:00.000000", "o1", "x", ITEMS),
                 ("gk_started", "2024-01-01 10:16:00.000000", "o1", "x", "{}")])
    rows = silver.order_items(ev).orderBy("item_id").collect()
    assert [(r.item_id, r.qty, r.extended_price) for r in rows] == [(1, 2, 5.0), (2, 3, 3.0)]
    assert str(rows[0].order_day) == "2024-01-01"
    assert silver.order_items(ev).columns == silver.SILVER_COLUMNS


@pytest.mark.parametrize("body", ["{}", '{"items":[]}', "bad", None])
def test_no_items_no_row(events, body):
    ev = events([("order_created", "2024-01-01 10:15:00.000000", "o1", "x", body)])
    assert silver.order_items(ev).count() == 0


def test_bad_time_tolerant_and_strict(events):
    ev = events([("order_created", "bad", "o1", "x", ITEMS)])
    rows = silver.order_items(ev).collect()
    assert len(rows) == 2 and rows[0].order_ts is None and rows[0].order_day is None
    with pytest.raises(Exception):
        silver.order_items(ev, strict=True).collect()


def test_header_counts_rows_and_brands(events):
    ev = events([("order_created", "2024-01-01 10:15:00.000000", "o1", "x", ITEMS)])
    h = gold.order_header(silver.order_items(ev)).collect()[0]
    assert (h.order_revenue, h.total_qty, h.total_items) == (8.0, 5, 2)
    assert sorted(h.brands_in_order) == [1, 2]


def test_approx_orders_within_bound(spark):
    from orderflow.plans.registry import QUERIES
    df = QUERIES["gold_brand_sales_day"](spark, "/root/testdata/sf0.001")
    assert df.filter(~F.col("orders_ok")).count() == 0


def test_parse_bodies_types(events):
    ev = events([("driver_ping", "2024-01-01 10:15:00.000000", "o1", "x",
                  '{"progress_pct": 12.5, "loc_lat": 1.0}')])
    r = silver.parse_bodies(ev).collect()[0]
    assert r.b_progress_pct == 12.5 and r.b_loc_lat == 1.0 and r.b_loc_lon is None
