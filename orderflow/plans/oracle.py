"""DuckDB SQL for the oracle check, one string per registered query.

The driver registers the parquet tables as views (``orders``,
``lineitem``, ``events`` ...).  Each string recomputes, from those base
tables, what the Spark query computes through the library.
"""

from __future__ import annotations

# Fixed-value lists below restate the fixture mappings (see
# ``sources/fixtures.py``) in SQL.

SILVER_A = """
silver AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS order_id,
         CAST(c_nationkey AS VARCHAR) AS gk_id,
         n_name AS location,
         o_orderdate AS order_ts,
         CAST(o_orderdate AS DATE) AS order_day,
         CAST(p_partkey AS INTEGER) AS item_id,
         b * 10 + p_size % 3 AS menu_id,
         (b * 10 + p_size % 3) * 10
           + list_position(['ECONOMY','LARGE','MEDIUM','PROMO','SMALL','STANDARD'], p_type) AS category_id,
         b AS brand_id,
         p_name AS item_name,
         p_retailprice AS price,
         CAST(l_quantity AS INTEGER) AS qty,
         p_retailprice * CAST(l_quantity AS INTEGER) AS extended_price
  FROM lineitem
  JOIN (SELECT *, TRY_CAST(regexp_extract(p_brand, '[0-9]+') AS INTEGER) AS b FROM part)
    ON l_partkey = p_partkey
  JOIN orders ON o_orderkey = l_orderkey
  JOIN customer ON c_custkey = o_custkey
  JOIN nation ON n_nationkey = c_nationkey
)"""

# Mapping B: all lifecycle events, typed.
EVENTS_B = """
ev AS (
  SELECT 'u' || CAST(user_id AS VARCHAR) || '-' || strftime(ts, '%Y%m%d') AS order_id,
         'loc' || CAST(user_id % 5 AS VARCHAR) AS location,
         CASE event_type WHEN 'view' THEN 'order_created' WHEN 'click' THEN 'gk_started'
              WHEN 'signup' THEN 'driver_picked_up' WHEN 'error' THEN 'driver_ping'
              WHEN 'purchase' THEN 'delivered' END AS event_type,
         ts, value, props, event_id AS src_event_id,
         md5('event:' || CAST(event_id AS VARCHAR)) AS event_id,
         TRY_CAST(regexp_extract(props, '[0-9]+') AS INTEGER) AS k
  FROM events
)"""

SILVER_B = """
silver AS (
  SELECT order_id, location AS gk_id, location, ts AS order_ts, CAST(ts AS DATE) AS order_day,
         k AS item_id, (k % 10 + 1) * 10 + k % 3 AS menu_id,
         ((k % 10 + 1) * 10 + k % 3) * 10 + k % 7 AS category_id,
         k % 10 + 1 AS brand_id, 'item' || CAST(k AS VARCHAR) AS item_name,
         value AS price, 1 AS qty, value * 1 AS extended_price
  FROM ev WHERE event_type = 'order_created'
)"""

TS = "'%Y-%m-%d %H:%M:%S.%f'"


def with_(*ctes: str) -> str:
    return "WITH " + ",".join(ctes)


ORACLE: dict[str, str] = {}

ORACLE["silver_order_items"] = with_(SILVER_A) + f"""
SELECT order_id, gk_id, location, strftime(order_ts, {TS}) AS order_ts,
       strftime(order_day, '%Y-%m-%d') AS order_day, item_id, menu_id, category_id, brand_id,
       item_name, price, qty, round(extended_price, 2) AS extended_price
FROM silver"""

ORACLE["gold_order_header"] = with_(SILVER_A) + """
SELECT order_id, gk_id, location, strftime(order_day, '%Y-%m-%d') AS order_day,
       round(sum(extended_price), 2) AS order_revenue,
       CAST(sum(qty) AS BIGINT) AS total_qty,
       count(item_id) AS total_items,
       array_to_string(list_sort(list(DISTINCT brand_id)), ',') AS brands_in_order
FROM silver GROUP BY order_id, gk_id, location, order_day"""

ORACLE["gold_item_sales_day"] = with_(SILVER_A) + """
SELECT item_id, menu_id, category_id, brand_id, strftime(order_day, '%Y-%m-%d') AS day,
       CAST(sum(qty) AS BIGINT) AS units_sold, round(sum(extended_price), 2) AS gross_revenue
FROM silver GROUP BY item_id, menu_id, category_id, brand_id, order_day"""

ORACLE["gold_brand_sales_day"] = with_(SILVER_A) + """
SELECT brand_id, strftime(order_day, '%Y-%m-%d') AS day,
       CAST(sum(qty) AS BIGINT) AS items_sold, round(sum(extended_price), 2) AS brand_revenue,
       true AS orders_ok
FROM silver GROUP BY brand_id, order_day"""

ORACLE["gold_location_hourly"] = with_(EVENTS_B, SILVER_B) + f"""
SELECT location, strftime(date_trunc('hour', order_ts), {TS}) AS hour_ts,
       round(sum(extended_price), 2) AS revenue, true AS orders_ok
FROM silver GROUP BY location, date_trunc('hour', order_ts)"""

# ---- dashboards ----------------------------------------------------------

ORACLE["dash_gross_revenue"] = with_(SILVER_A) + """
SELECT round(sum(extended_price), 2) AS value, 'Gross Revenue Today' AS label FROM silver"""

HEADER_A = """
header AS (
  SELECT order_id, gk_id, location, order_day, sum(extended_price) AS order_revenue,
         sum(qty) AS total_qty
  FROM silver GROUP BY order_id, gk_id, location, order_day
)"""

ORACLE["dash_orders"] = with_(SILVER_A, HEADER_A) + """
SELECT count(order_id) AS value, 'Orders Today (HLL ±2 %)' AS label FROM header"""

ORACLE["dash_basket"] = with_(SILVER_A, HEADER_A) + """
SELECT round(avg(total_qty), 2) AS avg_basket_qty,
       round(avg(order_revenue), 2) AS avg_basket_total_price
FROM header"""

ORACLE["dash_widget_counter"] = with_(SILVER_A, HEADER_A) + """
SELECT round(avg(total_qty), 2) AS avg_basket_qty FROM header"""

ORACLE["dash_run_rate"] = with_(SILVER_A) + """
SELECT round(sum(extended_price), 2) AS revenue, '250000' AS goal,
       round(sum(extended_price) / 250000.0, 6) AS pct
FROM silver"""

ORACLE["dash_hourly"] = with_(EVENTS_B, SILVER_B) + f"""
SELECT strftime(date_trunc('hour', order_ts), {TS}) AS hour_ts, location,
       round(sum(extended_price), 2) AS revenue
FROM silver GROUP BY date_trunc('hour', order_ts), location"""

ORACLE["dash_widget_hourly"] = with_(EVENTS_B, SILVER_B) + f"""
SELECT location, strftime(date_trunc('hour', order_ts), {TS}) AS hour_ts,
       round(sum(extended_price), 2) AS "sum(revenue)"
FROM silver GROUP BY date_trunc('hour', order_ts), location"""

ORACLE["dash_widget_bar"] = with_(SILVER_A) + """
SELECT 'Gross Revenue Today' AS label, round(sum(extended_price), 2) AS "sum(value)" FROM silver"""

# ---- delivery times --------------------------------------------------------

ORDER_TIMES_B = """
order_times AS (
  SELECT order_id, location,
         max(CASE WHEN event_type = 'order_created' THEN ts END) AS order_created_time,
         max(CASE WHEN event_type = 'delivered' THEN ts END) AS delivered_time
  FROM ev GROUP BY order_id, location
)"""

PCT_B = """
pct AS (
  SELECT location,
         quantile_cont(m, 0.50) AS P50, quantile_cont(m, 0.75) AS P75,
         quantile_cont(m, 0.99) AS P99
  FROM (SELECT location,
               date_diff('second', order_created_time, delivered_time) / 60 AS m
        FROM order_times
        WHERE order_created_time IS NOT NULL AND delivered_time IS NOT NULL)
  GROUP BY location
)"""

ORACLE["order_times"] = with_(EVENTS_B, ORDER_TIMES_B) + f"""
SELECT order_id, location, strftime(order_created_time, {TS}) AS order_created_time,
       strftime(delivered_time, {TS}) AS delivered_time
FROM order_times"""

ORACLE["delivery_percentiles"] = with_(EVENTS_B, ORDER_TIMES_B, PCT_B) + """
SELECT location, round(P50, 4) AS P50, round(P75, 4) AS P75, round(P99, 4) AS P99 FROM pct"""

ORACLE["delivery_view_sql"] = ORACLE["delivery_percentiles"]

ORACLE["location_timings_fn"] = with_(EVENTS_B, ORDER_TIMES_B, PCT_B) + """
SELECT location,
       round(CAST(CAST(P50 AS FLOAT) AS DOUBLE), 4) AS P50,
       round(CAST(CAST(P75 AS FLOAT) AS DOUBLE), 4) AS P75,
       round(CAST(CAST(P99 AS FLOAT) AS DOUBLE), 4) AS P99
FROM pct"""

DURATIONS_B = f"""
SELECT order_id, strftime(min(ts), {TS}) AS creation_time, strftime(max(ts), {TS}) AS delivery_time,
       round(CAST(CAST(date_diff('second', min(ts), max(ts)) / 60 AS FLOAT) AS DOUBLE), 4)
         AS duration_minutes
FROM ev GROUP BY order_id"""

ORACLE["order_durations"] = with_(EVENTS_B) + DURATIONS_B

ORACLE["order_delivery_time_fn"] = with_(EVENTS_B) + DURATIONS_B + """
UNION ALL SELECT 'no-such-order', NULL, NULL, NULL"""

BODY_B = """CASE WHEN event_type = 'order_created'
            THEN to_json({'items': [{'id': k, 'category_id': ((k % 10 + 1) * 10 + k % 3) * 10 + k % 7,
                                       'menu_id': (k % 10 + 1) * 10 + k % 3, 'brand_id': k % 10 + 1,
                                       'name': 'item' || CAST(k AS VARCHAR), 'price': value,
                                       'qty': 1}]})::VARCHAR
            ELSE props END"""

ORACLE["order_details_fn"] = with_(EVENTS_B) + f"""
SELECT order_id, event_type, strftime(ts, {TS}) AS ts, location, {BODY_B} AS body
FROM ev"""

# ---- dimensions ---------------------------------------------------------------

DIMS_A = """
p AS (SELECT *, TRY_CAST(regexp_extract(p_brand, '[0-9]+') AS INTEGER) AS b FROM part),
pc AS (SELECT *, b * 10 + p_size % 3 AS m,
              (b * 10 + p_size % 3) * 10
                + list_position(['ECONOMY','LARGE','MEDIUM','PROMO','SMALL','STANDARD'], p_type) AS c
       FROM p),
brand AS (SELECT DISTINCT CAST(b AS BIGINT) AS id, 'Brand#' || CAST(b AS VARCHAR) AS name FROM pc),
menu AS (SELECT DISTINCT CAST(m AS BIGINT) AS id, 'menu' || CAST(m AS VARCHAR) AS name,
                CAST(b AS BIGINT) AS brand_id FROM pc),
category AS (SELECT DISTINCT CAST(c AS BIGINT) AS id, p_type AS name, CAST(m AS BIGINT) AS menu_id,
                    CAST(b AS BIGINT) AS brand_id FROM pc),
item AS (SELECT p_partkey AS id, p_name AS name, p_retailprice AS price, CAST(b AS BIGINT) AS brand_id,
                CAST(m AS BIGINT) AS menu_id, CAST(c AS BIGINT) AS category_id FROM pc)"""

ORACLE["dims_loaded"] = with_(DIMS_A) + """
SELECT 'brand' AS "table", count(*) AS rows FROM brand
UNION ALL SELECT 'menu', count(*) FROM menu
UNION ALL SELECT 'category', count(*) FROM category
UNION ALL SELECT 'item', count(*) FROM item"""


def _integrity_sql() -> str:
    from ..schemas import DIM_KEYS, DIM_SCHEMAS
    parts = []
    for name, schema in DIM_SCHEMAS.items():
        for f in schema.fields:
            if not f.nullable:
                parts.append(f"SELECT '{name}' AS \"table\", 'not_null' AS rule, '{f.name}' AS \"column\", "
                             f"count(*) FILTER (WHERE {f.name} IS NULL) AS violations FROM {name}")
        pk = DIM_KEYS[name]["pk"]
        parts.append(f"SELECT '{name}', 'primary_key', '{pk}', count(*) FROM "
                     f"(SELECT {pk} FROM {name} GROUP BY {pk} HAVING count(*) > 1)")
        for fk, parent in DIM_KEYS[name]["fk"].items():
            ppk = DIM_KEYS[parent]["pk"]
            parts.append(f"SELECT '{name}', 'foreign_key', '{fk}->{parent}', count(*) FROM {name} x "
                         f"WHERE x.{fk} IS NOT NULL AND NOT EXISTS "
                         f"(SELECT 1 FROM {parent} y WHERE y.{ppk} = x.{fk})")
    return with_(DIMS_A) + "\n" + "\nUNION ALL ".join(parts)


ORACLE["dims_integrity"] = _integrity_sql()

ORACLE["brand_sales_enriched"] = with_(SILVER_A) + """
SELECT brand_id, 'Brand#' || CAST(brand_id AS VARCHAR) AS brand_name,
       strftime(order_day, '%Y-%m-%d') AS day, CAST(sum(qty) AS BIGINT) AS items_sold,
       round(sum(extended_price), 2) AS brand_revenue
FROM silver GROUP BY brand_id, order_day"""

ORACLE["item_sales_enriched"] = with_(SILVER_A) + """
SELECT s.item_id, pt.p_name AS item_name, 'menu' || CAST(s.menu_id AS VARCHAR) AS menu_name,
       pt.p_type AS category_name, 'Brand#' || CAST(s.brand_id AS VARCHAR) AS brand_name,
       strftime(s.order_day, '%Y-%m-%d') AS day, CAST(sum(s.qty) AS BIGINT) AS units_sold,
       round(sum(s.extended_price), 2) AS gross_revenue
FROM silver s JOIN part pt ON pt.p_partkey = s.item_id
GROUP BY s.item_id, pt.p_name, s.menu_id, pt.p_type, s.brand_id, s.order_day"""

# ---- refunds ---------------------------------------------------------------------

DECISIONS_B = """
dur AS (
  SELECT order_id, location,
         CAST(date_diff('second', min(ts), max(ts)) / 60 AS FLOAT) AS d
  FROM ev GROUP BY order_id, location
  HAVING max(CASE WHEN event_type = 'delivered' THEN 1 ELSE 0 END) = 1
),
rev AS (SELECT order_id, sum(value) AS r FROM ev WHERE event_type = 'order_created' GROUP BY order_id),
j AS (
  SELECT dur.order_id, dur.location, CAST(d AS DOUBLE) AS d, P75, P99, r,
         CASE WHEN P99 IS NOT NULL AND d >= P99 THEN 'full'
              WHEN P75 IS NOT NULL AND d >= P75 THEN 'partial' ELSE 'none' END AS cls
  FROM dur LEFT JOIN pct ON pct.location = dur.location LEFT JOIN rev ON rev.order_id = dur.order_id
),
decisions AS (
  SELECT order_id, location, d, P75, cls AS refund_class,
         CAST(round(CAST(coalesce(r, 0.0) AS DECIMAL(18,2))
                    * CASE cls WHEN 'full' THEN 1.0 WHEN 'partial' THEN 0.5 ELSE 0.0 END, 2)
              AS DOUBLE) AS refund_usd,
         CASE WHEN P75 IS NULL OR d IS NULL THEN 'no delivery-time reference for this location'
              WHEN cls = 'full' THEN 'late: ' || CAST(CAST(round(d) AS BIGINT) AS VARCHAR)
                   || ' min, beyond P99 of ' || CAST(CAST(round(P99) AS BIGINT) AS VARCHAR) || ' min'
              WHEN cls = 'partial' THEN 'late: ' || CAST(CAST(round(d) AS BIGINT) AS VARCHAR)
                   || ' min, beyond P75 of ' || CAST(CAST(round(P75) AS BIGINT) AS VARCHAR) || ' min'
              ELSE 'on time: ' || CAST(CAST(round(d) AS BIGINT) AS VARCHAR)
                   || ' min, within P75 of ' || CAST(CAST(round(P75) AS BIGINT) AS VARCHAR) || ' min'
         END AS reason
  FROM j
)"""

ORACLE["refund_decisions"] = with_(EVENTS_B, ORDER_TIMES_B, PCT_B, DECISIONS_B) + """
SELECT order_id, location, round(d, 4) AS duration_minutes, refund_usd, refund_class, reason
FROM decisions"""

ORACLE["refund_requests"] = with_(EVENTS_B, ORDER_TIMES_B, PCT_B, DECISIONS_B) + """
SELECT md5('request:' || o.order_id) AS request_id, md5(o.order_id) AS order_hash,
       x.order_id, coalesce(x.refund_class, 'no_decision') AS route, x.refund_usd
FROM (SELECT DISTINCT order_id FROM ev) o LEFT JOIN decisions x ON x.order_id = o.order_id"""

ORACLE["refund_json_valid"] = with_(EVENTS_B, ORDER_TIMES_B, PCT_B, DECISIONS_B) + """
SELECT order_id, refund_class, refund_usd, true AS valid FROM decisions"""

ORACLE["refund_policy_rate"] = with_(EVENTS_B, ORDER_TIMES_B, PCT_B, DECISIONS_B) + """
SELECT location, count(*) AS decisions,
       CAST(sum(CASE WHEN refund_usd = 0 OR d >= P75 THEN 1 ELSE 0 END) AS BIGINT) AS passed,
       round(avg(CASE WHEN refund_usd = 0 OR d >= P75 THEN 1.0 ELSE 0.0 END), 4) AS pass_rate
FROM decisions GROUP BY location"""

# ---- quality -----------------------------------------------------------------------

STAGE_TIMES_B = """
st AS (
  SELECT order_id, location,
         min(ts) FILTER (WHERE event_type = 'order_created') AS c,
         min(ts) FILTER (WHERE event_type = 'gk_started') AS s,
         min(ts) FILTER (WHERE event_type = 'gk_finished') AS f,
         min(ts) FILTER (WHERE event_type = 'gk_ready') AS r,
         min(ts) FILTER (WHERE event_type = 'driver_picked_up') AS p,
         min(ts) FILTER (WHERE event_type = 'delivered') AS d
  FROM ev GROUP BY order_id, location
),
sd AS (
  SELECT order_id, location,
         date_diff('second', c, s) / 60 AS created_to_started,
         date_diff('second', s, f) / 60 AS started_to_finished,
         date_diff('second', f, r) / 60 AS finished_to_ready,
         date_diff('second', r, p) / 60 AS ready_to_picked,
         date_diff('second', p, d) / 60 AS picked_to_delivered,
         date_diff('second', c, d) / 60 AS created_to_delivered
  FROM st
)"""

_STAGE_NAMES = ["created_to_started", "started_to_finished", "finished_to_ready",
                "ready_to_picked", "picked_to_delivered", "created_to_delivered"]

ORACLE["stage_durations"] = with_(EVENTS_B, STAGE_TIMES_B) + "\nSELECT order_id, location, " + \
    ", ".join(f"round({n}, 4) AS {n}" for n in _STAGE_NAMES) + " FROM sd"

ORACLE["stage_summary"] = with_(EVENTS_B, STAGE_TIMES_B) + "\nSELECT location, " + ", ".join(
    f"round(avg({n}), 4) AS {n}_mean, round(stddev_samp({n}), 4) AS {n}_std, count({n}) AS {n}_n"
    for n in _STAGE_NAMES) + " FROM sd GROUP BY location"

DQ = """
dq(event_type, field, threshold) AS (VALUES
  ('driver_ping', 'loc_lat', 0.01), ('driver_ping', 'loc_lon', 0.01),
  ('driver_ping', 'progress_pct', 0.02), ('driver_picked_up', 'route_points', 0.03),
  ('order_created', 'items', 0.02), ('order_created', 'customer_addr', 0.01))"""

ORACLE["missing_field_rate"] = with_(EVENTS_B, DQ) + """,
m AS (
  SELECT e.event_type, dq.field, dq.threshold,
         CASE WHEN e.event_type = 'order_created' THEN dq.field = 'customer_addr'
              ELSE json_extract(e.props, '$.' || dq.field) IS NULL END AS missing
  FROM ev e JOIN dq ON dq.event_type = e.event_type
)
SELECT event_type, field, count(*) AS events, CAST(sum(CAST(missing AS INTEGER)) AS BIGINT) AS missing,
       round(avg(CAST(missing AS INTEGER)), 4) AS rate, CAST(threshold AS DOUBLE) AS threshold,
       avg(CAST(missing AS INTEGER)) > threshold AS exceeded
FROM m GROUP BY event_type, field, threshold"""

ORACLE["missing_items_sales"] = with_(DQ) + """,
o AS (
  SELECT o_orderkey, EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey) AS has_items
  FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey
),
m AS (
  SELECT 'order_created' AS event_type, dq.field, dq.threshold,
         CASE WHEN dq.field = 'items' THEN NOT has_items ELSE false END AS missing
  FROM o JOIN dq ON dq.event_type = 'order_created'
)
SELECT event_type, field, count(*) AS events, CAST(sum(CAST(missing AS INTEGER)) AS BIGINT) AS missing,
       round(avg(CAST(missing AS INTEGER)), 4) AS rate, CAST(threshold AS DOUBLE) AS threshold,
       avg(CAST(missing AS INTEGER)) > threshold AS exceeded
FROM m GROUP BY event_type, field, threshold"""

ORACLE["event_sequence"] = with_(EVENTS_B) + """
SELECT event_id, event_type, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts, location AS gk_id, location, order_id,
       """ + BODY_B + """ AS body,
       row_number() OVER (PARTITION BY order_id ORDER BY ts, event_id) - 1 AS sequence
FROM ev"""

# ---- streaming -------------------------------------------------------------------

ORACLE["stream_silver_eq_batch"] = with_(EVENTS_B, SILVER_B) + f"""
SELECT order_id, gk_id, location, strftime(order_ts, {TS}) AS order_ts,
       strftime(order_day, '%Y-%m-%d') AS order_day, item_id, menu_id, category_id, brand_id,
       item_name, price, qty, round(extended_price, 2) AS extended_price
FROM silver"""

ORACLE["stream_header_complete"] = with_(EVENTS_B, SILVER_B) + """
SELECT order_id, gk_id, location, strftime(order_day, '%Y-%m-%d') AS order_day,
       round(sum(extended_price), 2) AS order_revenue,
       CAST(sum(qty) AS BIGINT) AS total_qty,
       count(item_id) AS total_items,
       array_to_string(list_sort(list(DISTINCT brand_id)), ',') AS brands_in_order
FROM silver GROUP BY order_id, gk_id, location, order_day"""

ORACLE["stream_brand_sales_complete"] = with_(EVENTS_B, SILVER_B) + """
SELECT brand_id, strftime(order_day, '%Y-%m-%d') AS day,
       CAST(sum(qty) AS BIGINT) AS items_sold, round(sum(extended_price), 2) AS brand_revenue,
       true AS orders_ok
FROM silver GROUP BY brand_id, order_day"""

# One micro-batch holds all input, so the final watermark is
# max(order_ts) - 3 hours and exactly the hours ending by then are closed.
ORACLE["stream_hourly_windowed_append"] = with_(EVENTS_B, SILVER_B) + f"""
SELECT location, strftime(date_trunc('hour', order_ts), {TS}) AS hour_ts,
       round(sum(extended_price), 2) AS revenue, true AS orders_ok
FROM silver
GROUP BY location, date_trunc('hour', order_ts)
HAVING date_trunc('hour', order_ts) + INTERVAL 1 HOUR
       <= (SELECT max(order_ts) FROM silver) - INTERVAL 3 HOUR"""

ORDER_SUMMARY = f"""
SELECT order_id, min(location) AS location, count(*) AS n_events,
       md5(string_agg(event_type || '|' || strftime(ts, {TS}) || '|' || {BODY_B}, chr(10)
                      ORDER BY ts, event_type, {BODY_B})) AS events_md5,
       strftime(min(ts), {TS}) AS first_ts, strftime(max(ts), {TS}) AS last_ts
FROM ev GROUP BY order_id"""

ORACLE["completed_orders"] = with_(EVENTS_B) + ORDER_SUMMARY + """
HAVING max(CASE WHEN event_type = 'delivered' THEN 1 ELSE 0 END) = 1"""

ORACLE["completed_orders_batch"] = ORACLE["completed_orders"]

ORACLE["orders_in_progress"] = with_(EVENTS_B) + ORDER_SUMMARY + """
HAVING max(CASE WHEN event_type = 'delivered' THEN 1 ELSE 0 END) = 0"""

ORACLE["completed_orders_table"] = ORACLE["completed_orders"]

# ---- catalog tables, bulk loads, day filters --------------------------------

ORACLE["event_time_audit"] = with_(EVENTS_B) + """
SELECT event_type, count(*) AS rows, count(*) FILTER (WHERE location = 'loc1') AS no_time,
       count(*) FILTER (WHERE location = 'loc2') AS no_order
FROM ev GROUP BY event_type"""

ORACLE["stream_item_sales_table"] = with_(EVENTS_B, SILVER_B) + """
SELECT item_id, menu_id, category_id, brand_id, strftime(order_day, '%Y-%m-%d') AS day,
       CAST(sum(qty) AS BIGINT) AS units_sold, round(sum(extended_price), 2) AS gross_revenue
FROM silver GROUP BY item_id, menu_id, category_id, brand_id, order_day"""

ORACLE["stream_hourly_table"] = ORACLE["dash_hourly"]
ORACLE["events_gzip_bulk"] = ORACLE["stream_silver_eq_batch"]

ORACLE["dims_files"] = with_(DIMS_A) + """
SELECT 'brand' AS "table", id, name FROM brand UNION ALL SELECT 'menu', id, name FROM menu
UNION ALL SELECT 'category', id, name FROM category UNION ALL SELECT 'item', id, name FROM item"""

ORACLE["parsed_bodies"] = with_(EVENTS_B) + """
SELECT event_id, CASE WHEN event_type = 'order_created' THEN CAST(1 AS BIGINT) END AS n_items,
       CASE WHEN event_type = 'order_created' THEN k END AS item_id,
       CASE WHEN event_type = 'order_created' THEN 'item' || CAST(k AS VARCHAR) END AS item_name,
       CAST(NULL AS DOUBLE) AS b_eta_mins
FROM ev"""

ORACLE["order_details_set"] = ORACLE["order_details_fn"] + """
WHERE order_id IN (SELECT order_id FROM ev WHERE event_type = 'delivered')"""

ORACLE["dash_gross_revenue_day"] = ORACLE["dash_gross_revenue"] + " WHERE order_day = DATE '1996-03-05'"
ORACLE["dash_orders_day"] = ORACLE["dash_orders"] + " WHERE order_day = DATE '1996-03-05'"
ORACLE["dash_hourly_since"] = ORACLE["dash_hourly"].replace(
    "FROM silver GROUP", "FROM silver WHERE order_ts >= TIMESTAMP '2024-01-20' GROUP")

ORACLE["gold_brand_sales_plain"] = ORACLE["gold_brand_sales_day"].replace("orders_ok", "has_orders")
ORACLE["gold_hourly_plain"] = ORACLE["gold_location_hourly"].replace("orders_ok", "has_orders")

# ---- checks that meet violations ----------------------------------------------

ORACLE["dims_integrity_planted"] = ORACLE["dims_integrity"].replace("item AS (", "item0 AS (").replace(
    "FROM pc)\nSELECT 'brand'", """FROM pc),
item1 AS (SELECT id, CASE WHEN id % 50 <> 5 THEN name END AS name, price, menu_id, category_id,
                 CASE WHEN id % 50 = 3 THEN -1 ELSE brand_id END AS brand_id FROM item0),
item AS (SELECT * FROM item1 UNION ALL SELECT * FROM item1 WHERE id % 50 = 1)
SELECT 'brand'""")

ORACLE["refund_json_planted"] = with_(EVENTS_B, ORDER_TIMES_B, PCT_B, DECISIONS_B) + """
SELECT order_id, length(order_id) % 2 = 0 AS valid FROM decisions"""

ORACLE["refund_policy_planted"] = ORACLE["refund_policy_rate"].replace(
    "FROM decisions GROUP", "FROM (SELECT * REPLACE (refund_usd + length(order_id) % 2 AS refund_usd) "
    "FROM decisions) GROUP")

ORACLE["refund_requests_planted"] = with_(EVENTS_B, ORDER_TIMES_B, PCT_B, DECISIONS_B) + """,
r AS (SELECT order_id, md5('request:' || order_id) AS request_id FROM (SELECT DISTINCT order_id FROM ev)),
q AS (SELECT *, CASE WHEN substr(request_id, 1, 1) < '4' THEN NULL
                     WHEN substr(request_id, 1, 1) < '8' THEN md5(request_id)
                     ELSE md5(order_id) END AS order_hash FROM r)
SELECT request_id, order_hash, x.order_id,
       CASE WHEN order_hash IS NULL THEN 'no_order_id' ELSE coalesce(x.refund_class, 'no_decision') END AS route,
       x.refund_usd
FROM q LEFT JOIN decisions x ON md5(x.order_id) = order_hash"""

# Two locations per order: the event log with its location replaced, and
# revenue per (order, location).
ORACLE["refund_two_locations"] = with_(
    EVENTS_B.replace("ev AS (", "ev0 AS ("),
    """ev AS (SELECT * REPLACE (CASE WHEN event_id < '8' THEN location ELSE 'loc9' END AS location) FROM ev0)""",
    ORDER_TIMES_B, PCT_B,
    DECISIONS_B.replace("rev AS (SELECT order_id,", "rev AS (SELECT order_id, location,")
    .replace("'order_created' GROUP BY order_id)", "'order_created' GROUP BY order_id, location)")
    .replace("ON rev.order_id = dur.order_id", "ON rev.order_id = dur.order_id AND rev.location = dur.location")) + """
SELECT location, count(*) AS orders, round(sum(refund_usd), 2) AS refunds FROM decisions GROUP BY location"""

# ---- gold tables merged per day, sketches -----------------------------------------

ORACLE["merged_order_header"] = ORACLE["stream_header_complete"]
ORACLE["merged_item_sales"] = ORACLE["stream_item_sales_table"]
ORACLE["merged_brand_sales"] = ORACLE["stream_brand_sales_complete"]
ORACLE["merged_hourly"] = ORACLE["dash_hourly"].replace("AS revenue", "AS revenue, true AS orders_ok")

ORACLE["orders_by_month_sketch"] = with_(SILVER_A) + """
SELECT strftime(order_day, '%Y-%m') AS month, count(DISTINCT order_id) AS exact_orders, true AS orders_ok
FROM silver GROUP BY 1"""

ORACLE["orders_by_brand_sketch"] = with_(SILVER_A) + """
SELECT CAST(brand_id AS VARCHAR) AS brand, count(DISTINCT order_id) AS exact_orders, true AS orders_ok
FROM silver GROUP BY 1
UNION ALL SELECT 'all', count(DISTINCT order_id), true FROM silver"""

# ---- stateful orders over several loads ---------------------------------------------

# One load holds all input: the watermark ends at the latest time less three
# hours, and timers (in milliseconds) that lie before it have fired.
ORACLE["orders_expiring"] = with_(EVENTS_B) + f""",
o AS (
  SELECT order_id, min(location) AS location, count(*) AS n_events,
         md5(string_agg(event_type || '|' || strftime(ts, {TS}) || '|' || {BODY_B}, chr(10)
                        ORDER BY ts, event_type, {BODY_B})) AS events_md5,
         strftime(min(ts), {TS}) AS first_ts, strftime(max(ts), {TS}) AS last_ts,
         max(CASE WHEN event_type = 'delivered' THEN 1 ELSE 0 END) AS done,
         epoch_ms(max(ts)) + 2 * 86400000 < (SELECT epoch_ms(max(ts)) - 3 * 3600000 FROM ev) AS due
  FROM ev GROUP BY order_id)
SELECT order_id, location, 'delivered' AS outcome, n_events, events_md5, first_ts, last_ts FROM o WHERE done = 1
UNION ALL SELECT order_id, location, 'expired', n_events, events_md5, first_ts, last_ts FROM o WHERE done = 0 AND due
UNION ALL SELECT order_id, location, 'forgotten', 0, md5(''), NULL, NULL FROM o WHERE done = 1 AND due"""

# An order's events belong to the release of the first load, at or after
# their own, that delivers it.
ORACLE["completed_orders_seeded"] = with_(EVENTS_B) + f""",
l AS (SELECT *, hour(ts) // 8 AS load FROM ev),
d AS (SELECT DISTINCT order_id, load AS release FROM l WHERE event_type = 'delivered'),
r AS (SELECT l.*, (SELECT min(release) FROM d WHERE d.order_id = l.order_id AND release >= l.load) AS release FROM l)
SELECT order_id, min(location) AS location, count(*) AS n_events,
       md5(string_agg(event_type || '|' || strftime(ts, {TS}) || '|' || {BODY_B}, chr(10)
                      ORDER BY ts, event_type, {BODY_B})) AS events_md5,
       strftime(min(ts), {TS}) AS first_ts, strftime(max(ts), {TS}) AS last_ts
FROM r WHERE release IS NOT NULL GROUP BY order_id, release"""

ORACLE["event_sequence_stream"] = ORACLE["event_sequence"]

ORACLE["orders_opened_closed"] = with_(EVENTS_B) + """,
l AS (
  SELECT order_id, b.batch, count(*) FILTER (WHERE hour(ts) // 8 = b.batch) > 0 AS has,
         count(*) FILTER (WHERE hour(ts) // 8 = b.batch AND event_type = 'delivered') > 0 AS done
  FROM ev, (SELECT unnest(range(3)) AS batch) b GROUP BY order_id, b.batch),
p AS (SELECT *, max(CASE WHEN done THEN batch END) OVER w AS last_done, max(CASE WHEN has THEN batch END) OVER w AS last_has
      FROM l WINDOW w AS (PARTITION BY order_id ORDER BY batch)),
o AS (SELECT order_id, batch, coalesce(last_has > coalesce(last_done, -1), false) AS held FROM p),
c AS (SELECT *, coalesce(lag(held) OVER (PARTITION BY order_id ORDER BY batch), false) AS was FROM o)
SELECT batch AS batch_id, count(*) FILTER (WHERE held AND NOT was) AS opened,
       count(*) FILTER (WHERE was AND NOT held) AS closed, count(*) FILTER (WHERE held) AS open_after
FROM c GROUP BY batch"""

# ---- stored day summaries ---------------------------------------------------------

ORACLE["percentiles_by_sketch"] = with_(EVENTS_B, ORDER_TIMES_B) + """,
t AS (SELECT * FROM order_times WHERE order_created_time IS NOT NULL AND delivered_time IS NOT NULL)
SELECT 'all' AS days, location, count(*) AS orders, true AS P50_ok, true AS P75_ok, true AS P99_ok FROM t GROUP BY location
UNION ALL
SELECT 'range', location, count(*), true, true, true FROM t
WHERE order_created_time >= TIMESTAMP '2024-01-20' GROUP BY location"""

ORACLE["stage_summary_merged"] = ORACLE["stage_summary"]

# ---- routed streams -----------------------------------------------------------------

# Before a load, the watermark is the latest time of the earlier loads
# (whole milliseconds) less three hours.
ORACLE["late_rows_routed"] = with_(EVENTS_B, SILVER_B) + """,
l AS (SELECT *, hour(order_ts) // 8 AS load FROM silver),
m AS (SELECT load, max(order_ts) FILTER (WHERE location <> 'loc1') AS latest FROM l GROUP BY load),
w AS (SELECT a.load, date_trunc('millisecond', max(b.latest)) - INTERVAL 3 HOUR AS closed
      FROM m a LEFT JOIN m b ON b.load < a.load GROUP BY a.load),
r AS (SELECT CASE WHEN location = 'loc1' THEN 'no_time'
                  WHEN date_trunc('hour', order_ts) + INTERVAL 1 HOUR <= closed THEN 'late' ELSE 'on_time' END AS route,
             extended_price FROM l JOIN w USING (load))
SELECT route, count(*) AS rows, round(sum(extended_price), 2) AS revenue, count(*) AS ledger_rows FROM r GROUP BY route"""

ORACLE["events_quarantined"] = with_(EVENTS_B) + """,
r AS (SELECT CASE substr(event_id, 1, 1) WHEN '0' THEN 'broken' WHEN '1' THEN 'blank' WHEN '2' THEN 'broken'
                  WHEN '3' THEN 'wrong_type' ELSE 'good' END AS route, event_id FROM ev)
SELECT route, count(*) AS lines, count(DISTINCT CASE WHEN route = 'good' THEN event_id END) AS events,
       count(*) FILTER (WHERE route <> 'good') AS kept_lines, (SELECT count(*) FROM ev) AS lines_in
FROM r GROUP BY route"""

# ---- the log clustered by order -------------------------------------------------------

ORACLE["log_order_header"] = ORACLE["stream_header_complete"]
ORACLE["log_order_times"] = ORACLE["order_times"]
ORACLE["log_event_sequence"] = ORACLE["event_sequence"]
ORACLE["log_completed_orders"] = ORACLE["completed_orders"]

# ---- dimensions, widgets and streams in full ---------------------------------------------

ORACLE["dims_loaded_values"] = with_(DIMS_A) + """
SELECT 'brand' AS "table", id, name, CAST(NULL AS DOUBLE) AS price, CAST(NULL AS BIGINT) AS brand_id,
       CAST(NULL AS BIGINT) AS menu_id, CAST(NULL AS BIGINT) AS category_id FROM brand
UNION ALL SELECT 'menu', id, name, NULL, brand_id, NULL, NULL FROM menu
UNION ALL SELECT 'category', id, name, NULL, brand_id, menu_id, NULL FROM category
UNION ALL SELECT 'item', id, name, price, brand_id, menu_id, category_id FROM item"""

ORACLE["dash_widget_bar_brands"] = with_(SILVER_A) + """
SELECT CAST(brand_id AS VARCHAR) AS label, round(sum(extended_price), 2) AS "sum(value)" FROM silver GROUP BY brand_id"""

ORACLE["stream_items_enriched"] = with_(SILVER_A) + """
SELECT order_id, s.item_id, pt.p_name AS item_name, 'menu' || CAST(s.menu_id AS VARCHAR) AS menu_name,
       pt.p_type AS category_name, 'Brand#' || CAST(s.brand_id AS VARCHAR) AS brand_name, qty,
       round(extended_price, 2) AS extended_price
FROM silver s JOIN part pt ON pt.p_partkey = s.item_id"""
