"""Order-event logs derived from the driver's tables.

The driver's parquet tables hold no order events, so two mappings turn
them into envelope rows (``schemas.EVENT``).  Both are plain Spark jobs
over the whole tables: their work grows with the data.

* Mapping A (sales): one ``order_created`` event per order, items from
  lineitem joined with part; order/customer/nation give ids and location.
* Mapping B (lifecycle): every row of ``events`` becomes one lifecycle
  event of an order ``u{user_id}-{yyyyMMdd}``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.joins import broadcast_if_small

TS_FORMAT = "yyyy-MM-dd HH:mm:ss.SSSSSS"

# p_type in sorted order; position (1-based) is the
# category digit of mapping A.
PART_TYPES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]

# Events.event_type -> lifecycle event type of mapping B.
LIFECYCLE_TYPES = {
    "view": "order_created",
    "click": "gk_started",
    "signup": "driver_picked_up",
    "error": "driver_ping",
    "purchase": "delivered",
}

LOCATIONS_B = 5


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def part_codes(part: DataFrame) -> DataFrame:
    """Add brand/menu/category numbers to ``part`` (mapping A)."""
    brand = F.regexp_extract("p_brand", "[0-9]+", 0).try_cast("int")
    menu = brand * 10 + F.col("p_size") % 3
    types = F.array(*[F.lit(t) for t in PART_TYPES])
    category = menu * 10 + F.array_position(types, F.col("p_type")).cast("int")
    return part.select(
        "p_partkey", "p_name", "p_retailprice", "p_brand", "p_type", "p_size",
        brand.alias("brand_id"), menu.alias("menu_id"), category.alias("category_id"))


def _envelope(event_id: Column, event_type: Column, ts: Column, gk_id: Column,
              location: Column, order_id: Column, sequence: Column, body: Column) -> list[Column]:
    return [event_id.alias("event_id"), event_type.alias("event_type"), ts.alias("ts"),
            gk_id.alias("gk_id"), location.alias("location"), order_id.alias("order_id"),
            sequence.cast("bigint").alias("sequence"), body.alias("body")]


def sales_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mapping A: one ``order_created`` event per order, items in the body.

    Plan: lineitem ⋈ part (shuffle join on partkey unless part is small;
    AQE splits a hot part), then orders ⋈ customer ⋈ nation (nation
    broadcast behind a size check) left-joined with the item rows on
    orderkey, and one aggregation per order on that same partitioning.
    Orders without line items carry no ``items`` field.
    """
    part = part_codes(table(spark, sf_dir, "part"))
    item = F.struct(
        F.col("p_partkey").cast("int").alias("id"),
        F.col("category_id"), F.col("menu_id"), F.col("brand_id"),
        F.col("p_name").alias("name"), F.col("p_retailprice").alias("price"),
        F.col("l_quantity").cast("int").alias("qty"))
    lines = (table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
             .join(part, F.col("l_partkey") == F.col("p_partkey")))
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nation = broadcast_if_small(table(spark, sf_dir, "nation").select("n_nationkey", "n_name"))
    joined = (orders
              .join(customer, F.col("o_custkey") == F.col("c_custkey"))
              .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
              .join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left"))
    per_order = joined.groupBy("o_orderkey", "o_custkey", "o_orderdate", "c_nationkey", "n_name").agg(
        F.collect_list(F.when(F.col("l_orderkey").isNotNull(), item)).alias("items"))
    order_id = F.col("o_orderkey").cast("string")
    items = F.when(F.size("items") > 0, F.col("items"))
    body = F.to_json(F.struct(F.col("o_custkey").cast("string").alias("customer_addr"),
                              items.alias("items")))
    return per_order.select(*_envelope(
        F.md5(F.concat(F.lit("order_created:"), order_id)),
        F.lit("order_created"),
        F.date_format("o_orderdate", TS_FORMAT),
        F.col("c_nationkey").cast("string"),
        F.col("n_name"),
        order_id,
        F.lit(0),
        body))


def lifecycle_type(col: str = "event_type") -> Column:
    expr = None
    for src, dst in LIFECYCLE_TYPES.items():
        expr = (F.when(F.col(col) == src, F.lit(dst)) if expr is None
                else expr.when(F.col(col) == src, F.lit(dst)))
    return expr


def lifecycle_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mapping B: every ``events`` row is one lifecycle event (narrow, no shuffle)."""
    ev = table(spark, sf_dir, "events")
    k = F.regexp_extract("props", "[0-9]+", 0).try_cast("int")
    brand = k % 10 + 1
    menu = brand * 10 + k % 3
    category = menu * 10 + k % 7
    item = F.struct(
        k.alias("id"), category.alias("category_id"), menu.alias("menu_id"),
        brand.alias("brand_id"), F.concat(F.lit("item"), k.cast("string")).alias("name"),
        F.col("value").alias("price"), F.lit(1).alias("qty"))
    created_body = F.to_json(F.struct(F.array(item).alias("items")))
    location = F.concat(F.lit("loc"), (F.col("user_id") % LOCATIONS_B).cast("string"))
    return ev.select(*_envelope(
        F.md5(F.concat(F.lit("event:"), F.col("event_id").cast("string"))),
        lifecycle_type(),
        F.date_format("ts", TS_FORMAT),
        location,
        location,
        F.concat(F.lit("u"), F.col("user_id").cast("string"), F.lit("-"),
                 F.date_format("ts", "yyyyMMdd")),
        F.lit(None),
        F.when(F.col("event_type") == "view", created_body).otherwise(F.col("props"))))


def refund_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Free-text refund requests, one per order of mapping B, each naming
    the order by its 32-hex id (``md5(order_id)``)."""
    orders = lifecycle_events(spark, sf_dir).select("order_id").distinct()
    return orders.select(
        F.md5(F.concat(F.lit("request:"), F.col("order_id"))).alias("request_id"),
        F.lit("user").alias("role"),
        F.concat(F.lit("My order was late, refund "), F.md5("order_id")).alias("content"))


def dims_from_part(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Brand / menu / category / item dimensions derived from ``part``
    with the mapping-A numbering (distinct keys; one shuffle each)."""
    p = part_codes(table(spark, sf_dir, "part"))
    brand = (p.select(F.col("brand_id").cast("bigint").alias("id")).distinct()
             .withColumn("name", F.concat(F.lit("Brand#"), F.col("id").cast("string"))))
    menu = (p.select(F.col("menu_id").cast("bigint").alias("id"),
                     F.col("brand_id").cast("bigint").alias("brand_id")).distinct()
            .withColumn("name", F.concat(F.lit("menu"), F.col("id").cast("string"))))
    category = p.select(F.col("category_id").cast("bigint").alias("id"),
                        F.col("p_type").alias("name"),
                        F.col("menu_id").cast("bigint").alias("menu_id"),
                        F.col("brand_id").cast("bigint").alias("brand_id")).distinct()
    item = p.select(F.col("p_partkey").alias("id"), F.col("p_name").alias("name"),
                    F.lit(None).cast("string").alias("description"),
                    F.col("p_retailprice").alias("price"),
                    F.lit(None).cast("string").alias("image_data"),
                    F.col("brand_id").cast("bigint").alias("brand_id"),
                    F.col("menu_id").cast("bigint").alias("menu_id"),
                    F.col("category_id").cast("bigint").alias("category_id"))
    return {"brand": brand, "menu": menu, "category": category, "item": item}
