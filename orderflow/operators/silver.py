"""Silver layer: order_created events -> one row per ordered item."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.time import parse_ts
from ..schemas import BODY, CREATED_BODY

SILVER_COLUMNS = [
    "order_id", "gk_id", "location", "order_ts", "order_day", "item_id", "menu_id",
    "category_id", "brand_id", "item_name", "price", "qty", "extended_price",
]


def order_items(events: DataFrame, strict: bool = False) -> DataFrame:
    """Explode the items of each ``order_created`` event (batch or stream).

    Narrow plan: filter -> parse -> explode -> project, no shuffle.  The
    filter sits above the scan so it is pushed into the file reader, and
    only the item fields used are read from the JSON body.  Orders whose
    body has no, empty, or unparsable ``items`` give no row.
    """
    created = events.filter(F.col("event_type") == "order_created")
    exploded = created.select(
        "order_id", "gk_id", "location",
        parse_ts("ts", strict).alias("order_ts"),
        F.explode(F.from_json("body", CREATED_BODY).getField("items")).alias("item"))
    return exploded.select(
        "order_id", "gk_id", "location", "order_ts",
        F.to_date("order_ts").alias("order_day"),
        F.col("item.id").alias("item_id"),
        F.col("item.menu_id").alias("menu_id"),
        F.col("item.category_id").alias("category_id"),
        F.col("item.brand_id").alias("brand_id"),
        F.col("item.name").alias("item_name"),
        F.col("item.price").alias("price"),
        F.col("item.qty").alias("qty"),
        (F.col("item.price") * F.col("item.qty")).alias("extended_price"))


def parse_bodies(events: DataFrame) -> DataFrame:
    """Decode every event's body with one merged schema into typed columns.

    A field absent from a body (or a body that is not JSON) is NULL.
    """
    body = F.from_json("body", BODY)
    return events.select("*", *[body.getField(f.name).alias(f"b_{f.name}") for f in BODY.fields])
