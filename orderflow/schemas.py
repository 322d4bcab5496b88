"""Fixed schemas: event envelope, bodies, items, state and outputs."""

from pyspark.sql import types as T

# Event envelope, one JSON object per event.  ``ts`` stays text here
# (``yyyy-MM-dd HH:mm:ss.SSSSSS``, UTC) and is parsed by the operators.
EVENT = T.StructType([
    T.StructField("event_id", T.StringType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("ts", T.StringType()),
    T.StructField("gk_id", T.StringType()),
    T.StructField("location", T.StringType()),
    T.StructField("order_id", T.StringType()),
    T.StructField("sequence", T.LongType()),
    T.StructField("body", T.StringType()),
])

# An ordered item.
ITEM = T.StructType([
    T.StructField("id", T.IntegerType()),
    T.StructField("category_id", T.IntegerType()),
    T.StructField("menu_id", T.IntegerType()),
    T.StructField("brand_id", T.IntegerType()),
    T.StructField("name", T.StringType()),
    T.StructField("price", T.DoubleType()),
    T.StructField("qty", T.IntegerType()),
])

# Body of ``order_created``.
CREATED_BODY = T.StructType([
    T.StructField("customer_lat", T.DoubleType()),
    T.StructField("customer_lon", T.DoubleType()),
    T.StructField("customer_addr", T.StringType()),
    T.StructField("items", T.ArrayType(ITEM)),
])

# One merged schema covering the body fields of every event type.
BODY = T.StructType(CREATED_BODY.fields + [
    T.StructField("route_points", T.ArrayType(T.ArrayType(T.DoubleType()))),
    T.StructField("eta_mins", T.DoubleType()),
    T.StructField("progress_pct", T.DoubleType()),
    T.StructField("loc_lat", T.DoubleType()),
    T.StructField("loc_lon", T.DoubleType()),
    T.StructField("delivered_lat", T.DoubleType()),
    T.StructField("delivered_lon", T.DoubleType()),
])

# The lifecycle event types, in order.
EVENT_TYPES = [
    "order_created", "gk_started", "gk_finished", "gk_ready",
    "driver_picked_up", "driver_ping", "delivered",
]

# Row kept in the stateful collector's state; ts in epoch microseconds.
STATE_EVENT = T.StructType([
    T.StructField("event_type", T.StringType()),
    T.StructField("ts", T.LongType()),
    T.StructField("body", T.StringType()),
    T.StructField("order_id", T.StringType()),
    T.StructField("location", T.StringType()),
])

OUT_EVENT = T.StructType([
    T.StructField("event_type", T.StringType()),
    T.StructField("ts", T.TimestampType()),
    T.StructField("body", T.StringType()),
])

COMPLETED = T.StructType([
    T.StructField("order_id", T.StringType()),
    T.StructField("location", T.StringType()),
    T.StructField("events", T.ArrayType(OUT_EVENT)),
])

# What the collector hands out: as COMPLETED, with epoch microseconds.
COMPLETED_STATE = T.StructType([
    T.StructField("order_id", T.StringType()),
    T.StructField("location", T.StringType()),
    T.StructField("events", T.ArrayType(T.StructType([
        T.StructField("event_type", T.StringType()),
        T.StructField("ts", T.LongType()),
        T.StructField("body", T.StringType()),
    ]))),
])

# What the collector with timers hands out.
EXPIRING_STATE = T.StructType(COMPLETED_STATE.fields + [T.StructField("outcome", T.StringType())])

# Events with their number, in the order the numberer hands them out.
NUMBERED = T.StructType([f for f in EVENT.fields if f.name != "sequence"] + [T.StructField("sequence", T.LongType())])

# Dimension tables, as declared (ids BIGINT).
DIM_SCHEMAS = {
    "brand": T.StructType([
        T.StructField("id", T.LongType(), False),
        T.StructField("name", T.StringType(), False),
    ]),
    "menu": T.StructType([
        T.StructField("id", T.LongType(), False),
        T.StructField("name", T.StringType(), False),
        T.StructField("brand_id", T.LongType(), False),
    ]),
    "category": T.StructType([
        T.StructField("id", T.LongType(), False),
        T.StructField("name", T.StringType(), False),
        T.StructField("menu_id", T.LongType(), False),
        T.StructField("brand_id", T.LongType(), False),
    ]),
    "item": T.StructType([
        T.StructField("id", T.LongType(), False),
        T.StructField("name", T.StringType(), False),
        T.StructField("description", T.StringType(), True),
        T.StructField("price", T.DoubleType(), False),
        T.StructField("image_data", T.StringType(), True),
        T.StructField("brand_id", T.LongType(), False),
        T.StructField("menu_id", T.LongType(), False),
        T.StructField("category_id", T.LongType(), False),
    ]),
}

# Declared keys: primary key and foreign keys (column -> parent table).
DIM_KEYS = {
    "brand": {"pk": "id", "fk": {}},
    "menu": {"pk": "id", "fk": {"brand_id": "brand"}},
    "category": {"pk": "id", "fk": {"menu_id": "menu", "brand_id": "brand"}},
    "item": {"pk": "id", "fk": {"brand_id": "brand", "menu_id": "menu",
                                "category_id": "category"}},
}
