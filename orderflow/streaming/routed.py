"""A stream split into routes, every row counted.

Each micro-batch is written once, into ``route=<name>/v=<batch>``, and
the counts observed in that same pass go into a ledger: what came in is
what lies in the routes.  A batch that the ledger has is not written
again, and one that failed before its entry overwrites its own folders.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..schemas import EVENT
from . import files
from .sinks import finish

#: Batches whose own counts the ledger keeps; all go into its totals.
KEPT_BATCHES = 100


class RoutedTable:
    """``route`` gives a row's route from the ledger's state; ``state`` has
    the aggregates over all batches that it needs (name -> aggregate, the
    largest value is kept)."""

    def __init__(self, path: str, checkpoint: str, names: list[str], route: Callable[[dict], Column],
                 state: dict[str, Column] | None = None):
        self.path, self.checkpoint, self.names = path, checkpoint, names
        self.route, self.state = route, state or {}

    def ledger(self, spark: SparkSession) -> dict:
        text = files.read_text(spark, f"{self.path}/_ledger.json")
        return json.loads(text) if text else {"batch": -1, "state": {}, "totals": {}, "batches": {}}

    def apply(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        ledger = self.ledger(spark)
        if batch_id <= ledger["batch"]:
            return
        routed = batch.withColumn("route", self.route(ledger["state"])).withColumn("v", F.lit(batch_id).cast("bigint"))
        seen = Observation(f"routes-{batch_id}")
        counts = [F.count(F.when(F.col("route") == n, 1)).alias(n) for n in self.names]
        routed = routed.observe(seen, F.count(F.lit(1)).alias("input"), *counts,
                                *[e.alias(f"state_{n}") for n, e in self.state.items()])
        (routed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("route", "v").parquet(self.path))
        got = seen.get
        own = {n: got.get(n) or 0 for n in ["input", *self.names]}
        if own["input"] != sum(own[n] for n in self.names):
            raise RuntimeError(f"batch {batch_id}: rows without a route ({own})")
        for n in self.state:
            values = [v for v in (ledger["state"].get(n), got.get(f"state_{n}")) if v is not None]
            ledger["state"][n] = max(values) if values else None
        ledger["batch"] = batch_id
        ledger["totals"] = {n: ledger["totals"].get(n, 0) + c for n, c in own.items()}
        ledger["batches"][str(batch_id)] = own
        for old in sorted(ledger["batches"], key=int)[:-KEPT_BATCHES]:
            del ledger["batches"][old]
        files.write_text(spark, f"{self.path}/_ledger.json", json.dumps(ledger))

    def run(self, stream: DataFrame) -> StreamingQuery:
        q = (stream.writeStream.outputMode("append").foreachBatch(self.apply)
             .option("checkpointLocation", self.checkpoint).trigger(availableNow=True).start())
        return finish(q)

    def read(self, spark: SparkSession, schema, route: str | None = None) -> DataFrame:
        """Committed rows with ``route`` (all routes by default)."""
        fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
        last = self.ledger(spark)["batch"]
        if last < 0:
            return spark.createDataFrame([], f"{fields}, route string")
        df = spark.read.schema(f"{fields}, route string, v bigint").parquet(self.path).filter(F.col("v") <= last)
        return (df.filter(F.col("route") == route) if route else df).drop("v")


# -- late rows of an hourly table -----------------------------------------------

ON_TIME, LATE, NO_TIME = "on_time", "late", "no_time"


def late_rows(path: str, checkpoint: str, lateness_s: int = 3 * 3600, window_s: int = 3600,
              time: str = "order_ts") -> RoutedTable:
    """Rows of windows that the watermark has closed go to ``late``.

    The watermark is the latest time of all earlier micro-batches less the
    lateness, as in a windowed aggregation under ``withWatermark``, which
    drops these rows without a trace.
    """
    us = F.unix_micros(time)

    def route(state: dict) -> Column:
        r = F.when(F.col(time).isNull(), NO_TIME)
        if state.get("latest") is not None:
            closed = state["latest"] // 1000 * 1000 - lateness_s * 1_000_000
            end = us - F.pmod(us, F.lit(window_s * 1_000_000)) + window_s * 1_000_000
            r = r.when(end <= closed, LATE)
        return r.otherwise(ON_TIME)

    return RoutedTable(path, checkpoint, [ON_TIME, LATE, NO_TIME], route, {"latest": F.max(us)})


# -- malformed event lines ----------------------------------------------------------

GOOD, BLANK, BROKEN, WRONG_TYPE = "good", "blank", "broken", "wrong_type"
CORRUPT = "_broken_line"


def event_lines(lines: DataFrame) -> DataFrame:
    """Text lines -> envelope columns, the line (where it is not good) and
    its quality: every line is one row, whatever it holds.

    Good: a JSON object whose known fields have the envelope's types.
    ``wrong_type``: an object in which one has not.
    """
    text = F.trim(F.col("value"))
    schema = T.StructType([*EVENT.fields, T.StructField(CORRUPT, T.StringType())])
    parsed = lines.select("value", F.from_json("value", schema, {
        "mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}).alias("e"))
    # One value and nothing after it: two records in a line would else lose the second.
    whole = F.coalesce(F.size(F.from_json(F.concat(F.lit("["), text, F.lit("]")), "array<string>")) == 1, F.lit(False))
    quality = (F.when(F.length(text) == 0, BLANK)
               .when(~F.startswith(text, F.lit("{")) | ~whole, BROKEN)
               .when(F.col("e").isNull() | F.col(f"e.{CORRUPT}").isNotNull(), WRONG_TYPE).otherwise(GOOD))
    out = parsed.withColumn("quality", quality)
    return out.select(*[F.when(F.col("quality") == GOOD, F.col("e")[f]).alias(f) for f in EVENT.names],
                      F.when(F.col("quality") != GOOD, F.col("value")).alias("line"), "quality")


def quarantine(path: str, checkpoint: str) -> RoutedTable:
    """Routes for ``event_lines``: good events, and lines by what is wrong."""
    return RoutedTable(path, checkpoint, [GOOD, BLANK, BROKEN, WRONG_TYPE], lambda state: F.col("quality"))
