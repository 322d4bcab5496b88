"""Gold tables merged per day, with a batch ledger.

A micro-batch is aggregated on its own and merged with what the table
holds for the days that it touches: no streaming state, and only those
day folders are written anew.  A day's rows lie in
``<day column>=<day>/v=<batch>``; the ledger names the valid version of
every day and is replaced in one rename after all folders are complete.

Idempotent: a batch that the ledger already has changes nothing, and a
batch that failed before its ledger entry overwrites its own folders.
The ledger also keeps the id of the stream it belongs to, so another
stream (a lost checkpoint counts its batches anew) is refused instead of
being taken for a replay.

With a catalog table, the day partitions are pointed at their new
folders after the ledger and before older versions are deleted; the
newest ``keep_versions`` versions of a day stay.  A reader by name
always finds complete days.
"""

from __future__ import annotations

import json
import math
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.rollups import Rollup
from . import files
from .sinks import finish

#: Partial rows of a file, about; a day has as many files (and tasks) as it needs.
ROWS_PER_FILE = 1_000_000
NO_DAY = "__HIVE_DEFAULT_PARTITION__"


def ledger_path(path: str) -> str:
    return f"{path}/_ledger.json"


def read_ledger(spark: SparkSession, path: str) -> dict | None:
    """{stream, batch, touched, days: {day: {v, rows}}}, None before the first commit."""
    text = files.read_text(spark, ledger_path(path))
    return json.loads(text) if text else None


def _folder(path: str, rollup: Rollup, day: str, version: int) -> str:
    return f"{path}/{rollup.day}={day}/v={version}"


def read_parts(spark: SparkSession, path: str, rollup: Rollup, schema, days=None) -> DataFrame:
    """Partial rows of the valid version of ``days`` (ISO text; default: all days)."""
    ledger = read_ledger(spark, path) or {"days": {}}
    wanted = ledger["days"] if days is None else [d for d in days if d in ledger["days"]]
    folders = [_folder(path, rollup, d, ledger["days"][d]["v"]) for d in wanted]
    if not folders:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", path).parquet(*folders).select(*schema.names)


def read_merged(spark: SparkSession, path: str, rollup: Rollup, schema, days=None) -> DataFrame:
    """The table's final columns, by the ledger."""
    return rollup.final(read_parts(spark, path, rollup, schema, days))


class MergedTable:
    """One merged gold table: a folder, its ledger and maybe a catalog name."""

    def __init__(self, rollup: Rollup, path: str, checkpoint: str, name: str | None = None,
                 keep_versions: int = 2, rows_per_file: int = ROWS_PER_FILE):
        self.rollup, self.path, self.checkpoint, self.name = rollup, path, checkpoint, name
        self.keep, self.rows_per_file = keep_versions, rows_per_file

    def apply(self, items: DataFrame, batch_id: int) -> None:
        """Merge one micro-batch of item rows (``foreachBatch``)."""
        spark = items.sparkSession
        stream = json.loads(files.read_text(spark, f"{self.checkpoint}/metadata") or "{}").get("id")
        ledger = read_ledger(spark, self.path) or {"stream": stream, "batch": -1, "touched": [], "days": {}}
        if ledger["stream"] != stream:
            raise RuntimeError(f"{self.path} belongs to another stream ({ledger['stream']}); "
                               "its checkpoint is gone or a second stream writes to it")
        delta = self.rollup.partial(items)
        schema = delta.schema
        if batch_id <= ledger["batch"]:
            if batch_id == ledger["batch"]:  # it may have failed before the names were moved
                self._publish(spark, schema, ledger)
            return
        staged = f"{self.path}/_staged/b{batch_id}"
        delta.write.mode("overwrite").parquet(staged)
        delta = spark.read.schema(schema).parquet(staged)
        new = self._rows_by_day(delta)
        if new:
            self._write(spark, delta, schema, ledger, new, batch_id)
        ledger["batch"], ledger["touched"] = batch_id, sorted(new)
        files.write_text(spark, ledger_path(self.path), json.dumps(ledger))
        self._publish(spark, schema, ledger)
        files.delete(spark, staged)

    def _rows_by_day(self, parts: DataFrame) -> dict[str, int]:
        """Partial rows of each day: one row per calendar day."""
        day = F.coalesce(F.date_format(self.rollup.day, "yyyy-MM-dd"), F.lit(NO_DAY)).alias("day")
        return {r["day"]: r["n"] for r in parts.groupBy(day).agg(F.count(F.lit(1)).alias("n")).collect()}

    def _write(self, spark, delta, schema, ledger: dict, new: dict[str, int], batch_id: int) -> None:
        """Merge the touched days into their next version."""
        old = {d: ledger["days"][d]["rows"] for d in new if d in ledger["days"]}
        held = read_parts(spark, self.path, self.rollup, schema, list(old))
        shares, first = [], 0
        for d, n in new.items():  # one row per touched calendar day
            shares.append((d, first, math.ceil((n + old.get(d, 0)) / self.rows_per_file)))
            first += shares[-1][2]
        plan = F.broadcast(spark.createDataFrame(shares, "_day string, _first int, _n int"))
        day = F.coalesce(F.date_format(self.rollup.day, "yyyy-MM-dd"), F.lit(NO_DAY))
        keys = self.rollup.key_names()
        # One task per file; the merge groups by keys that decide the file, so it is one shuffle.
        place = (F.col("_first") + F.pmod(F.xxhash64(*keys), F.col("_n"))).cast("int")
        spread = delta.unionByName(held).join(plan, day == F.col("_day")).withColumn("_file", place).repartitionById(
            first, F.col("_file"))
        merged = self.rollup.merge(spread, *[F.col(k) for k in keys], F.col("_file")).select(
            *schema.names, F.lit(batch_id).cast("bigint").alias("v"))
        (merged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(self.rollup.day, "v").parquet(self.path))
        written = spark.read.schema(schema).option("basePath", self.path).parquet(
            *[_folder(self.path, self.rollup, d, batch_id) for d in new])
        rows = self._rows_by_day(written)
        for d in new:
            ledger["days"][d] = {"v": batch_id, "rows": rows[d], "again": d in ledger["days"]}

    def _publish(self, spark: SparkSession, schema, ledger: dict) -> None:
        """Point the names at the touched days, then drop older versions."""
        if self.name:
            self._catalog(spark, schema, ledger)
        for d in ledger["touched"]:
            versions = sorted(int(n[2:]) for n in files.names(spark, f"{self.path}/{self.rollup.day}={d}")
                              if n.startswith("v=") and int(n[2:]) <= ledger["days"][d]["v"])
            for v in versions[:-self.keep]:
                files.delete(spark, _folder(self.path, self.rollup, d, v))

    def _catalog(self, spark: SparkSession, schema, ledger: dict) -> None:
        parts = f"{self.name}_parts"
        if not spark.catalog.tableExists(parts):
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
            spark.sql(f"CREATE TABLE {parts} ({columns}) USING parquet PARTITIONED BY ({self.rollup.day}) "
                      f"LOCATION '{self.path}/_named'")
            own = {m: kind for m, kind, _ in self.rollup.measures}
            chosen = ", ".join(f"hll_sketch_estimate({c}) AS {c}" if own.get(c) == "distinct" else c
                               for c in schema.names)
            spark.sql(f"CREATE OR REPLACE VIEW {self.name} AS SELECT {chosen} FROM {parts}")
        def spec(d: str) -> str:
            return f"PARTITION ({self.rollup.day} = " + ("null" if d == NO_DAY else f"DATE'{d}'") + ")"

        def place(d: str) -> str:
            return f"LOCATION '{_folder(self.path, self.rollup, d, ledger['days'][d]['v'])}'"

        # A day new to the table needs no second step; a replay may find it there already.
        touched = ledger["touched"]
        if touched:
            spark.sql(f"ALTER TABLE {parts} ADD IF NOT EXISTS " + " ".join(f"{spec(d)} {place(d)}" for d in touched))
        for d in touched:
            if ledger["days"][d].get("again"):
                spark.sql(f"ALTER TABLE {parts} {spec(d)} SET {place(d)}")


def run_merged(items: DataFrame, table: MergedTable, apply: Callable | None = None) -> StreamingQuery:
    """Keep a gold table from a stream of item rows, to the end of the input."""
    q = (items.writeStream.outputMode("update").foreachBatch(apply or table.apply)
         .option("checkpointLocation", table.checkpoint).trigger(availableNow=True).start())
    return finish(q)
