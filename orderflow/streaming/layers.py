"""Bronze -> silver -> gold as chained one-shot streams over files.

Each layer is its own checkpointed stream reading the previous layer's
file table, run to completion (``availableNow``) before the next one.
Rerunning picks up only the newly landed event files.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import gold, silver
from ..operators.rollups import all_rollups
from ..schemas import EVENT
from ..sources.events import read_events_stream
from .merged import ROWS_PER_FILE, MergedTable, read_merged, run_merged
from .sinks import run_aggregate, run_append

# Gold tables kept in complete mode (the faithful form).
# Partition column of each, so that a day filter reads that day only.
PARTITIONS = {"order_header": "order_day", "item_sales_day": "day", "brand_sales_day": "day",
              "location_sales_hourly": "day", "location_sales_windowed": "day"}

# Silver files (and tasks) a micro-batch writes per day, at most: raise it
# with the size of a day's batch, so that a file has some 100 MB.
FILES_PER_DAY = 4

COMPLETE_TABLES = {
    "order_header": lambda s: gold.order_header(s),
    "item_sales_day": lambda s: gold.item_sales_day(s),
    "brand_sales_day": lambda s: gold.brand_sales_day(s),
    "location_sales_hourly": lambda s: gold.location_sales_hourly(s).withColumn(
        "day", F.to_date("hour_ts")),
}


@dataclass
class Layout:
    """Where each layer lives: file tables under ``root``, or catalog
    tables in ``database`` (append layers) when one is given."""

    root: str
    database: str | None = None

    def table(self, name: str) -> str:
        return f"{self.root}/{name}"

    def table_name(self, name: str) -> str:
        return f"{self.database}.{name}"

    def append(self, spark: SparkSession, df: DataFrame, name: str,
               partition_by: list[str] | None = None) -> None:
        if self.database:
            spark.sql(f"CREATE DATABASE IF NOT EXISTS {self.database} "
                      f"LOCATION '{self.root}/_database'")
            run_append(df, None, self.checkpoint(name), partition_by, table=self.table_name(name))
        else:
            run_append(df, self.table(name), self.checkpoint(name), partition_by)

    def stream(self, spark: SparkSession, name: str, schema, max_files: int | None = None) -> DataFrame:
        reader = spark.readStream
        if max_files:
            reader = reader.option("maxFilesPerTrigger", str(max_files))
        if self.database:
            return reader.table(self.table_name(name))
        return reader.schema(schema).parquet(self.table(name))

    def read(self, spark: SparkSession, name: str) -> DataFrame:
        """Batch read of an append layer."""
        if self.database:
            return spark.table(self.table_name(name))
        return spark.read.parquet(self.table(name))

    def checkpoint(self, name: str) -> str:
        return f"{self.root}/_checkpoints/{name}"


def silver_schema(spark: SparkSession):
    """Schema of silver rows (planned on an empty frame, no job runs)."""
    return silver.order_items(spark.createDataFrame([], EVENT)).schema


def run_bronze(spark: SparkSession, landing: str, layout: Layout,
               max_files: int | None = None) -> str:
    """Landing JSON files -> bronze parquet table (append)."""
    layout.append(spark, read_events_stream(spark, landing, max_files), "bronze")
    return layout.table("bronze")


def bronze_stream(spark: SparkSession, layout: Layout) -> DataFrame:
    return layout.stream(spark, "bronze", EVENT)


def run_silver(spark: SparkSession, layout: Layout, strict: bool = False,
               files_per_day: int = FILES_PER_DAY) -> str:
    """Bronze stream -> item rows, partitioned by order_day (append)."""
    items = silver.order_items(bronze_stream(spark, layout), strict)
    # A backfill of many days would else write tasks x days small files.  A
    # day's rows go to ``files_per_day`` different tasks (fewer only if there are fewer).
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    share = F.pmod(F.xxhash64("order_id"), F.lit(files_per_day))
    items = items.repartitionById(tasks, F.pmod(
        F.pmod(F.xxhash64("order_day"), F.lit(tasks)) + share, F.lit(tasks)).cast("int"))
    layout.append(spark, items, "silver", partition_by=["order_day"])
    return layout.table("silver")


def silver_stream(spark: SparkSession, layout: Layout, max_files: int | None = None) -> DataFrame:
    return layout.stream(spark, "silver", silver_schema(spark), max_files)


def run_gold(spark: SparkSession, layout: Layout, tables=None, windowed: bool = True,
             max_files: int | None = None) -> dict:
    """Gold tables from the silver stream.

    The four complete-mode tables rewrite their result each batch (state
    is never freed, see ``gold.brand_sales_day``); ``location_sales_windowed``
    appends closed hourly windows under the watermark.
    """
    out = {}
    for name in (COMPLETE_TABLES if tables is None else tables):
        run_aggregate(COMPLETE_TABLES[name](silver_stream(spark, layout, max_files)), layout.table(name),
                      layout.checkpoint(name), [PARTITIONS[name]],
                      name=layout.table_name(name) if layout.database else None)
        out[name] = layout.table(name)
    if windowed:
        hourly = gold.location_sales_windowed(silver_stream(spark, layout)).withColumn(
            "day", F.to_date("hour_ts"))
        layout.append(spark, hourly, "location_sales_windowed", [PARTITIONS["location_sales_windowed"]])
        out["location_sales_windowed"] = layout.table("location_sales_windowed")
    return out


def run_gold_merged(spark: SparkSession, layout: Layout, tables=None, max_files: int | None = None,
                    rows_per_file: int = ROWS_PER_FILE) -> dict[str, MergedTable]:
    """Gold tables from the silver stream, merged per day (see ``merged``):
    each micro-batch writes the days it touches, and nothing else."""
    out = {}
    rollups = all_rollups()
    for name in (rollups if tables is None else tables):
        by_name = layout.table_name(name) if layout.database else None
        out[name] = MergedTable(rollups[name], layout.table(f"{name}_merged"), layout.checkpoint(f"{name}_merged"),
                                by_name, rows_per_file=rows_per_file)
        run_merged(silver_stream(spark, layout, max_files), out[name])
    return out


def merged_table(spark: SparkSession, layout: Layout, name: str, days=None) -> DataFrame:
    """A merged gold table by its ledger (``days``: ISO texts, only these are read)."""
    rollup = all_rollups()[name]
    schema = rollup.partial(spark.createDataFrame([], silver_schema(spark))).schema
    return read_merged(spark, layout.table(f"{name}_merged"), rollup, schema, days)


def run_layers(spark: SparkSession, landing: str, root: str, max_files: int | None = None,
               tables=None, windowed: bool = True, database: str | None = None) -> Layout:
    """Run bronze, silver and gold one after the other."""
    layout = Layout(root, database)
    run_bronze(spark, landing, layout, max_files)
    run_silver(spark, layout)
    run_gold(spark, layout, tables, windowed)
    return layout
