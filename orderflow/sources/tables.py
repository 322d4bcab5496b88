"""Batch table helpers: one-time bulk load and dimension files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def load_once(spark: SparkSession, df: DataFrame, table: str,
              path: str | None = None, fmt: str = "parquet") -> bool:
    """Write ``df`` as ``table`` unless the table already exists.

    Returns True when it wrote.  An existing table is never refreshed
    (the bulk-load guard of the original set-up).
    """
    if spark.catalog.tableExists(table):
        return False
    writer = df.write.mode("overwrite").format(fmt)
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(table)
    return True


def write_event_log(events: DataFrame, table: str, path: str, buckets: int) -> None:
    """Events as a table clustered by order: ``buckets`` files, bucketed and
    sorted by order_id.

    Work per order (headers, times, numbers, collected orders) then needs
    no shuffle of the log.  Size ``buckets`` so that a file has some 512 MB.
    Events without an order id would all lie in one bucket; they go, spread
    out, to ``<table>_no_order``.
    """
    def save(df: DataFrame, name: str, place: str, clustered: bool) -> None:
        writer = df.write.format("parquet").mode("overwrite").option("path", place)
        if clustered:
            writer = writer.bucketBy(buckets, "order_id").sortBy("order_id")
        writer.saveAsTable(name)

    save(events.filter("order_id IS NOT NULL").repartition(buckets, "order_id"), table, f"{path}/by_order", True)
    save(events.filter("order_id IS NULL"), f"{table}_no_order", f"{path}/no_order", False)
