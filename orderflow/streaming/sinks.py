"""Streaming sinks: append tables and complete-mode aggregate tables.

All runs are one-shot (``availableNow``) and checkpointed, so a rerun
picks up only new input and a failed run resumes where it stopped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def finish(q: StreamingQuery) -> StreamingQuery:
    """Wait for a one-shot run; its failure is raised here."""
    q.awaitTermination()
    err = q.exception()
    if err is not None:
        raise RuntimeError(f"streaming query failed: {err}")
    return q


def run_append(df: DataFrame, path: str | None, checkpoint: str,
               partition_by: list[str] | None = None, table: str | None = None,
               fmt: str = "parquet") -> StreamingQuery:
    """Append a stream to a file table (``path``) or a catalog ``table``.

    The file sink commits through its ``_spark_metadata`` log, so a batch
    retried after a failure is not written twice, and a streaming reader
    of ``path`` sees only committed files.
    """
    w = (df.writeStream.format(fmt).outputMode("append")
         .option("checkpointLocation", checkpoint).trigger(availableNow=True))
    if partition_by:
        w = w.partitionBy(*partition_by)
    q = w.toTable(table) if table else w.start(path)
    return finish(q)


def run_aggregate(df: DataFrame, path: str, checkpoint: str,
                  partition_by: list[str] | None = None, keep_versions: int = 2,
                  name: str | None = None) -> StreamingQuery:
    """Keep a streaming aggregate as a table in complete mode.

    File sinks reject complete mode, so each micro-batch writes the full
    result to its own version folder ``v<batch>`` and then records the
    version in ``_commits``.  A retried batch rewrites the same folder
    (idempotent); readers take the newest committed version and never
    see a half-written table.  Versions older than the newest
    ``keep_versions`` are deleted after each commit, so storage holds a
    bounded number of copies (a reader still on the previous version is
    not cut off when ``keep_versions >= 2``).  ``name`` is a catalog view
    of the newest version; each commit moves it on before it deletes, so
    it never names a deleted folder, also in a run that fails midway.
    """
    def write_version(batch: DataFrame, batch_id: int) -> None:
        target = f"{path}/v{batch_id:012d}"
        w = batch.write.mode("overwrite")
        if partition_by:
            w = w.partitionBy(*partition_by)
        w.parquet(target)
        (batch.sparkSession.range(1)
         .select(F.lit(batch_id).cast("bigint").alias("batch_id"), F.lit(target).alias("path"))
         .write.mode("overwrite").json(f"{path}/_commits/b{batch_id:012d}"))
        if name:
            batch.sparkSession.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT * FROM parquet.`{target}`")
        if keep_versions and batch_id >= keep_versions:
            _delete_older(batch.sparkSession, path, batch_id - keep_versions + 1)

    q = (df.writeStream.outputMode("complete").foreachBatch(write_version)
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    return finish(q)


def _delete_older(spark: SparkSession, path: str, first_kept: int) -> None:
    """Delete version folders and commit markers below ``first_kept``
    (Hadoop FileSystem API, so it works on any shared store)."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    root = jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(conf)
    for sub, prefix in (("", "v"), ("/_commits", "b")):
        folder = jvm.org.apache.hadoop.fs.Path(path + sub)
        if not fs.exists(folder):
            continue
        for st in fs.listStatus(folder):
            name = st.getPath().getName()
            if name.startswith(prefix) and name[1:].isdigit() and int(name[1:]) < first_kept:
                fs.delete(st.getPath(), True)


def read_aggregate(spark: SparkSession, path: str) -> DataFrame:
    """The newest committed version written by ``run_aggregate``."""
    return spark.read.parquet(latest_version(spark, path))


def latest_version(spark: SparkSession, path: str) -> str:
    """Folder of the newest committed version."""
    latest = (spark.read.schema("batch_id bigint, path string").json(f"{path}/_commits/*")
              .orderBy(F.desc("batch_id")).select("path").first())
    if latest is None:
        raise FileNotFoundError(f"no committed version under {path}")
    return latest["path"]
