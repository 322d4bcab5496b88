"""Session set-up and shared scratch locations.

Everything the library writes for itself (streaming checkpoints, staged
JSON files, versioned aggregate tables, lineage cuts) goes under the
folder the cluster names in ``spark.checkpoint.dir``.  That folder is
shared storage on a cluster, so a lost executor never takes our files
with it.  We only pick a folder of our own when the session has none
(local runs and tests).
"""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def get_spark(master: str | None = None, app: str = "orderflow",
              shuffle_partitions: int | None = None,
              extra: dict[str, str] | None = None) -> SparkSession:
    """Build (or reuse) a session with the settings the library relies on."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        # transformWithStateInPandas needs the RocksDB state store.
        "spark.sql.streaming.stateStore.providerClass":
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def prepare(spark: SparkSession) -> SparkSession:
    """Pin the settings results depend on.

    Event times are UTC text; day and hour keys are only right when the
    session time zone is UTC as well.
    """
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder from ``spark.checkpoint.dir``; set one only if unset."""
    sc = spark.sparkContext
    root = sc.getCheckpointDir()
    if root:
        return root.rstrip("/")
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if not conf_dir:
        if not re.match(r"local(\[|$)", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder on shared storage "
                               "(checkpoints and scratch tables must survive executor loss)")
        # Local runs and tests only: one machine, so a temporary folder is shared.
        conf_dir = tempfile.mkdtemp(prefix="orderflow-ckpt-")
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, tag: str) -> str:
    """A new, unique folder under the shared checkpoint root."""
    return f"{checkpoint_root(spark)}/orderflow/{tag}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: materialise to the shared checkpoint folder.

    Survives executor loss (unlike a local checkpoint) and keeps long
    plans from being recomputed.
    """
    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame, tag: str) -> DataFrame:
    """Write to a new Parquet folder of the shared scratch space and read it back.

    Like a reliable checkpoint, but later scans read only the columns they
    need, and the size of the result is known to the optimizer.
    """
    path = scratch_path(df.sparkSession, tag)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def clear_scratch(spark: SparkSession) -> None:
    """Delete everything the library wrote under the shared scratch folder.

    Call it when the results that read those files are written elsewhere;
    running queries of any session on the same folder lose their files.
    """
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{checkpoint_root(spark)}/orderflow")
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
