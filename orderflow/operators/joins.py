"""Join helpers: broadcast only behind a size check."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Largest side we hint for broadcast.  Above it the join stays a
# shuffle join; AQE may still switch to broadcast at run time when the
# measured shuffle output is small.
BROADCAST_MAX_BYTES = 16 * 1024 * 1024


def plan_size_bytes(df: DataFrame) -> int | None:
    """Optimizer's size estimate of ``df``, or None when it is not available.

    Of a file scan it is the compressed size; rows in memory can be
    several times that, which ``BROADCAST_MAX_BYTES`` leaves room for."""
    try:
        # Py4J hands a BigInt over as a Python int.
        return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    except Exception:  # noqa: BLE001 - estimate is advisory
        return None


def broadcast_if_small(df: DataFrame, max_bytes: int = BROADCAST_MAX_BYTES) -> DataFrame:
    """Hint a broadcast when the estimated size is within ``max_bytes``.

    Otherwise return ``df`` unchanged so the planner keeps a shuffle join.
    """
    size = plan_size_bytes(df)
    if size is not None and size <= max_bytes:
        return F.broadcast(df)
    return df


def left_join_nonnull(left: DataFrame, right: DataFrame, left_key: str, right_key: str,
                      broadcast_max_bytes: int = BROADCAST_MAX_BYTES) -> DataFrame:
    """Left join on one key, safe when many left rows have a NULL key.

    A NULL key never matches, but in a shuffle join all NULL-key rows hash
    to the same task.  The join key is a struct (key, salt): matchable rows
    use salt 0 on both sides, and each NULL-key row gets a salt >= 1 from a
    hash of its content (a retried task salts the same way).  NULL rows
    then spread over all tasks and still find no partner.  A struct key is
    used because a plain second key column holding a constant would be
    folded away by the optimizer.  ``right`` is broadcast only when its
    estimated size is within ``broadcast_max_bytes`` (no shuffle at all).
    """
    buckets = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    salt = F.when(F.col(left_key).isNull(),
                  F.pmod(F.xxhash64(*[F.col(c) for c in left.columns]), F.lit(buckets)) + 1
                  ).otherwise(F.lit(0).cast("bigint"))
    l = left.withColumn("_jk", F.struct(F.col(left_key).alias("k"), salt.alias("s")))
    r = (right.filter(F.col(right_key).isNotNull())
         .withColumn("_rjk", F.struct(F.col(right_key).cast(left.schema[left_key].dataType).alias("k"),
                                      F.lit(0).cast("bigint").alias("s"))))
    j = l.join(broadcast_if_small(r, broadcast_max_bytes), F.col("_jk") == F.col("_rjk"), "left")
    return j.drop("_jk", "_rjk")
