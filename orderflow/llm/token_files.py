"""Token ids in ORC files.

Documents are dealt to tasks by ranges of doc_id and written in ascending
order as rows (doc_id, part, start_in_part, tokens).  Spark's ORC writer
keeps the integers run-length encoded in stripes, with a row index and a
Bloom filter on doc_id; a reader gets stripes in parallel, and a filter
on doc_id is answered from file, stripe and row-group metadata.

Defined cases: NULL text is empty and gives only the end id; a NULL id
sorts first; rows that repeat an id follow each other in text order; no
documents give files without rows; other columns are not stored.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import SLICE, binary_list, map_batches, shuffle_partitions, texts_of
from .tokens import encoder

#: Id appended to each document.
END_ID = 2
ORC_OPTIONS = {
    "orc.compress": "ZSTD",
    "orc.stripe.size": str(16 << 20),
    "orc.row.index.stride": "1000",
    "orc.bloom.filter.columns": "doc_id",
    "orc.bloom.filter.fpp": "0.01",
}
SCHEMA = "doc_id bigint, part int, start_in_part bigint, tokens array<int>"


def encoded(docs: DataFrame, vocabulary: str, end_id: int = END_ID) -> DataFrame:
    """Documents in doc_id order as rows of ``SCHEMA``."""
    n = shuffle_partitions(docs)
    ordered = (docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
               .repartitionByRange(n, "doc_id").sortWithinPartitions("doc_id", "text"))
    tail = np.array([end_id], "<u4").tobytes()

    def run(batches):
        part, at = TaskContext.get().partitionId(), 0
        for whole in batches:
            for first in range(0, whole.num_rows, SLICE):
                batch = whole.slice(first, SLICE)
                ids = [np.frombuffer(x + tail, "<u4") for x in encoder(vocabulary).ids(texts_of(batch))]
                sizes = np.array([len(x) for x in ids], np.int64)
                starts = at + np.concatenate([[0], np.cumsum(sizes)[:-1]]).astype(np.int64)
                at += int(sizes.sum())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array([part] * len(ids), pa.int32()), pa.array(starts),
                     binary_list(ids, np.int32, pa.int32())],
                    names=["doc_id", "part", "start_in_part", "tokens"])

    return ordered.mapInArrow(run, SCHEMA)


def write(docs: DataFrame, path: str, vocabulary: str, end_id: int = END_ID) -> None:
    encoded(docs, vocabulary, end_id).write.options(**ORC_OPTIONS).orc(path)


def read(spark: SparkSession, path: str, doc_ids: list[int] | None = None) -> DataFrame:
    """Rows of ``SCHEMA``; with ``doc_ids``, only stripes that may hold them."""
    rows = spark.read.schema(SCHEMA).orc(path)
    return rows if doc_ids is None else rows.filter(F.col("doc_id").isin(list(doc_ids)))


def digests(rows: DataFrame) -> DataFrame:
    """doc_id, part, start_in_part, n_tokens, ids_crc32 from the stored ids."""
    def run(batch):
        lists = batch.column(batch.schema.get_field_index("tokens"))
        values = np.asarray(lists.flatten()).astype("<u4", copy=False)
        edges = np.concatenate([[0], np.cumsum(np.asarray(lists.value_lengths()))]).astype(np.int64)
        crc = [zlib.crc32(values[a:b].tobytes()) for a, b in zip(edges[:-1], edges[1:])]
        return {"n_tokens": pa.array(np.diff(edges), pa.int64()), "ids_crc32": pa.array(crc, pa.int64())}

    return map_batches(rows, run, "n_tokens bigint, ids_crc32 bigint",
                       keep=["doc_id", "part", "start_in_part"])


def with_start(rows: DataFrame) -> DataFrame:
    """Add ``start``: ids of all documents before, over all parts."""
    parts = rows.groupBy("part").agg(F.sum("n_tokens").alias("size"))
    # One row per file part: as many as shuffle partitions.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = parts.select("part", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("base"))
    return rows.join(F.broadcast(base), "part").withColumn(
        "start", (F.col("base") + F.col("start_in_part")).cast("bigint"))


def op4(docs: DataFrame, vocabulary: str) -> DataFrame:
    from .common import checkpoint_root, stored

    spark = docs.sparkSession
    checkpoint_root(spark)
    path = scratch_path(spark, "llm-token-orc")
    write(docs, path, vocabulary)
    return with_start(stored(digests(read(spark, path)), "token-digests")).select(
        "doc_id", "start", "n_tokens", "ids_crc32")
