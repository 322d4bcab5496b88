"""Shared helpers: table access, Arrow row maps, scratch tables, hashing."""

from __future__ import annotations

import gc
import sys
import types
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.joins import plan_size_bytes
from ..session import checkpoint_root, scratch_path

#: Remainder classes of crc32(doc_id as text); class 0 is held out.
HOLD_OUT = 5

#: Compressed bytes of a table that may go through the driver's memory as a
#: broadcast: there its rows take 10 to 30 times that while they are hashed.
DRIVER_BYTES = 2 << 20

#: Rows a Python task handles at once.
SLICE = 512

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def held_out(doc_id: str = "doc_id") -> Column:
    """Rows that no model may learn from (a NULL id counts as empty text)."""
    key = F.coalesce(F.col(doc_id).cast("string"), F.lit(""))
    return F.crc32(F.encode(key, "UTF-8")) % HOLD_OUT == 0


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only.  ``lower`` is the same on ASCII text and much
    faster than ``translate``, which handles the rest."""
    return F.when(F.length(text) == F.octet_length(text), F.lower(text)) \
        .otherwise(F.translate(text, UPPER, LOWER))


def bounded_batches(spark: SparkSession) -> SparkSession:
    """Keep Arrow batches small when texts are long."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1024")
    return spark


#: Scratch tables written inside open ``freed`` blocks, innermost last.
_made: list[list[str]] = []


def stored(df: DataFrame, tag: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write to a new folder of the shared scratch space and read it back.

    Cuts lineage: what follows reads files that outlive any executor.
    """
    spark = df.sparkSession
    checkpoint_root(spark)
    path = scratch_path(spark, f"llm-{tag}")
    writer = df.write.mode("errorifexists")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    if _made:
        _made[-1].append(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def freed(spark: SparkSession):
    """Delete the scratch tables written inside the block when it ends.

    Nothing that is used later may read them lazily.  Shuffle files go when
    the driver no longer refers to their plans, so its garbage is collected
    as well (they would else stay until it happens to be).
    """
    _made.append([])
    try:
        yield
    finally:
        jvm = spark.sparkContext._jvm
        conf = spark.sparkContext._jsc.hadoopConfiguration()
        for path in _made.pop():
            place = jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(conf).delete(place, True)
        gc.collect()
        jvm.System.gc()


def settled(spark: SparkSession, tag: str, make: Callable[[], DataFrame]) -> DataFrame:
    """The result of ``make``, stored; the scratch tables behind it go."""
    outer = _made[-1] if _made else None
    with freed(spark):
        out = stored(make(), tag)
        path = _made[-1].pop()
    if outer is not None:
        outer.append(path)
    return out


def shielded(docs: DataFrame, operator: Callable[[DataFrame], DataFrame],
             used: tuple[str, ...] = ("doc_id", "text")) -> DataFrame:
    """``operator`` over ``docs`` with other names for the columns that it
    does not use, so that none of its own can clash; it must return the
    columns that it got, in order."""
    names = docs.columns
    return operator(docs.toDF(*[n if n in used else f"_column_{i}" for i, n in enumerate(names)])).toDF(*names)


def shuffle_partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def small_side(table: DataFrame) -> DataFrame:
    """Hint for a stored table that is joined: broadcast up to
    ``DRIVER_BYTES``, beyond that a join by shuffle, whatever size the
    session broadcasts by itself."""
    size = plan_size_bytes(table)
    return F.broadcast(table) if size is not None and size <= DRIVER_BYTES else table.hint("merge")


def released(fn: Callable, stage: Callable | None = None) -> Callable:
    """``fn`` over Arrow batches, after which the worker gives the memory it
    has freed back to the machine (workers stay alive between tasks).

    What other functions left in the worker with ``worker_cache`` goes
    before: a worker holds the objects of one stage only (``stage``: the
    function that tells it, if not ``fn``)."""
    code = (stage or fn).__code__
    owner = f"{code.co_filename}:{code.co_firstlineno}"

    def run(batches):
        let_in(owner)
        try:
            yield from fn(batches)
        finally:
            give_back()

    return run


def give_back() -> None:
    """Give freed memory of this process back to the machine."""
    import ctypes

    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def map_batches(df: DataFrame, fn: Callable[[pa.RecordBatch], dict], schema: str | T.StructType,
                keep: list[str] | None = None, rows: int = SLICE) -> DataFrame:
    """Run ``fn`` on each Arrow batch; it returns name -> Arrow array.

    ``keep`` names columns of ``df`` passed through unchanged (``fn`` must
    then return arrays as long as the batch).  ``schema`` describes only
    the new columns, ``rows`` the most rows given to ``fn`` at once.
    """
    new = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    kept = keep or []
    out = T.StructType([df.schema[c] for c in kept] + list(new.fields))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, rows):
                batch = whole.slice(at, rows)
                cols = fn(batch)
                arrays = [batch.column(batch.schema.get_field_index(c)) for c in kept]
                names = kept + [f for f in cols]
                yield pa.RecordBatch.from_arrays(arrays + list(cols.values()), names=names)

    return df.mapInArrow(released(run, fn), out)


def texts_of(batch: pa.RecordBatch, name: str = "text") -> list:
    return batch.column(batch.schema.get_field_index(name)).to_pylist()


def _worker_home() -> types.ModuleType:
    return sys.modules.setdefault("_orderflow_llm_worker", types.ModuleType("_orderflow_llm_worker"))


def let_in(owner: str) -> None:
    """Drop what ``worker_cache`` keeps in this worker if it was made for
    another ``owner``."""
    home = _worker_home()
    if getattr(home, "__owner", None) == owner:
        return
    left = [k for k in vars(home) if not k.startswith("__")]
    for name in left:
        delattr(home, name)
    if left:
        give_back()
    setattr(home, "__owner", owner)


def worker_cache(name: str, factory: Callable, alone: bool = False):
    """An object kept in this Python worker between tasks of one stage (it
    only saves work: a new worker builds it again).

    ``alone`` is for large objects: those of other names go before it is
    built.
    """
    home = _worker_home()
    if not hasattr(home, name):
        if alone:
            for other in [k for k in vars(home) if not k.startswith("__")]:
                delattr(home, other)
            give_back()
        setattr(home, name, factory())
    return getattr(home, name)


class WordHashes(dict):
    """word (bytes) -> 64-bit hash, filled on demand and bounded."""

    LIMIT = 120_000

    def __missing__(self, word: bytes) -> int:
        import xxhash

        value = xxhash.xxh64_intdigest(word)
        self[word] = value
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        if len(self) > self.LIMIT:
            self.clear()
        return np.fromiter(map(self.__getitem__, words), dtype=np.uint64, count=len(words))


def word_hashes() -> WordHashes:
    return worker_cache("word_hashes", WordHashes)


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash (wrapping arithmetic)."""
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


#: Masks of the first 0 to 8 bytes of a little-endian 64-bit number.
_FIRST = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)
#: Words up to this many bytes are hashed eight bytes at a time, together.
_SHORT = 256
#: Bytes of text hashed at once.
_TEXT_BYTES = 4 << 20


def text_groups(texts: list, most: int = _TEXT_BYTES) -> Iterator[list[bytes]]:
    """Texts as UTF-8, A-Z lower-cased, in groups of about ``most`` bytes."""
    held, size = [], 0
    for t in texts:
        blob = (t or "").encode("utf-8", "surrogatepass").lower()
        if held and size + len(blob) > most:
            yield held
            held, size = [], 0
        held.append(blob)
        size += len(blob)
    if held:
        yield held


def hashed_words(blobs: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words (cut at ASCII white space) of the texts in
    order, and where each text's words begin (one entry more than texts)."""
    whole = b"\n" + b"\n".join(blobs) + b"\n" + bytes(8)
    b = np.frombuffer(whole, np.uint8)[:-8]
    blank = (b == 32) | ((b >= 9) & (b <= 13))
    turns = np.flatnonzero(blank[1:] != blank[:-1]) + 1  # where a word begins, where it ends, ...
    at, size = turns[0::2], turns[1::2] - turns[0::2]
    begins = np.cumsum([1, *[len(x) + 1 for x in blobs]])
    edges = np.searchsorted(at, begins)
    eight = np.ndarray((len(whole) - 7,), "<u8", whole, strides=(1,))
    hashes = mix(size.astype(np.uint64))
    for k in np.flatnonzero(size > _SHORT):
        import xxhash

        hashes[k] = xxhash.xxh64_intdigest(whole[at[k]:at[k] + size[k]])
    todo = np.flatnonzero(size <= _SHORT)
    done = 0
    while len(todo):
        left = size[todo] - done
        block = eight[at[todo] + done] & _FIRST[np.minimum(left, 8)]
        hashes[todo] = mix(hashes[todo] ^ block)
        done += 8
        todo = todo[left > 8]
    return hashes, edges


def shingle_hashes(words: np.ndarray, width: int) -> np.ndarray:
    """Hash of every ``width`` consecutive word hashes, in order."""
    n = len(words) - width + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    acc = mix(words[:n])
    for k in range(1, width):
        acc = mix(acc * np.uint64(0x9E3779B97F4A7C15) + words[k:k + n])
    return acc


def binary_list(rows: list[np.ndarray], dtype: np.dtype, kind: pa.DataType) -> pa.ListArray:
    """Arrow list column from one numpy array per row."""
    offsets = np.zeros(len(rows) + 1, np.int32)
    np.cumsum([len(r) for r in rows], out=offsets[1:])
    flat = np.concatenate(rows) if rows else np.empty(0, dtype)
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat.astype(dtype), kind))
