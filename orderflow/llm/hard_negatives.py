"""Hard-negative mining by shared candidate lists of anchor clusters.

Exact: every anchor gets its best rows of the same label (positives) and,
for each positive, the best rows of other labels whose score lies in a
window below the positive's.  Scores are integer inner products.

Anchors are clustered by direction.  A task reads its share of all rows
in blocks; for each cluster it bounds every row's score per unit of
anchor length by |row| * cos(angle to the centroid - widest angle of a
member), sorts the block by that bound once, and all members walk that
one list.  A member stops when the next bound times its own length is
below its worst kept score (or below the whole window): no later row of
the list can enter, which is certified by the angle bound and not a
guess.  Results of a task carry over from block to block, so later walks
end sooner; tasks hand on only their best rows per anchor, and Spark
merges these.

Anchors are broadcast in chunks of a bounded size; more anchors mean more
passes over the rows, not a larger broadcast.

Defined cases: rows without id, label or vector, with a NULL or
non-finite component, or whose integer vector has a squared length of
2^55 or more (scores would not fit) take no part; shorter vectors count
as padded with zeros; rows that repeat an id are each a candidate and,
if anchors, each mined, but never each other's positive; equal scores go
by the smaller id.  Only the named columns are looked at.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import map_batches, released, stored
from .vectors import centroids, dimension, matrix, unit

POSITIVES, NEGATIVES = 5, 10
#: A negative's score is between these percentages of the positive's.
LOW, HIGH = 30, 90
#: Components are multiplied by this and rounded down.
SCALE = 256
#: Anchors broadcast at once, in bytes of their float64 matrix.
CHUNK_BYTES = 32 << 20
#: Rows of a block, also in bytes.
BLOCK_ROWS, BLOCK_BYTES = 8_192, 32 << 20
#: Rows that a walk scores at a time.
STRIDE = 512
#: Squared lengths below which float64 sums of products are exact, also times 100.
EXACT = 2.0 ** 45
LARGEST = 2.0 ** 55
LOWEST = np.iinfo(np.int64).min


def quantised(rows: DataFrame, dim: int) -> DataFrame:
    """(vec_id, label, z): rows that take part, z the integer components."""
    def run(batch):
        x, ok = matrix(batch.column(batch.schema.get_field_index("embedding")), dim)
        z = np.floor(SCALE * np.where(ok[:, None], x, 0.0))
        ok &= np.einsum("ij,ij->i", z, z) < LARGEST
        flat = pa.array(np.where(ok[:, None], z, 0.0).astype(np.int64).ravel(), pa.int64())
        z = pa.ListArray.from_arrays(pa.array(np.arange(0, z.size + 1, dim), pa.int32()), flat) if dim else \
            pa.array([[] for _ in ok], pa.list_(pa.int64()))
        return {"z": z, "ok": pa.array(ok)}

    own = rows.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.col("label").cast("bigint").alias("label"),
                      "embedding").filter("vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL")
    return map_batches(own, run, "z array<bigint>, ok boolean", keep=["vec_id", "label"]).filter("ok").drop("ok")


class Anchors:
    """A chunk of anchors in clusters (sent to all tasks)."""

    def __init__(self, key, ids, label, z):
        self.key, self.ids, self.label = key, ids, label
        self.z = z.astype(np.float64)
        self.norm = np.sqrt(np.einsum("ij,ij->i", self.z, self.z))
        direction = unit(self.z)[0]
        self.centroid = np.zeros((0, z.shape[1]))
        self.members: list[np.ndarray] = []
        self.width: list[float] = []
        if len(ids):
            found = centroids(direction[:: max(1, len(ids) // 4096)], min(64, math.ceil(math.sqrt(len(ids)))))
            own = (direction @ found.T).argmax(axis=1)
            used = np.unique(own)
            self.centroid = found[used]
            for c in used:
                at = np.flatnonzero(own == c)
                self.members.append(at)
                # Widest angle of a member; a member of length zero scores zero with any row.
                cosine = (direction[at] @ found[c])[self.norm[at] > 0]
                self.width.append(float(np.arccos(np.clip(cosine, -1, 1)).max(initial=0.0)) + 1e-6)

    def lists(self, z: np.ndarray, norm: np.ndarray):
        """Per cluster: members, the block's rows by falling bound, and the bounds."""
        direction = z / np.where(norm > 0, norm, 1.0)[:, None]
        for c, members, width in zip(self.centroid, self.members, self.width):
            angle = np.arccos(np.clip(direction @ c, -1, 1))
            bound = norm * np.cos(np.maximum(0.0, angle - width)) * (1 + 1e-9) + 1e-6
            order = np.argsort(-bound, kind="stable")
            yield members, order, bound[order]


class Best:
    """The best ``k`` (score, id) of each slot, by score, then smaller id."""

    def __init__(self, slots: int, k: int):
        self.score = np.full((slots, k), LOWEST, np.int64)
        self.id = np.full((slots, k), np.iinfo(np.int64).max, np.int64)

    def worst(self, slots: np.ndarray) -> np.ndarray:
        return self.score[slots, -1]

    def add(self, slots: np.ndarray, score: np.ndarray, ids: np.ndarray, valid: np.ndarray) -> None:
        """``score`` and ``valid``: slots x rows; ``ids``: of the rows."""
        valid = valid & (score >= self.worst(slots)[:, None])
        some = np.flatnonzero(valid.any(axis=1))
        if not len(some):
            return
        use = np.flatnonzero(valid[some].any(axis=0))
        slots, score, valid = slots[some], score[np.ix_(some, use)], valid[np.ix_(some, use)]
        all_scores = np.concatenate([self.score[slots], np.where(valid, score, LOWEST)], axis=1)
        all_ids = np.concatenate([self.id[slots], np.where(valid, ids[use], np.iinfo(np.int64).max)], axis=1)
        top = np.lexsort((all_ids, -(all_scores + 1)), axis=1)[:, :self.score.shape[1]]  # + 1: LOWEST has no negative
        self.score[slots] = np.take_along_axis(all_scores, top, 1)
        self.id[slots] = np.take_along_axis(all_ids, top, 1)


def blocks(batches, dim: int):
    """(ids, labels, z, norms) of up to ``BLOCK_ROWS`` rows."""
    most = max(1, min(BLOCK_ROWS, BLOCK_BYTES // (8 * max(dim, 1))))
    held, n = [], 0
    for batch in batches:
        for at in range(0, batch.num_rows, most):
            part = batch.slice(at, most)
            if n and n + part.num_rows > most:
                yield _block(held, dim)
                held, n = [], 0
            held.append(part)
            n += part.num_rows
    if n:
        yield _block(held, dim)


def _block(held: list, dim: int):
    t = pa.Table.from_batches(held)
    z = matrix(t.column("z"), dim)[0]
    return (np.asarray(t.column("vec_id")), np.asarray(t.column("label")), z,
            np.sqrt(np.einsum("ij,ij->i", z, z)))


def products(a: np.ndarray, b: np.ndarray, exact: bool) -> np.ndarray:
    """Integer inner products; float64 sums are exact below ``EXACT``."""
    if exact:
        return (a @ b.T).astype(np.int64)
    return a.astype(np.int64) @ b.astype(np.int64).T


def walk_positives(anchors: Anchors, batches, dim: int, k: int):
    """(anchor index, id, score) of a share of the rows."""
    best = Best(len(anchors.ids), k)
    longest = anchors.norm.max(initial=0.0)
    for ids, label, z, norm in blocks(batches, dim):
        exact = max(longest, norm.max()) ** 2 < EXACT
        for members, order, bound in anchors.lists(z, norm):
            for at in range(0, len(order), STRIDE):
                # Equal scores may still win by id, so only smaller bounds end a walk.
                members = members[best.worst(members) <= bound[at] * anchors.norm[members] + 1e-6]
                if not len(members):
                    break
                rows = order[at:at + STRIDE]
                valid = (anchors.label[members][:, None] == label[rows]) & (anchors.ids[members][:, None] != ids[rows])
                best.add(members, products(anchors.z[members], z[rows], exact), ids[rows], valid)
    slot, place = np.nonzero(best.score > LOWEST)
    return slot, best.id[slot, place], best.score[slot, place]


def walk_negatives(anchors: Anchors, owner: np.ndarray, positive: np.ndarray, batches, dim: int, k: int,
                   low: int, high: int):
    """(window index, id, score); a window is a positive's score and the anchor that owns it."""
    best = Best(len(owner), k)
    longest = anchors.norm.max(initial=0.0)
    first = np.searchsorted(owner, np.arange(len(anchors.ids) + 1))
    for ids, label, z, norm in blocks(batches, dim):
        exact = max(longest, norm.max()) ** 2 < EXACT
        for members, order, bound in anchors.lists(z, norm):
            windows = np.concatenate([np.arange(first[m], first[m + 1]) for m in members])
            for at in range(0, len(order), STRIDE):
                reach = bound[at] * anchors.norm[owner[windows]] + 1e-6
                windows = windows[(best.worst(windows) <= reach) & (low * positive[windows] <= 100 * reach + 1e-3)]
                if not len(windows):
                    break
                rows = order[at:at + STRIDE]
                used, which = np.unique(owner[windows], return_inverse=True)
                score = products(anchors.z[used], z[rows], exact)[which]
                p = positive[windows][:, None]
                valid = ((anchors.label[owner[windows]][:, None] != label[rows]) & (low * p <= 100 * score)
                         & (100 * score <= high * p))
                best.add(windows, score, ids[rows], valid)
    slot, place = np.nonzero(best.score > LOWEST)
    return slot, best.id[slot, place], best.score[slot, place]


def first_rows(rows: DataFrame, keys: list[str], k: int) -> DataFrame:
    """The first ``k`` rows of each key by score, then id, with their rank."""
    w = Window.partitionBy(*keys).orderBy(F.col("score").desc(), F.col("other"))
    return rows.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def _pass(rows: DataFrame, anchors: DataFrame, dim: int, chunks: int, path: str, walk, schema: str,
          columns: list[str]) -> DataFrame:
    """``walk`` over all rows for each chunk of anchors, appended to ``path``."""
    sc = rows.sparkSession.sparkContext
    for chunk in range(chunks):
        own = anchors.filter(F.pmod(F.xxhash64("key"), F.lit(chunks)) == chunk).toArrow()
        z = matrix(own.column("z"), dim)[0]
        held = Anchors(*[np.asarray(own.column(c)) for c in ("key", "vec_id", "label")], z)
        sent = sc.broadcast((held, [own.column(c).combine_chunks() for c in columns]))

        def run(batches, sent=sent):
            data, more = sent.value
            found = walk(data, more, batches)
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in found], names=[c.split()[0] for c in schema.split(", ")])

        rows.mapInArrow(released(run), schema).write.mode("append").parquet(path)
        sent.destroy()
    return rows.sparkSession.read.schema(schema).parquet(path)


def mine(rows: DataFrame, is_anchor: Column, positives: int = POSITIVES, negatives: int = NEGATIVES,
         low: int = LOW, high: int = HIGH) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score
    of rows (vec_id, label, embedding)."""
    spark = rows.sparkSession
    dim = dimension(rows, "embedding")
    used = stored(quantised(rows, dim), "mine-rows")
    anchors = stored(used.filter(is_anchor).withColumn("key", F.monotonically_increasing_id()), "mine-anchors")
    chunks = max(1, math.ceil(anchors.count() * 8 * max(dim, 1) / CHUNK_BYTES))

    def near(data, more, batches):
        slot, other, score = walk_positives(data, batches, dim, positives)
        return data.key[slot], data.ids[slot], other, score

    found = _pass(used, anchors, dim, chunks, scratch_path(spark, "llm-mine-positives"), near,
                  "key bigint, anchor_id bigint, other bigint, score bigint", [])
    pairs = stored(first_rows(found, ["key"], positives).drop("rank"), "mine-pairs")
    # An anchor's windows: at most ``positives`` different scores.
    windows = pairs.groupBy("key").agg(F.array_sort(F.collect_set("score")).alias("scores"))
    mined = stored(anchors.join(windows, "key"), "mine-windows")

    def far(data, more, batches):
        length = np.diff(np.asarray(more[0].offsets))
        owner = np.repeat(np.arange(len(data.ids)), length)
        score = np.asarray(more[0].flatten())
        slot, other, negative = walk_negatives(data, owner, score, batches, dim, negatives, low, high)
        return data.key[owner[slot]], score[slot], other, negative

    hard = _pass(used, mined, dim, chunks, scratch_path(spark, "llm-mine-negatives"), far,
                 "key bigint, positive_score bigint, other bigint, score bigint", ["scores"])
    ranked = first_rows(hard, ["key", "positive_score"], negatives).select(
        "key", "positive_score", "rank", F.col("other").alias("negative_id"), F.col("score").alias("negative_score"))
    return pairs.withColumnsRenamed({"other": "positive_id", "score": "positive_score"}).join(
        ranked, ["key", "positive_score"]).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def op13(embeddings: DataFrame) -> DataFrame:
    """Anchors are rows whose id is divisible by 100; where it is divisible
    by 7 the label is first moved on by one, modulo 10."""
    label = F.col("label").cast("bigint")
    rows = embeddings.select(
        F.col("vec_id").cast("bigint").alias("vec_id"),
        F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label).alias("label"), "embedding")
    return mine(rows, F.col("vec_id") % 100 == 0)
