"""Filter interaction audit by a Gray-code walk over subsets of filters.

Each document gets a mask of the filters it fails.  Spark counts the
documents of every (part, mask) cell; with five filters a part has 32
cells, however many documents it has.  A walk then visits all 32 subsets
of filters in Gray-code order: each step toggles one filter, which moves
the active-failure counter of the cells that fail it by one; a cell whose
counter leaves zero drops out of the running survivors, one that returns
to zero comes back.  The survivors of every subset are stored, and what a
filter removes at a step of an order is the difference of two of them.

The walk is vectorised over the parts of an Arrow batch, and parts are
spread over tasks, so their number is not bounded either.

Defined cases: NULL text is empty; a NULL part is the empty string; a
document fails ``repeats`` if its text is that of a row with a smaller id
(rows that repeat an id do not fail through each other, and a row without
id neither fails nor makes others fail); a label repeated for an id
counts if any of its rows has it; no documents give no rows.  Only the
named columns are looked at.
"""

from __future__ import annotations

from itertools import permutations
from math import factorial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.joins import left_join_nonnull
from .common import released

#: Separates words.
BLANK = r"[\x20\x09-\x0D]+"
#: Parts a task walks at once.
PARTS = 64

CELL = "part string, cells array<struct<mask:int,n:bigint,good:bigint,toxic:bigint>>"
RESULT = ("part string, filter_order string, step int, kept bigint, removed bigint, redundant bigint, "
          "unique_fails bigint, good_lost bigint, toxic_lost bigint, shapley bigint")


def text_filters(docs: DataFrame) -> tuple[DataFrame, dict[str, Column]]:
    """``docs`` with word counts, and the failure conditions A to D on it."""
    words = F.array_remove(F.split("text", BLANK), "")
    d = docs.withColumn("words", words).withColumn("n", F.size("words")).withColumn(
        "distinct", F.size(F.array_distinct("words"))).drop("words")
    capitals = F.length(F.regexp_replace("text", "[^A-Z]+", ""))
    return d, {
        "A": F.col("n") < 100,
        "B": 100 * F.col("distinct").cast("bigint") < 80 * F.col("n").cast("bigint"),
        "C": 100 * capitals.cast("bigint") > 10 * F.length("text").cast("bigint"),
        "D": F.col("text").rlike("[#$%&*|]"),
    }


def mask_of(filters: list[Column]) -> Column:
    """Bit k is set for rows that fail filter k."""
    out = F.lit(0)
    for k, fails in enumerate(filters):
        out = out + F.when(fails, F.lit(1 << k)).otherwise(F.lit(0))
    return out.cast("int")


def cells(docs: DataFrame, labels: DataFrame, part: str = "lang") -> DataFrame:
    """(part, mask, n, good, toxic): documents by failed filters A to E.

    Texts travel as digests.  Rows of one text are pre-aggregated in the
    map tasks (their masks are equal but for E), so a text that a third of
    all rows share is a few rows afterwards; the smallest id decides E.
    """
    base = docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text"),
                       F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"))
    counted, fails = text_filters(base)
    rows = counted.select("doc_id", "part", F.unhex(F.sha2("text", 256)).alias("digest"),
                          mask_of(list(fails.values())).alias("mask"))
    known = labels.groupBy(F.col("doc_id").alias("label_id")).agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"),
        F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    one = left_join_nonnull(rows, known, "doc_id", "label_id").select(
        "doc_id", "part", "digest", "mask", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("good", "toxic")])
    same = ["digest", "part", "mask", "good", "toxic"]
    per_id = one.groupBy("doc_id", *same).agg(F.count(F.lit(1)).alias("copies"))
    has_id = F.col("doc_id").isNotNull()
    texts = per_id.groupBy(*same).agg(
        F.sum("copies").alias("n"), F.sum(F.when(~has_id, F.col("copies")).otherwise(0)).alias("no_id"),
        F.min(F.when(has_id, F.struct("doc_id", "copies"))).alias("least"))
    smallest = F.min("least.doc_id").over(Window.partitionBy("digest"))
    first = F.when(F.col("least.doc_id") == smallest, F.col("least.copies")).otherwise(0) + F.col("no_id")
    both = texts.withColumn("first", first).select("part", "good", "toxic", F.inline(F.array(
        F.struct(F.col("mask").alias("mask"), F.col("first").alias("n")),
        F.struct((F.col("mask") + (1 << len(fails))).alias("mask"), (F.col("n") - F.col("first")).alias("n")))))
    return both.filter("n > 0").groupBy("part", "mask").agg(
        F.sum("n").alias("n"), F.sum(F.col("n") * F.col("good")).alias("good"),
        F.sum(F.col("n") * F.col("toxic")).alias("toxic"))


def survivors(counts: np.ndarray, filters: int) -> np.ndarray:
    """``counts`` (parts, masks, measures) -> the same, by active subset.

    Subsets are visited in Gray-code order, one filter toggled at a time.
    """
    masks = np.arange(1 << filters)
    failing = [masks[(masks >> k) & 1 == 1] for k in range(filters)]
    active = np.zeros(len(masks), np.int64)  # active failures of each cell
    now = counts.sum(axis=1)  # no filter is active: all survive
    states = np.zeros_like(counts)
    states[:, 0] = now
    subset = 0
    for step in range(1, len(masks)):
        k = (step & -step).bit_length() - 1  # the bit that this Gray code flips
        subset ^= 1 << k
        hit = failing[k]
        if subset >> k & 1:
            now = now - counts[:, hit[active[hit] == 0]].sum(axis=1)
            active[hit] += 1
        else:
            active[hit] -= 1
            now = now + counts[:, hit[active[hit] == 0]].sum(axis=1)
        states[:, subset] = now
    return states


def report(parts: list[str], counts: np.ndarray, letters: str) -> dict[str, pa.Array]:
    """All orders and steps of the parts as output columns."""
    k = len(letters)
    states = survivors(counts, k)
    full = (1 << k) - 1
    kept = states[:, :, 0]
    fails = [kept[:, 0] - kept[:, 1 << f] for f in range(k)]
    alone = [kept[:, full ^ 1 << f] - kept[:, full] for f in range(k)]
    value = [sum(factorial(s.bit_count()) * factorial(k - 1 - s.bit_count()) * (kept[:, s] - kept[:, s | 1 << f])
                 for s in range(full + 1) if not s >> f & 1) for f in range(k)]
    orders, steps, rows = [], [], []
    for order in permutations(range(k)):
        before = 0
        for step, f in enumerate(order, 1):
            after = before | 1 << f
            lost = states[:, before] - states[:, after]
            orders.append("".join(letters[x] for x in order))
            steps.append(step)
            rows.append([kept[:, after], lost[:, 0], fails[f] - lost[:, 0], alone[f], lost[:, 1], lost[:, 2], value[f]])
            before = after
    table = np.array(rows)  # (orders x steps, measures, parts)
    n = len(orders)
    out = {"part": pa.array(np.repeat(np.array(parts, object), n), pa.string()),
           "filter_order": pa.array(orders * len(parts), pa.string()),
           "step": pa.array(steps * len(parts), pa.int32())}
    names = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    return out | {name: pa.array(table[:, i, :].T.ravel(), pa.int64()) for i, name in enumerate(names)}


def audit(counted: DataFrame, letters: str) -> DataFrame:
    """One row per part, order of the filters and step, from ``cells``."""
    grouped = counted.groupBy("part").agg(F.collect_list(F.struct(
        *[F.col(c).cast(t).alias(c) for c, t in (("mask", "int"), ("n", "bigint"), ("good", "bigint"),
                                                 ("toxic", "bigint"))])).alias("cells"))

    def run(batches):
        for whole in batches:
            for at in range(0, whole.num_rows, PARTS):
                batch = whole.slice(at, PARTS)
                parts = batch.column(0).to_pylist()
                counts = np.zeros((len(parts), 1 << len(letters), 3), np.int64)
                for i, found in enumerate(batch.column(1).to_pylist()):
                    for c in found:
                        counts[i, c["mask"]] = c["n"], c["good"], c["toxic"]
                columns = report(parts, counts, letters)
                yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    return grouped.mapInArrow(released(run), RESULT)


def op12(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return audit(cells(docs, labels), "ABCDE")
