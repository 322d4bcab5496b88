"""Connected components of an edge table, by large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


#: Up to so many edges (16 bytes each) a round is one task without a shuffle.
ONE_TASK_EDGES = 250_000


def _pairs(first, second):
    return F.inline(F.array(*[F.struct(x.alias("u"), y.alias("v")) for x, y in (first, second)]))


def _large_star(edges: DataFrame) -> DataFrame:
    a, b = F.col("a"), F.col("b")
    both = edges.select(_pairs((a, b), (b, a)))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.join(least, "u").filter(F.col("v") > F.col("u")).select(
        F.col("v").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """``edges`` with a > b."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    a, b, m = F.col("a"), F.col("b"), F.col("m")
    return edges.join(least, "a").select(_pairs((a, m), (b, m))).filter("u <> v").select(
        F.col("u").alias("a"), F.col("v").alias("b")).distinct()


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first())


def connected(edges: DataFrame) -> DataFrame:
    """(node, component): nodes of ``edges`` (a, b) with the smallest node
    they can reach; nodes without an edge are not listed.

    Every round is written to shared storage.  The number of rounds grows
    with the logarithm of the longest chain.
    """
    now = stored(edges.filter(F.col("a") != F.col("b")).select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    state = _state(now)
    while state[0]:
        if state[0] <= ONE_TASK_EDGES:
            now = now.coalesce(1)
        now = stored(_small_star(_large_star(now).distinct()), "edges")
        new = _state(now)
        if new == state:
            break
        state = new
    # Every node now points at its smallest; add the roots themselves.
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
