"""Exact dedup over an extendible-hash index on shared files.

Every row gets a 64-bit hash of its normalised text (A-Z lower-cased)
and a digest.  The index directory has two levels: the leading bits of a
hash pick a root, and the root lists its buckets by the first hash of
each.  A bucket that holds too many hashes is doubled at the next bit
that tells them apart, again and again, until it fits or holds one hash
only; there is no limit to its depth.  Rows are routed by the directory
to their bucket and pre-aggregated there in the map tasks, so a group of
copies costs one index entry however large it is.  Entries are written
in bucket and hash order to files in the shared scratch folder; a task
owns a range of buckets.  Inside a bucket, entries that share a hash are
chained by digest, and the bytes of all rows of an entry are compared
(their smallest and largest text must be equal); an entry that fails is
chained again by the text itself.  Rows find their group by bucket, hash
and digest.

All of it is DataFrame work.  Largest groups are joined by a broadcast
of at most ``HOT_SHARE`` entries, the rest by a shuffle join.

Defined cases: NULL text is empty; a NULL id never wins against another
id and stays if its group has no other; rows that repeat id and text are
one document (each says kept); other columns are not looked at.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.joins import BROADCAST_MAX_BYTES, broadcast_if_small, left_join_nonnull
from .common import ascii_lower, settled, shielded, shuffle_partitions, stored

#: Entries a bucket holds before it splits.
BUCKET_ENTRIES = 20_000
#: A group is hot when it has more than 1 / HOT_SHARE of all rows: there
#: are fewer than HOT_SHARE such groups, whatever the input.
HOT_SHARE = 1000


def normalised(text: str = "text") -> Column:
    return ascii_lower(F.coalesce(F.col(text), F.lit("")))


def text_digest(norm: Column) -> Column:
    return F.unhex(F.sha2(norm, 256))


def first_depth(entries: int, capacity: int) -> int:
    return max(1, math.ceil(math.log2(max(1, entries / capacity))))


def bits(hashed: Column, depth: int) -> Column:
    """Leading ``depth`` bits of a 64-bit hash."""
    return F.shiftrightunsigned(hashed, 64 - depth)


def _order(hashed: Column) -> Column:
    """Signed numbers in the order of the unsigned hashes."""
    return hashed.bitwiseXOR(F.lit(-(1 << 63)))


def directory(hashes: DataFrame, capacity: int = BUCKET_ENTRIES) -> tuple[DataFrame, int]:
    """((root, buckets), root bits) of distinct hashes (h).

    ``buckets``: (start, depth) of the root's buckets in order; ``start``
    is the bucket's first hash in ``_order`` and names it.
    """
    low = first_depth(hashes.count(), capacity)
    live = hashes.select("h", bits(F.col("h"), low).alias("root"), F.lit(low).alias("depth"))
    part = F.expr("shiftrightunsigned(h, 64 - depth)")
    leaves = None
    while True:
        sizes = stored(live.groupBy("root", "depth", part.alias("part")).agg(
            F.count(F.lit(1)).alias("n"), F.min(_order(F.col("h"))).alias("lo"), F.max(_order(F.col("h"))).alias("hi")),
            "dedup-directory")
        fits = (F.col("n") <= capacity) | (F.col("lo") == F.col("hi"))
        start = _order(F.expr("shiftleft(part, 64 - depth)"))
        fitting = sizes.filter(fits).select("root", F.struct(start.alias("start"), "depth").alias("b"))
        leaves = fitting if leaves is None else leaves.unionByName(fitting)
        # The next bit that tells the smallest and largest hash of a bucket apart.
        split = sizes.filter(~fits).select("root", "depth", "part", (
            F.lit(65) - F.length(F.bin(F.col("lo").bitwiseXOR(F.col("hi"))))).cast("int").alias("deeper"))
        if split.isEmpty():
            break
        live = live.withColumn("part", part).join(broadcast_if_small(split), ["root", "depth", "part"]).select(
            "h", "root", F.col("deeper").alias("depth"))
    return stored(leaves.groupBy("root").agg(F.sort_array(F.collect_list("b")).alias("buckets")), "dedup-roots"), low


def routed(rows: DataFrame, roots: DataFrame, low: int) -> DataFrame:
    """``rows`` (with h) with the ``bucket`` that the directory names."""
    own = F.filter("buckets", lambda b: b["start"] <= _order(F.col("h")))
    return rows.withColumn("root", bits(F.col("h"), low)).join(broadcast_if_small(roots), "root").withColumn(
        "bucket", F.element_at(own, -1)["start"]).drop("root", "buckets")


def build_index(rows: DataFrame) -> DataFrame:
    """Stored index (bucket, h, digest, keep_id, n) of routed rows."""
    entries = rows.groupBy("bucket", "h", "digest").agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("n"))
    return stored(entries.repartitionByRange(shuffle_partitions(rows), "bucket", _order(F.col("h")))
                  .sortWithinPartitions("bucket", _order(F.col("h")), "digest"), "dedup-index")


def probe(rows: DataFrame, groups: DataFrame, total: int, on: tuple[str, ...] = ("h", "digest"),
          most: int = BROADCAST_MAX_BYTES) -> DataFrame:
    """Left join of rows with their group (keep_id, n), safe for hot groups;
    groups of up to ``most`` bytes are broadcast."""
    groups = groups.select(*on, "keep_id", "n")
    limit = max(1, total // HOT_SHARE)
    hot = groups.filter(F.col("n") > limit)  # fewer than HOT_SHARE rows
    first = rows.join(F.broadcast(hot.select(*on, F.col("keep_id").alias("hot_id"),
                                             F.col("n").alias("hot_n"))), list(on), "left")
    key = F.struct(*on)
    cold = groups.filter(F.col("n") <= limit).select(key.alias("cold_key"), F.col("keep_id").alias("cold_id"),
                                                     F.col("n").alias("cold_n"))
    # Rows that are settled have no key here and are spread by the helper.
    first = first.withColumn("row_key", F.when(F.col("hot_n").isNull(), key))
    joined = left_join_nonnull(first, cold, "row_key", "cold_key", most)
    return (joined.withColumn("keep_id", F.coalesce("hot_id", "cold_id"))
            .withColumn("n", F.coalesce("hot_n", "cold_n"))
            .drop("hot_id", "hot_n", "row_key", "cold_key", "cold_id", "cold_n"))


def mixed_entries(docs: DataFrame, groups: DataFrame, text: str, hash_of: Callable, digest_of: Callable) -> DataFrame:
    """(h, digest) of entries of several rows that are not all the same bytes.

    Rows without id take part as any other.  Only texts whose hash is that
    of a group go on to the comparison, the smallest and largest of each
    map task's share.
    """
    wanted = stored(groups.select("h").distinct(), "dedup-group-hashes")
    some = docs.select(normalised(text).alias("norm")).withColumn("h", hash_of(F.col("norm"))).join(
        broadcast_if_small(wanted), "h", "left_semi")
    return (some.groupBy("h", digest_of(F.col("norm")).alias("digest"))
            .agg(F.min("norm").alias("lo"), F.max("norm").alias("hi"))
            .filter(F.col("lo") != F.col("hi")).select("h", "digest"))


def groups_of(docs: DataFrame, text: str = "text", hash_of: Callable = F.xxhash64,
              digest_of: Callable = text_digest, capacity: int = BUCKET_ENTRIES) -> DataFrame:
    """doc_id, keep_id, n, sha256 (hex) of every row."""
    def keyed(df: DataFrame) -> DataFrame:
        return (df.select("doc_id", normalised(text).alias("norm"))
                .withColumn("h", hash_of(F.col("norm"))).withColumn("digest", digest_of(F.col("norm")))
                .withColumn("sha256", F.sha2("norm", 256)))

    keys = stored(keyed(docs).select("doc_id", "h", "digest", F.unhex("sha256").alias("sha256")),
                  "dedup-keys")
    roots, low = directory(stored(keys.select("h").distinct(), "dedup-hashes"), capacity)
    placed = routed(keys, roots, low)
    total = keys.count()
    groups = build_index(placed).filter(F.col("n") > 1)
    mixed = stored(mixed_entries(docs, groups, text, hash_of, digest_of), "dedup-mixed")
    collisions = not mixed.isEmpty()
    plain = placed
    if collisions:
        plain = placed.join(broadcast_if_small(mixed), ["h", "digest"], "left_anti")
    out = probe(plain, groups, total, ("bucket", "h", "digest")).select(
        "doc_id", F.when(F.col("n").isNull(), F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("n", F.lit(1).cast("bigint")).alias("n"), F.lower(F.hex("sha256")).alias("sha256"))
    if collisions:  # chain by the text itself
        chained = keyed(docs).join(broadcast_if_small(mixed), ["h", "digest"], "left_semi")
        links = chained.groupBy("norm").agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("n"))
        out = out.unionByName(chained.join(links, "norm").select("doc_id", "keep_id", "n", "sha256"))
    return out


def op6(docs: DataFrame) -> DataFrame:
    return groups_of(docs).select(
        "doc_id", "keep_id", F.col("n").alias("group_size"),
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), F.col("sha256").alias("text_sha256"))


def keep_one(docs: DataFrame) -> DataFrame:
    """The rows that ``op6`` marks as kept, same columns.

    A row goes by its id and text: an id may repeat with other texts, and
    a row without id goes if its group has one with an id.
    """
    def run(docs: DataFrame) -> DataFrame:
        gone = settled(docs.sparkSession, "dedup-gone", lambda: groups_of(docs.select("doc_id", "text")).filter(
            ~F.col("doc_id").eqNullSafe(F.col("keep_id"))).select(
            F.col("doc_id").alias("_gone_id"), F.unhex("sha256").alias("_gone_sha")).distinct())
        rows = docs.withColumn("_text_sha", text_digest(normalised()))
        same = F.col("doc_id").eqNullSafe(F.col("_gone_id")) & (F.col("_text_sha") == F.col("_gone_sha"))
        return rows.join(broadcast_if_small(gone), same, "left_anti").drop("_text_sha")

    return shielded(docs, run)
