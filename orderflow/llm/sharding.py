"""Sharding by a permutation-filled lookup table.

Every shard has its own preference order over the slots of a table of
prime size: ``(offset + j * skip) mod size``.  Shards take turns; in its
turn a shard claims its first preferred slot that is free.  All shards
get the same number of slots (within one) and few slots move when a
shard joins or leaves.  The table has a fixed size, independent of the
data (at most ``MAX_SLOTS``); it travels inside the plan as one array
constant, so a row's shard is a hash, a remainder and an array access,
without a shuffle, and rows of one hot source are placed by their own key.

Defined cases: a NULL key counts as empty text; repeated keys share a
slot; no shards is an error; extra columns pass through, and the columns
added replace columns of the same name.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Production parameters: shards and slots (a prime).
SHARDS = 96
SLOTS = 65_537
MAX_SLOTS = 1_000_003


def _number(name: str, salt: str) -> int:
    return int(hashlib.md5(f"{salt}:{name}".encode()).hexdigest()[:15], 16)


def is_prime(n: int) -> bool:
    return n > 1 and all(n % k for k in range(2, int(n ** 0.5) + 1))


def lookup_table(shards: list[str], slots: int = SLOTS) -> list[int]:
    """Index of the shard that owns each slot."""
    if not shards:
        raise ValueError("no shards")
    if len(set(shards)) != len(shards) or not is_prime(slots) or not len(shards) <= slots <= MAX_SLOTS:
        raise ValueError("shard names must differ, and slots be a prime, from their number to MAX_SLOTS")
    at = [_number(s, "offset") % slots for s in shards]
    skip = [_number(s, "skip") % (slots - 1) + 1 for s in shards]
    owner = [-1] * slots
    free = slots
    while True:
        for k in range(len(shards)):
            while owner[at[k]] >= 0:
                at[k] = (at[k] + skip[k]) % slots
            owner[at[k]] = k
            free -= 1
            if not free:
                return owner


def slot_of(key: Column, slots: int = SLOTS) -> Column:
    digest = F.md5(F.encode(F.coalesce(key.cast("string"), F.lit("")), "UTF-8"))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("bigint") % slots


def place(df: DataFrame, key: str, shards: list[str], slots: int = SLOTS) -> DataFrame:
    """``df`` with ``slot`` and ``shard`` (index into ``shards``)."""
    owners = ",".join(map(str, lookup_table(shards, slots)))
    table = F.from_json(F.lit(f"[{owners}]"), "array<int>")  # folded to one constant
    return (df.withColumn("slot", slot_of(F.col(key), slots))
            .withColumn("shard", F.element_at(table, (F.col("slot") + 1).cast("int"))))


def shard_names(n: int = SHARDS) -> list[str]:
    return [f"shard-{k:04d}" for k in range(n)]


def op5(docs: DataFrame) -> DataFrame:
    return place(docs.select("doc_id"), "doc_id", shard_names()).select("doc_id", "slot", "shard")
