from __future__ import annotations

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from orderflow.llm import exact_dedup, sharding

LONG = "Word " * 20_000
ROWS = [(1, "Same"), (2, "sAME"), (3, None), (4, ""), (5, "other"), (6, "É"), (7, "é"), (8, LONG), (9, LONG.lower()),
        (10, "other"), (10, "other"), (None, "lone"), (None, "Other")]


def expected(rows):
    norm = [(d, "".join(c.lower() if c.isascii() else c for c in t or "")) for d, t in rows]
    out = []
    for d, t in norm:
        ids = [i for i, x in norm if x == t and i is not None]
        keep = max(ids) if ids else None
        out.append((d, keep, sum(x == t for _, x in norm), d == keep))
    return sorted(out, key=str)


def view(df):
    return sorted([tuple(r)[:4] for r in df.collect()], key=str)


def test_groups(docs, clash):
    assert view(exact_dedup.op6(docs(ROWS))) == expected(ROWS)
    assert view(exact_dedup.op6(clash(docs(ROWS)))) == expected(ROWS)


def test_empty(docs):
    assert exact_dedup.op6(docs([])).count() == 0
    assert exact_dedup.keep_one(docs([])).count() == 0


def test_colliding_hashes_are_chained_by_bytes(docs):
    rows = [(i, f"text {i % 7}") for i in range(60)]
    weak = exact_dedup.groups_of(docs(rows), hash_of=lambda t: F.length(t).cast("bigint"),
                                 digest_of=lambda t: F.lit(b"x"), capacity=2)
    assert sorted((r.doc_id, r.keep_id, r.n) for r in weak.collect()) == [
        (d, k, n) for d, k, n, _ in sorted(expected(rows))]


def test_directory_splits_overfull_buckets(spark):
    """Even hashes, hashes that agree in many leading bits, and one hash alone."""
    rng = random.Random(2)
    hashes = [rng.getrandbits(64) for _ in range(3000)] + [0x7F << 56 | rng.getrandbits(20) for _ in range(500)]
    signed = sorted({h - (1 << 64) if h >> 63 else h for h in hashes})
    keys = spark.createDataFrame([(h,) for h in signed], "h bigint")
    roots, low = exact_dedup.directory(keys, capacity=40)
    got = exact_dedup.routed(keys, roots, low).collect()
    assert sorted(r.h for r in got) == signed
    sizes, least = {}, {}
    for r in got:
        sizes[r.bucket] = sizes.get(r.bucket, 0) + 1
        order = (r.h & (1 << 64) - 1) - (1 << 63)
        assert r.bucket <= order
        least[r.bucket] = max(least.get(r.bucket, order), order)
    assert max(sizes.values()) <= 40
    starts = sorted(least)
    assert all(least[a] < b for a, b in zip(starts, starts[1:]))  # buckets are ranges of hashes
    depths = {b["depth"] for r in roots.collect() for b in r.buckets}
    assert max(depths) > 44 and len(depths) > 2


def test_groups_need_the_directory(docs, monkeypatch):
    """Rows reach their group through the directory only."""
    rows = [(i, f"text {i % 9}") for i in range(40)]
    whole = exact_dedup.directory
    monkeypatch.setattr(exact_dedup, "directory", lambda *a: (whole(*a)[0].limit(0), whole(*a)[1]))
    assert exact_dedup.op6(docs(rows)).count() == 0


def test_rows_without_id_are_compared_too(docs):
    rows = [(None, "a"), (None, "b"), (1, "c"), (2, "a"), (None, "b")]
    weak = exact_dedup.groups_of(docs(rows), hash_of=lambda t: F.lit(5).cast("bigint"), digest_of=lambda t: F.lit(b"x"))
    assert sorted(((r.doc_id, r.keep_id, r.n) for r in weak.collect()), key=str) == sorted(
        ((d, k, n) for d, k, n, _ in expected(rows)), key=str)


def test_keep_one_drops_rows_not_ids(docs, clash):
    rows = [(5, "a"), (5, "b"), (7, "A"), (None, "a"), (None, "lone"), (9, "c"), (9, "c"), (8, "C"), (3, None), (4, "")]
    own = clash(docs(rows))
    for name in ("_gone_id", "_gone_sha", "_text_sha", "bucket", "buckets", "root"):
        own = own.withColumn(name, F.lit("mine"))
    out = exact_dedup.keep_one(own)
    assert out.columns == own.columns and out.filter("_text_sha <> 'mine' OR _gone_id <> 'mine'").count() == 0
    kept = Counter((r.doc_id, r.text) for r in out.collect())
    assert kept == Counter([(5, "b"), (7, "A"), (None, "lone"), (9, "c"), (9, "c"), (4, "")])


def test_keep_one_returns_columns(docs):
    d = docs(ROWS)
    kept = exact_dedup.keep_one(d)
    assert kept.columns == d.columns
    assert {r.doc_id for r in kept.collect()} == {2, 4, 6, 7, 9, 10, None}


def test_table_is_even_and_moves_little():
    names = sharding.shard_names(12)
    a = sharding.lookup_table(names, 4099)
    sizes = Counter(a).values()
    assert max(sizes) - min(sizes) <= 1 and min(a) == 0
    b = sharding.lookup_table(names[:-1], 4099)
    moved = sum(x != y for x, y in zip(a, b) if x != 11)
    assert moved < 0.15 * 4099


def test_table_matches_turn_taking():
    names, size = ["a", "b", "c"], 13
    prefer = {}
    for n in names:
        start, step = sharding._number(n, "offset") % size, sharding._number(n, "skip") % (size - 1) + 1
        prefer[n] = [(start + j * step) % size for j in range(size)]
    owner = {}
    while len(owner) < size:
        for k, n in enumerate(names):
            free = [s for s in prefer[n] if s not in owner]
            if free:
                owner[free[0]] = k
    assert [owner[s] for s in range(size)] == sharding.lookup_table(names, size)


def test_bad_tables():
    for names, size in (([], 13), (["a", "a"], 13), (["a"], 12), (list("abcdef"), 5)):
        with pytest.raises(ValueError):
            sharding.lookup_table(names, size)


def test_placement(docs, clash):
    rows = [(i, "x") for i in range(200)] + [(None, "x"), (7, "y")]
    got = sharding.place(clash(docs(rows)).withColumn("slot", F.lit("old")), "doc_id", sharding.shard_names(8), 1009)
    out = got.select("doc_id", "slot", "shard").collect()
    assert len(out) == 202 and len({r.shard for r in out}) == 8
    assert len({r.slot for r in out if r.doc_id == 7}) == 1
    assert sharding.op5(docs([])).count() == 0
