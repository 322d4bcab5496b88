"""Filter audit, hard negatives and the embedding graph, against brute force."""

from __future__ import annotations

from itertools import permutations

import numpy as np
import pytest
from pyspark.sql import functions as F

from orderflow.llm import embedding_dedup, filter_audit, hard_negatives

LABELS = "doc_id bigint, quality int, toxic int"
VECTORS = "vec_id bigint, embedding array<float>, label int"


# -- filter audit ---------------------------------------------------------------

def audited(rows, labels):
    """Every order applied to every document, one after the other."""
    good = {d for d, q, _ in labels if q == 1}
    toxic = {d for d, _, t in labels if t == 1}
    fails = []
    for d, text, part in rows:
        t = text or ""
        words = t.encode().split()
        same = [i for i, x, _ in rows if (x or "") == t and i is not None]
        f = set()
        if len(words) < 100:
            f.add("A")
        if 100 * len(set(words)) < 80 * len(words):
            f.add("B")
        if 100 * sum("A" <= c <= "Z" for c in t) > 10 * len(t):
            f.add("C")
        if set(t) & set("#$%&*|"):
            f.add("D")
        if d is not None and min(same) < d:
            f.add("E")
        fails.append((part or "", f, d in good, d in toxic))
    out = {}
    for part in {p for p, *_ in fails}:
        own = [x for x in fails if x[0] == part]
        removed = {}
        for order in permutations("ABCDE"):
            left = own
            for step, c in enumerate(order, 1):
                gone = [x for x in left if c in x[1]]
                left = [x for x in left if c not in x[1]]
                removed["".join(order), step] = (c, len(gone))
                out[part, "".join(order), step] = [
                    len(left), len(gone), sum(c in x[1] for x in own) - len(gone), sum(x[1] == {c} for x in own),
                    sum(x[2] for x in gone), sum(x[3] for x in gone)]
        for (order, step), (c, _) in removed.items():
            out[part, order, step].append(sum(n for x, n in removed.values() if x == c))
    return out


MANY = " ".join(f"word{i}" for i in range(120))
AUDIT_ROWS = [
    (1, MANY, "en"), (2, MANY, "en"), (3, MANY, "de"), (3, MANY, "de"), (None, MANY, "en"), (4, MANY + " #", "en"),
    (5, "short", None), (6, "SHORT", ""), (7, None, "fr"), (8, "", "fr"), (9, "a b " * 200, "en"),
    (10, ("ÀÉ" * 40 + "X") * 3, "en"), (11, "ABCDE fghij | k", "de"), (12, "word\x1cone\x0btwo three", "de"),
    (13, "Long " * 50_000, "en"), (14, "Long " * 50_000, None), (9, "a b " * 200, "en"), (15, MANY.upper() + " $", "en")]
AUDIT_LABELS = [(1, 1, 0), (2, 0, 1), (2, 1, 0), (5, 1, 1), (9, 1, 1), (15, None, 1), (None, 1, 1), (99, 1, 1)]


def test_audit_equals_plain_application(spark, docs, clash):
    labels = spark.createDataFrame(AUDIT_LABELS, LABELS)
    want = audited(AUDIT_ROWS, AUDIT_LABELS)
    for d in (docs(AUDIT_ROWS), clash(docs(AUDIT_ROWS)).withColumn("part", F.lit(1)).withColumn("mask", F.lit(1))):
        got = {(r.part, r.filter_order, r.step): list(r)[3:] for r in filter_audit.op12(d, labels).collect()}
        assert got == want


def test_audit_of_nothing(spark, docs):
    labels = spark.createDataFrame([], LABELS)
    assert filter_audit.op12(docs([]), labels).count() == 0
    assert filter_audit.op12(docs([(1, None)]), labels).count() == 600


def test_gray_walk_states_are_sums_of_unhit_cells():
    counts = np.random.default_rng(1).integers(0, 50, (3, 16, 2))
    states = filter_audit.survivors(counts, 4)
    for subset in range(16):
        left = [m for m in range(16) if not m & subset]
        assert (states[:, subset] == counts[:, left].sum(axis=1)).all()


# -- hard negatives ---------------------------------------------------------------

def mined(rows):
    own = []
    for i, x, label in rows:
        if i is None or label is None or x is None or any(c is None or not np.isfinite(c) for c in x):
            continue
        own.append((i, (label + 1) % 10 if i % 7 == 0 else label, [int(np.floor(256 * float(np.float32(c)))) for c in x]))
    out = []
    for i, label, z in own:
        if i % 100:
            continue
        def score(y):
            return sum(a * b for a, b in zip(z, y))
        same = sorted((-score(y), j) for j, other, y in own if other == label and j != i)[:5]
        for s, j in same:
            hard = sorted((-score(y), k) for k, other, y in own
                          if other != label and 30 * -s <= 100 * score(y) <= 90 * -s)[:10]
            out += [(i, j, r, k, -s, -t) for r, (t, k) in enumerate(hard, 1)]
    return sorted(out)


def planted_vectors(n, dim, seed, groups=6):
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(groups, dim))
    x = base[rng.integers(0, groups, n)] + rng.normal(size=(n, dim)) * rng.choice([0.02, 0.5, 1.5], (n, 1))
    return x * rng.choice([0.1, 1, 3], (n, 1))


@pytest.mark.parametrize("seed", [0, 1])
def test_hard_negatives_equal_brute_force(spark, seed, monkeypatch):
    x = np.round(planted_vectors(700, 6, seed), 2)  # coarse: many ties
    rng = np.random.default_rng(seed)
    ids = rng.permutation(1500)[:700] * 10
    rows = [(int(i), [float(c) for c in v], int(label)) for i, v, label in zip(ids, x, rng.integers(0, 4, 700))]
    rows += [(None, [1.0] * 6, 1), (100, None, 1), (200, [1.0] * 6, None), (300, [float("nan")] + [1.0] * 5, 2),
             (400, [None] + [1.0] * 5, 2), (500, [0.0] * 6, 1), (600, [], 2), (700, [2.0, 1.0], 3),
             (900, [3e4] * 6, 1), (1000, [2e4] * 6, 1), (1100, [2.5e4] * 5 + [1.0], 2)]
    rows += [rows[5], rows[6], (800, [1.0] * 6, 1), (800, [1.0] * 6, 1)]
    monkeypatch.setattr(hard_negatives, "CHUNK_BYTES", 2_000)
    monkeypatch.setattr(hard_negatives, "STRIDE", 16)
    df = spark.createDataFrame(rows, VECTORS).withColumn("score", F.lit("x")).withColumn("key", F.lit(1)).repartition(3)
    got = sorted(tuple(r) for r in hard_negatives.op13(df).collect())
    want = mined(rows)
    assert len(want) > 100 and got == want


def test_walks_end_early(spark):
    """On clustered vectors a walk scores a part of the list only."""
    x = planted_vectors(4000, 8, 3, groups=40)
    z = np.floor(256 * x)
    label = np.arange(4000) % 5
    anchors = hard_negatives.Anchors(np.arange(40), np.arange(40), label[:40], z[:40])
    scored = 0
    whole = hard_negatives.products

    def counted(a, b, exact):
        nonlocal scored
        scored += len(a) * len(b)
        return whole(a, b, exact)

    import pyarrow as pa
    batch = pa.record_batch({"vec_id": pa.array(np.arange(4000)), "label": pa.array(label),
                             "z": pa.array(z.astype(np.int64).tolist(), pa.list_(pa.int64()))})
    hard_negatives.products = counted
    try:
        hard_negatives.walk_positives(anchors, [batch], 8, 5)
    finally:
        hard_negatives.products = whole
    assert scored < 0.6 * 40 * 4000, scored


def test_hard_negatives_of_nothing(spark):
    assert hard_negatives.op13(spark.createDataFrame([], VECTORS)).count() == 0
    assert hard_negatives.op13(spark.createDataFrame([(100, [1.0], 1)], VECTORS)).count() == 0


# -- embedding graph ---------------------------------------------------------------

def linked(rows):
    """(vec_id, n_links, component_id, kept) by brute force."""
    dim = max((len(x) for _, x in rows if x), default=0)
    good, v = [], []
    for k, (i, x) in enumerate(rows):
        if i is not None and x and all(c is not None and np.isfinite(c) for c in x) and any(x):
            good.append(k)
            y = np.zeros(dim)
            y[:len(x)] = np.array(x, np.float32)
            v.append(y / np.linalg.norm(y))
    near = np.zeros((len(rows), len(rows)), bool)
    if good:
        v = np.array(v)
        near[np.ix_(good, good)] = v @ v.T >= 0.95
    np.fill_diagonal(near, False)
    component = [r[0] for r in rows]
    done = [False] * len(rows)
    for k in range(len(rows)):
        if done[k] or not near[k].any():
            continue
        group, edge = {k}, [k]
        while edge:
            edge = [j for j in np.flatnonzero(near[edge].any(axis=0)) if j not in group]
            group |= set(edge)
        for j in group:
            done[j], component[j] = True, min(rows[g][0] for g in group)
    return sorted(((i, int(near[k].sum()), component[k], i == component[k]) for k, (i, _) in enumerate(rows)), key=str)


def copies_of(rng, base, n, spread):
    return base + rng.normal(size=(n, len(base))) * spread / np.sqrt(len(base))


def embedding_rows(seed, n=1500, dim=24):
    rng = np.random.default_rng(seed)
    x = [rng.normal(size=(n, dim))]
    for base in x[0][:25]:
        x.append(copies_of(rng, base, int(rng.integers(1, 12)), rng.choice([0.2, 0.8])))
    x.append(copies_of(rng, x[0][30], 700, 0.3))  # one dense group
    x = np.concatenate(x)
    x = x[rng.permutation(len(x))] * rng.choice([0.01, 1, 500], (len(x), 1))
    return [(int(i), [float(c) for c in v]) for i, v in zip(rng.permutation(9 * len(x)), x)]


ODD_VECTORS = [(None, [1.0] * 24), (-5, None), (-6, []), (-7, [0.0] * 24), (-8, [float("inf")] * 24), (-9, [None] * 24),
               (-10, [1.0]), (-11, [2.0, 0.0]), (-12, [0.5, 0.25]), (-13, [3.0] * 24), (-14, [1e-30] * 24),
               (-14, [2.0] * 24), (-15, [-2.0] * 24)]


def seen(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_graph_dedup_equals_brute_force_in_one_shard(spark):
    rows = embedding_rows(0, 400) + ODD_VECTORS
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").withColumn(
        "node", F.lit("x")).withColumn("key", F.lit("x")).withColumn("cell", F.lit("x")).repartition(3)
    assert seen(embedding_dedup.op11(df)) == linked(rows)


def test_graph_dedup_over_split_shards(spark, monkeypatch):
    """Small shards, split twice; overlap and union keep the recall."""
    monkeypatch.setattr(embedding_dedup, "SHARD", 150)
    monkeypatch.setattr(embedding_dedup, "CHILDREN", 6)
    monkeypatch.setattr(embedding_dedup, "PLACED", 200)
    monkeypatch.setattr(embedding_dedup.split_large, "__defaults__", (300, 150))
    rows = embedding_rows(2) + ODD_VECTORS
    got = seen(embedding_dedup.op11(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")))
    want = linked([(i, x) for i, x in rows])
    assert [r[0] for r in got] == [r[0] for r in want]
    assert all(g[1] <= w[1] for g, w in zip(got, want))
    assert sum(g[1] for g in got) >= 0.98 * sum(w[1] for w in want), sum(g[1] for g in got) / sum(w[1] for w in want)
    assert sum(g[2] == w[2] for g, w in zip(got, want)) >= 0.95 * len(want)


def test_shards_are_bounded_and_overlap(spark):
    rng = np.random.default_rng(4)
    x = np.concatenate([rng.normal(size=(600, 8)), copies_of(rng, rng.normal(size=8), 900, 0.05)])
    nodes = spark.createDataFrame([(k, str(k).encode(), [float(c) for c in v], 1, k) for k, v in enumerate(x)],
                                  "node bigint, key binary, vec array<double>, copies bigint, least bigint")
    members = embedding_dedup.split_large(
        embedding_dedup.first_shards(nodes, 8, 100_000, 2), 8, largest=200, share=100)
    sizes = [r["count"] for r in members.groupBy("cell").count().collect()]
    assert max(sizes) <= 200 and sum(sizes) == 2 * len(x)
    assert members.groupBy("node").agg(F.countDistinct("cell").alias("n")).filter("n <> 2").count() == 0


def test_robust_prune_keeps_near_and_spread():
    v = np.array([[1, 0], [0.99, 0.14], [0.98, 0.2], [0, 1], [-1, 0]], np.float32)
    v /= np.linalg.norm(v, axis=1)[:, None]
    kept = embedding_dedup.robust_prune(v, np.array([0]), np.array([[4, 3, 2, 1, 0, -1]]))[0]
    assert [k for k in kept if k >= 0] == [1, 3]  # 1 is much nearer to 2, and 3 to 4, than the owner is
    kept = embedding_dedup.robust_prune(v, np.array([3]), np.array([[0, 4]]))[0]
    assert [k for k in kept if k >= 0] == [0, 4]


def test_audit_measures_missing_links(spark):
    rng = np.random.default_rng(6)
    base = rng.normal(size=(40, 16))
    x = np.repeat(base, 3, axis=0) + rng.normal(size=(120, 16)) * 0.01
    nodes = spark.createDataFrame([(k, str(k).encode(), [float(c) for c in v], 1, k) for k, v in enumerate(x)],
                                  "node bigint, key binary, vec array<double>, copies bigint, least bigint")
    for found, want in ((2, 1.0), (1, 0.5), (0, 0.0)):
        links = nodes.select("node", F.lit(found).cast("bigint").alias("links"))
        assert abs(embedding_dedup.audit(nodes, links, 16, 0.95) - want) < 1e-9


def test_graph_dedup_of_nothing(spark):
    empty = spark.createDataFrame([], VECTORS)
    assert embedding_dedup.op11(empty).count() == 0
    assert seen(embedding_dedup.op11(spark.createDataFrame([(3, None, 1)], VECTORS))) == [(3, 0, 3, True)]
