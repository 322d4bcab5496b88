"""Benchmark windows, near copies and repeated strings against brute force."""

from __future__ import annotations

import random
from pathlib import Path

import numpy as np
import pytest

from pyspark.sql import functions as F

from orderflow.llm import common, decontam, jaccard_join, quality, suffix_dedup
from orderflow.session import scratch_path

WORDS = [f"w{i}" for i in range(60)]


def prose(rng, n, words=WORDS):
    return " ".join(rng.choice(words) for _ in range(n))


# -- benchmark ---------------------------------------------------------------

def bench_rows():
    rng = random.Random(3)
    items = [(i, prose(rng, 25)) for i in range(8)] + [(20, "one"), (21, "two words"), (22, None), (23, " . "),
                                                       (None, "lost id"), (20, "one"), (30, prose(rng, 10))]
    docs = [(0, None), (1, ""), (2, "...!!"), (3, "the One here"), (4, "two  WORDS, two words")]
    for i in range(5, 25):
        item = items[i % 8][1].split()
        at = rng.randrange(0, 12)
        docs.append((i, prose(rng, 30) + ", " + " ".join(item[at:at + rng.randrange(6, 14)]).upper() + ". " + prose(rng, 20)))
    docs.append((25, prose(rng, 3000) + " " + items[2][1]))
    docs.append((25, items[30 % 8][1]))
    return docs, items


@pytest.mark.parametrize("block", [10_000, 30])
def test_windows_match_brute_force(spark, docs, clash, block):
    rows, items = bench_rows()
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    rows = rows[:-1]  # brute force keys by id
    marked = decontam.mark(clash(docs(rows)), bench, block_words=block)
    got = {r.doc_id: (r._words, sum(r._spans[1::2]) - sum(r._spans[::2]), len(r._items)) for r in marked.collect()}
    want = {d: v[:3] for d, v in decontam.brute_force(rows, [i for i in items if i[0] is not None]).items()}
    assert got == want and sum(v[1] > 0 for v in got.values()) > 5


def test_clashing_columns_stay(spark, docs):
    rows, items = bench_rows()
    bench = spark.createDataFrame(items * 50, "item_id bigint, text string")  # repeated rows are one
    own = docs(rows).withColumn("_words", F.lit("mine")).withColumn("_spans", F.lit(1)).withColumn("_items", F.lit(2.5))
    out = decontam.keep_clean(own, bench)
    assert out.columns == own.columns and 0 < out.count() < len(rows)
    assert out.filter("_words <> 'mine' OR _spans <> 1 OR _items <> 2.5").count() == 0
    marked = decontam.mark(own, bench)
    assert marked.columns[-3:] == ["_words", "_spans", "_items"] and dict(marked.dtypes)["_words"] == "bigint"
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(26)], "doc_id bigint, quality int, toxic int")
    own = own.withColumn("_quality_score", F.lit("mine"))
    good = quality.keep_good(own, labels)
    assert good.columns == own.columns and good.filter("_quality_score <> 'mine'").count() == 0


def test_windows_on_empty_tables(spark, docs):
    bench = spark.createDataFrame([], "item_id bigint, text string")
    assert [r.contaminated for r in decontam.op9(docs([(1, "a b")]), bench).collect()] == [False]
    assert decontam.op9(docs([]), bench).count() == 0
    assert decontam.keep_clean(docs([(1, "a b")]), bench).count() == 1


# -- near copies ---------------------------------------------------------------

def near_brute(rows, width, percent):
    sets = {}
    for d, t in rows:
        w = jaccard_join.words_of(t)
        k = min(width, len(w))
        sets.setdefault(d, []).append({tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if w else set())
    ids = sorted(sets)
    top = {d: d for d in ids}

    def root(x):
        while top[x] != x:
            x = top[x]
        return x
    for a in ids:
        for b in ids:
            if a < b and any(x and y and 100 * len(x & y) >= percent * len(x | y) for x in sets[a] for y in sets[b]):
                ra, rb = root(a), root(b)
                top[max(ra, rb)] = min(ra, rb)
    return {d: root(d) for d in ids}


def near_rows(seed, n=40):
    rng = random.Random(seed)
    big = [f"v{i}" for i in range(4000)]
    rows = []
    for g in range(n):
        base = prose(rng, rng.choice([2, 5, 8, 25, 60, 200]), big if g % 3 else WORDS).split()
        for _ in range(rng.choice([1, 2, 4])):
            w = list(base)
            for _ in range(int(len(w) * rng.choice([0, 0.01, 0.02, 0.05]))):
                w[rng.randrange(len(w))] = rng.choice(big)
            rows.append((len(rows), " ".join(w).title() if rng.random() < .3 else " ".join(w)))
    return rows + [(len(rows) + i, t) for i, t in enumerate([None, "", " \t", "one", "ONE", "a b", "a b c"])]


@pytest.mark.parametrize("width,percent", [(3, 90), (5, 80)])
def test_near_classes_match_brute_force(docs, clash, width, percent):
    rows = near_rows(width)
    got = {r.doc_id: r.component_id for r in jaccard_join.classes(clash(docs(rows)), width, percent).collect()}
    assert got == near_brute(rows, width, percent)


def test_word_hashes_are_those_of_the_words():
    rng = random.Random(8)
    odd = ["", "  ", "a", "one two", "Ünï  x\x0by\x1cz\x00 q", "w" * 300 + " x " + "w" * 300 + " " + "w" * 301,
           "a" * 8 + " " + "a" * 9 + " " + "a" * 7 + " A", None, "\x00 \x00\x00", "é" * 5]
    texts = odd + ["".join(rng.choice("ab \x00\n") for _ in range(200)) for _ in range(50)]
    known: dict = {}
    for blobs in common.text_groups(texts, 500):
        hashes, edges = common.hashed_words(blobs)
        assert len(edges) == len(blobs) + 1 and edges[0] == 0 and edges[-1] == len(hashes)
        for k, blob in enumerate(blobs):
            words = blob.split()
            assert len(words) == edges[k + 1] - edges[k]
            for w, h in zip(words, hashes[edges[k]:edges[k + 1]]):
                assert known.setdefault(w, int(h)) == int(h)
    assert len(set(known.values())) == len(known) > 100
    for t in texts:
        words = jaccard_join.words_of(t)
        n = min(3, len(words))
        want = {tuple(words[i:i + n]) for i in range(len(words) - n + 1)} if words else set()
        assert len(jaccard_join.token_set(t, 3)) == len(want)


def test_crowded_groups_send_a_forest(docs, monkeypatch):
    """Links that leave a block join trees: fewer than its nodes, not all pairs."""
    monkeypatch.setattr(jaccard_join, "HOT_ENTRY", 4)
    monkeypatch.setattr(jaccard_join, "STAR_ROUNDS", 0)
    seen = []
    whole = jaccard_join.hot_links

    def counted(*args):
        out = common.stored(whole(*args), "test-hot")
        seen.append(out.count())
        return out

    monkeypatch.setattr(jaccard_join, "hot_links", counted)
    rng = random.Random(5)
    base = [f"b{i}" for i in range(150)]
    rows = []
    for i in range(90):
        w = list(base)
        w[rng.randrange(len(w))] = f"x{i}"
        rows.append((i, " ".join(w)))
    got = {r.doc_id: r.component_id for r in jaccard_join.classes(docs(rows), 3, 90).collect()}
    assert set(got.values()) == {0} and len(got) == 90
    assert seen and max(seen) < 90, seen


def test_crowded_entries(docs, monkeypatch):
    """A large group of near copies, with the hot path and frequent tokens forced."""
    monkeypatch.setattr(jaccard_join, "HOT_ENTRY", 4)
    monkeypatch.setattr(jaccard_join, "BLOCK_NODES", 7)
    monkeypatch.setattr(jaccard_join, "FREQUENT", 6)
    rng = random.Random(5)
    base = [f"b{i}" for i in range(120)]
    rows = []
    for i in range(40):
        w = list(base)
        for _ in range(rng.choice([1, 2, 3, 4])):
            w[rng.randrange(len(w))] = f"x{rng.randrange(10 ** 6)}"
        rows.append((i, " ".join(w)))
    got = {r.doc_id: r.component_id for r in jaccard_join.classes(docs(rows), 3, 90).collect()}
    assert got == near_brute(rows, 3, 90)


def test_index_entries_keep_their_promise():
    """Similar sets share at least the promised number of entries."""
    rng = np.random.default_rng(2)
    for percent in (80, 90):
        for n in (1, 2, 3, 5, 12, 20, 24, 40, 150, 700):
            for share in (0, 0.5, 1):
                bitmap = rng.random(1 << 20) < share
                for _ in range(20):
                    x = np.unique(rng.integers(0, 2 ** 63, n).astype(np.uint64))
                    lose = rng.integers(0, jaccard_join.missing(n, percent) + 1)
                    y = rng.permutation(x)[lose:]
                    y = np.unique(np.concatenate([y, rng.integers(0, 2 ** 63, lose // 4).astype(np.uint64)]))
                    same = len(np.intersect1d(x, y))
                    if 100 * same < percent * (len(x) + len(y) - same):
                        continue
                    a, b = (jaccard_join.index_entries(s, bitmap, percent) for s in (x, y))
                    need = min(jaccard_join.common_entries(len(s), percent) for s in (x, y))
                    assert len(np.intersect1d(a, b)) >= need, (percent, n, share, lose)


def test_near_ties_nulls_and_empty(docs):
    rows = [(5, "a b c d"), (3, "A B C D"), (3, "A B C D"), (None, "a b c d"), (9, None), (8, "")]
    got = sorted((str(r.doc_id), str(r.component_id), r.n_shingles) for r in jaccard_join.op7(docs(rows)).collect())
    assert got == sorted([("5", "3", 2), ("3", "3", 2), ("3", "3", 2), ("None", "None", 2), ("9", "9", 0), ("8", "8", 0)])
    assert jaccard_join.op7(docs([])).count() == 0
    assert {r.doc_id for r in jaccard_join.keep_one(docs(rows)).collect()} == {3, 9, 8, None}


def test_large_sides_stay_out_of_the_driver(docs, monkeypatch):
    """Beyond the bound neither the wanted nodes nor the copies nor the classes are broadcast."""
    for module in (common, jaccard_join):
        monkeypatch.setattr(module, "DRIVER_BYTES", 0, raising=False)
    plans = []
    whole = common.stored

    def watched(df, tag, *args):
        plans.append((tag, df._jdf.queryExecution().optimizedPlan().toString()))
        return whole(df, tag, *args)

    monkeypatch.setattr(common, "stored", watched)
    monkeypatch.setattr(jaccard_join, "stored", watched)
    rows = near_rows(4, 12) + [(1000 + i, "the same few words are here " * 9) for i in range(4)]
    got = {r.doc_id: r.component_id for r in jaccard_join.classes(docs(rows), 3, 90).collect()}
    assert got == near_brute(rows, 3, 90)
    seen = {tag for tag, plan in plans if "strategy=broadcast" in plan}
    assert "node-texts" in {tag for tag, _ in plans} and not seen & {"postings", "node-texts", "pairs", "links"}, seen
    final = [plan for tag, plan in plans if tag == "near-classes"]
    assert [plan.count("strategy=broadcast") for plan in final] == [1]  # the few largest groups


# -- repeated strings ---------------------------------------------------------

def test_sorter_orders_all_suffixes():
    rng = np.random.default_rng(1)
    for limit in (1 << 20, 40):  # with and without files
        for top in (2, 4, 200):
            t = bytes(rng.integers(0, top, 400).astype(np.uint8)) + b"\0\1" + b"\0" * suffix_dedup.SORT_DEPTH
            got = np.concatenate(list(suffix_dedup.sorted_suffixes(np.frombuffer(t, np.uint8), limit)))
            keys = [t[i:i + 56].ljust(56, b"\0") for i in got]
            assert sorted(got.tolist()) == list(range(402)) and keys == sorted(keys)


def test_strings_match_brute_force(docs, clash, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "PACK_DOCS", 4)
    rng = random.Random(9)
    line = "all rights reserved by the people who wrote this down once " * 2
    rows = [(0, None), (1, ""), (2, "short"), (3, "short"), (4, line), (6, line), (5, "x" + line), (7, "ab" * 300),
            (8, "ba" * 200), (9, "\0" * 120), (10, "\0" * 90 + "é" * 60)]
    for i in range(11, 30):
        rows.append((i, prose(rng, 20) + line[rng.randrange(40):rng.randrange(60, 118)] + prose(rng, 300)))
    rows.append((30, rows[20][1] + rows[21][1] + prose(rng, 4000)))
    got = {r.doc_id: tuple(r)[1:] for r in suffix_dedup.op3(clash(docs(rows))).collect()}
    assert got == suffix_dedup.brute_force(rows)


def test_substring_dedup_frees_its_steps(spark, docs, monkeypatch):
    """Keys and segments are gone when the result is there to be read."""
    made = []
    monkeypatch.setattr(common, "scratch_path", lambda spark, tag: made.append(
        (tag, scratch_path(spark, tag))) or made[-1][1])
    text = "a passage that two documents share, of well over fifty bytes in all"
    rows = [(k, f"{k} begins {text} and ends {k}") for k in range(8)]
    got = {r.doc_id: tuple(r)[1:] for r in suffix_dedup.op3(docs(rows)).collect()}
    assert got == suffix_dedup.brute_force(rows)
    left = {tag: Path(path.removeprefix("file:")).exists() for tag, path in made}
    assert left["llm-text-packs"] and left["llm-removed-windows"]
    assert not left["llm-shared-keys"] and not left["llm-segments"]


def test_hot_keys_are_split(spark, docs, monkeypatch):
    """A phrase in every document: no key may bring more than the bound to a shard."""
    for name, value in (("PACK_DOCS", 4), ("HOT_BYTES", 600), ("HOT_ROW_BYTES", 200), ("BLOCK_BYTES", 500)):
        monkeypatch.setattr(suffix_dedup, name, value, raising=False)
    rng = random.Random(4)
    other = prose(rng, 40)
    rows = [(i, prose(rng, 12) + " by the same phrase in all of them " + prose(rng, 12)
             + (other[rng.randrange(20):] if i % 3 == 0 else "")) for i in range(80)]
    packs = suffix_dedup.packs_of(docs(rows))
    segments = suffix_dedup.segments_of(packs, suffix_dedup.shared_keys(packs, 4), 4).filter("shard >= 0").collect()
    held: dict = {}
    for r in segments:
        at, raw = 0, suffix_dedup._expand(r.bytes)
        for size in np.frombuffer(suffix_dedup._expand(r.sizes), "<i8"):
            key = int(suffix_dedup.window_keys(raw[at:at + suffix_dedup.WINDOW])[0])
            held[key] = held.get(key, 0) + int(size)
            at += size
    assert held and max(held.values()) <= 600
    got = {r.doc_id: tuple(r)[1:] for r in suffix_dedup.op3(docs(rows)).collect()}
    assert got == suffix_dedup.brute_force(rows) and sum(v[1] > 0 for v in got.values()) > 20


def test_large_shards_are_sorted_in_blocks_of_keys(docs, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "PACK_DOCS", 4)
    rng = random.Random(6)
    rows = [(i, prose(rng, 200)) for i in range(12)]
    rows += [(12 + i, prose(rng, 3) + rows[i % 12][1]) for i in range(24)]
    packs = suffix_dedup.packs_of(docs(rows))
    segments = suffix_dedup.segments_of(packs, suffix_dedup.shared_keys(packs, 1), 1).filter("shard >= 0").collect()
    whole = suffix_dedup.Shard(2000)
    for r in segments:
        whole.add(r.asDict())
    blocks = list(whole.blocks())
    keys = [{int(suffix_dedup.window_keys(s[:50])[0]) for s in b[3]} for b in blocks]
    assert len(blocks) > 5 and sum(map(len, keys)) == len(set().union(*keys))
    assert sum(len(s) for b in blocks for s in b[3]) == whole.held
    assert max(sum(len(s) for s in b[3]) for b in blocks) < whole.held / 2


def test_packs_and_shards_are_large(spark, docs):
    """Rows between steps grow with packs times shards: packs fill up over Arrow batches, shards are not small."""
    rng = random.Random(7)
    rows = [(i, prose(rng, 40)) for i in range(60)]
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "5")
    try:
        packs = suffix_dedup.packs_of(docs(rows).coalesce(1)).collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert len(packs) == 1
    ids, raw = suffix_dedup._unpack(packs[0].ids, packs[0].sizes, packs[0].texts)
    assert sorted(zip(ids.tolist(), raw)) == [(i, t.encode()) for i, t in rows]
    total = 10 << 30
    assert suffix_dedup.shards_for(total, 600) == suffix_dedup.shards_for(total, 12) < 600
    assert suffix_dedup.shards_for(0, 12) == 12 and suffix_dedup.shards_for(3 * total, 12) > 600


def test_runs_of_a_pack_are_those_of_its_texts(monkeypatch):
    rng = random.Random(11)
    raw = [prose(rng, rng.choice([0, 1, 12, 60, 300])).encode() for _ in range(60)] + [b"", b"a" * 49, b"a" * 50, b"ab" * 90, b""]
    for most in (1, 300, 1 << 20):
        monkeypatch.setattr(suffix_dedup, "GROUP_BYTES", most)
        got = {}
        for key, doc, first, count in zip(*(x.tolist() for x in suffix_dedup.pack_runs(raw))):
            for w in range(first, first + count):
                assert got.setdefault((doc, w), key) == key
        want = {(d, w): int(k) for d, t in enumerate(raw) for w, k in enumerate(suffix_dedup.window_keys(t))}
        assert got == want


def test_segments_that_share_a_window_are_sorted():
    """The filter before the sort keeps all of them and drops those that share the key only."""
    rng = random.Random(12)
    segs = []
    for _ in range(60):
        gram = "".join(rng.choice("abcd") for _ in range(rng.choice([16, 20, 30, 45])))
        for _ in range(rng.choice([1, 3])):
            text = ("".join(rng.choice("abcdefgh") for _ in range(60)) + gram + "".join(rng.choice("abcdefgh") for _ in range(60))).encode()
            for text in (text, b"x" * 3 + text[20:100] + b"y" * 30, b"ab" * rng.choice([30, 45])):
                _, _, first, count = suffix_dedup.pack_runs([text])
                segs += [text[a:a + c + 49] for a, c in zip(first.tolist(), count.tolist())]
    segs = sorted(set(segs))
    size = np.array([len(s) for s in segs])
    text, start = b"".join(segs), np.cumsum(size) - size
    kept = suffix_dedup.may_share(text, start, size)
    homes: dict = {}
    for k, s in enumerate(segs):
        for w in range(len(s) - 49):
            homes.setdefault(s[w:w + 50], set()).add(k)
    sharing = set().union(*(h for h in homes.values() if len(h) > 1))
    assert sharing and sharing <= set(np.flatnonzero(kept).tolist()) and kept.sum() < len(segs)
    number = suffix_dedup.equal_strings(text + text, np.concatenate([start, start + len(text)]), np.tile(size, 2))
    assert (number[:len(segs)] == number[len(segs):]).all() and len(set(number.tolist())) == len(segs)


def test_strings_without_ids_and_empty(docs):
    t = "the same words again and again until there are more than fifty of them"
    got = sorted((str(r.doc_id), r.n_removed) for r in suffix_dedup.op3(docs(
        [(None, t), (4, t), (4, t), (9, t), (2, "tiny"), (3, "tiny")])).collect())
    assert got == [("2", 0), ("3", 0), ("4", 0), ("4", 0), ("9", len(t)), ("None", 0)]
    assert suffix_dedup.op3(docs([])).count() == 0
