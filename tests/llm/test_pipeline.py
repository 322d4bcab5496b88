"""The five stages together, against plain Python over all pairs and texts."""

from __future__ import annotations

import random
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from orderflow.llm import decontam, quality
from orderflow.llm.queries import vocabulary
from orderflow.session import scratch_path

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def folder(spark):
    """The smallest tables with planted copies, near copies, benchmark
    passages, bad texts, NULL and empty ones."""
    root = scratch_path(spark, "test-pipeline")
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    base = [r for r in docs.orderBy("doc_id").collect()]
    items = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").orderBy("item_id").collect()]
    rng = random.Random(3)
    long_ = [r for r in base if len((r.text or "").split()) > 120][:12]
    rows, at = [tuple(r) for r in base], max(r.doc_id for r in base) + 1
    for k, r in enumerate(long_):
        words = r.text.split()
        near = list(words)
        near[len(near) // 2] = "changed"
        passage = " ".join(words[:60]) + " " + items[k % len(items)] + " " + " ".join(words[60:])
        for text in (r.text.upper() if k % 2 else r.text, " ".join(near), passage, None if k % 3 else "", "!!! " * 30,
                     " ".join(rng.sample(words, len(words)))):
            rows.append((at, text, r.lang, r.source, len(text or "")))
            at += 1
    spark.createDataFrame(rows, docs.schema).repartition(3).write.parquet(f"{root}/documents.parquet")
    for name in ("labels", "benchmark"):
        spark.read.parquet(f"{SF}/{name}.parquet").write.parquet(f"{root}/{name}.parquet")
    return root


def plain(spark, folder):
    """(doc_id, text) after the four filtering stages, by brute force."""
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    good = {r.doc_id for r in quality.op10(docs, labels).filter(F.col("score") >= quality.THRESHOLD).collect()}
    left = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect() if r.doc_id in good}
    lower = {d: "".join(c.lower() if c.isascii() else c for c in t or "") for d, t in left.items()}
    best: dict = {}
    for d, t in lower.items():
        best[t] = max(d, best.get(t, d))
    left = {d: t for d, t in left.items() if best[lower[d]] == d}
    sets = {}
    for d in left:
        w = lower[d].encode().split()
        k = min(5, len(w))
        sets[d] = {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if w else set()
    root = {d: d for d in left}

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in combinations(sorted(left), 2):
        x, y = sets[a], sets[b]
        if x and y and 100 * min(len(x), len(y)) >= 80 * max(len(x), len(y)):
            if 100 * len(x & y) >= 80 * len(x | y):
                root[max(top(a), top(b))] = min(top(a), top(b))
    left = {d: t for d, t in left.items() if top(d) == d}
    bench = [tuple(r) for r in spark.read.parquet(f"{folder}/benchmark.parquet").select("item_id", "text").collect()]
    hits = decontam.brute_force(list(left.items()), bench)
    return {d: t for d, t in left.items() if not hits[d][1]}


def test_stages_equal_brute_force(spark, folder):
    from tokenizers import Tokenizer

    want = plain(spark, folder)
    every = spark.read.parquet(f"{folder}/documents.parquet").count()
    assert 50 < len(want) < every - 30
    got = corpus_pipeline.run(spark, folder).collect()
    assert {r.doc_id for r in got} == set(want)
    fresh = Tokenizer.from_file(vocabulary("word_bpe_49k.json"))
    ids = {d: np.array(fresh.encode(t or "", add_special_tokens=False).ids + [1], "<u4") for d, t in want.items()}
    sequences: dict = {}
    for r in got:
        assert (r.start, r.length) == (4096 * r.piece, min(4096, len(ids[r.doc_id]) - 4096 * r.piece))
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert sum(r.length for r in got) == sum(map(len, ids.values()))
    for parts in sequences.values():
        ends = np.cumsum([n for _, n in sorted(parts)])
        assert [o for o, _ in sorted(parts)] == [0, *ends[:-1]] and ends[-1] <= 4096
    assert len(sequences) <= 1.02 * sum(map(len, ids.values())) / 4096 + 1


def test_stages_pass_documents_on(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "exact_dedup", "near_dedup", "decontamination", "packing"]
    for _, stage in corpus_pipeline.STAGES[:2]:
        out = stage(spark, docs.withColumn("_c0", F.lit(1)), folder)
        assert out.columns == [*docs.columns, "_c0"] and 0 < out.count() < docs.count()
