"""Classifiers, token files, packing, WARC archives and the entry point."""

from __future__ import annotations

import base64
import hashlib
import random
import re
import sys
import unicodedata
import zlib
from itertools import product

import numpy as np
import pytest
from pyspark.sql import functions as F

from orderflow.llm import common, language, packing, quality, token_files, warc
from orderflow.llm.queries import ORACLE, QUERIES, vocabulary
from orderflow.llm.tokens import ENDS, Encoder
from orderflow.session import checkpoint_root, scratch_path

SF = "/root/testdata/sf0.001"
ODD = ["", " ", "a  b", "a\n\nb", "\n", " x ", "it's  DON'T\tstop\r\n", "<|endoftext|> x<|endoftext|>", "École ΑΣ ΣΑΣ.",
       "日本語 123 4５6", "á b ́x", "\x85a\x1cb\xa0c", "😀👍🏽", "word,\nNext. end!!", "\x00\x01", "ß ẞ ǅ", "a" * 300]


# -- quality -----------------------------------------------------------------

def test_quality_on_held_out_rows(spark):
    rows = quality.op10(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"),
                        spark.read.parquet("/root/testdata/sf0.01/labels.parquet"))
    gold = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").select("doc_id", "quality")
    got = rows.join(gold, "doc_id").filter("held_out").collect()
    assert len(got) > 50
    assert sum(r.predicted == r.quality for r in got) / len(got) > 0.95
    assert all(0 <= r.score <= 1 for r in got)


def test_quality_score_is_the_gaussian_posterior():
    rng = np.random.default_rng(0)
    a, b = rng.normal(0, 1, (400, 3)), rng.normal(1, 2, (300, 3))
    model = quality.Discriminant(np.array([.4, .6]), np.zeros(3), np.ones(3))
    covs = [np.cov(x.T) for x in (a, b)]
    for x, c in zip((a, b), covs):
        model.means.append(x.mean(axis=0))
        model.factors.append(np.linalg.inv(np.linalg.cholesky(c)))
        model.log_det.append(np.linalg.slogdet(c)[1])
    x = rng.normal(0.5, 1.5, (20, 3))
    dens = [p * np.exp(-.5 * np.einsum("ij,jk,ik->i", x - m, np.linalg.inv(c), x - m)) / np.sqrt(np.linalg.det(c))
            for p, m, c in zip(model.prior, model.means, covs)]
    assert np.allclose(model.score(x), dens[1] / (dens[0] + dens[1]))


def test_quality_cases(spark, docs, clash):
    labels = spark.createDataFrame([(1, 1, 0), (1, 0, 0), (None, 1, 0), (2, None, 0)],
                                   "doc_id bigint, quality int, toxic int")
    d = clash(docs([(1, None), (2, ""), (3, "x " * 50_000), (3, "!!"), (None, "a")]))
    got = quality.op10(d, labels).collect()
    assert len(got) == 5 and all(0 <= r.score <= 1 for r in got)
    assert quality.keep_good(d, labels).columns == d.columns
    assert quality.op10(docs([]), labels).count() == 0


# -- language -----------------------------------------------------------------

def test_language_on_held_out_rows(spark):
    d = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = language.op1(d).join(d.select("doc_id", "lang"), "doc_id").filter("held_out").collect()
    assert sum(r.lang == r.lang_pred for r in got) / len(got) > 0.97


def test_forward_backward_against_enumeration():
    rng = np.random.default_rng(4)
    move = rng.normal(size=(3, 3))
    seqs = [rng.normal(size=(n, 3)) for n in (4, 3, 1)]
    flat = np.concatenate([[s[t] for s in seqs if t < len(s)] for t in range(4)])
    counts = np.array([3, 2, 2, 1])
    post = language.forward_backward(flat, move, counts)
    edges = np.concatenate([[0], np.cumsum(counts)])
    for k, s in enumerate(seqs):
        want = np.zeros((len(s), 3))
        for path in product(range(3), repeat=len(s)):
            w = np.exp(sum(s[t, y] for t, y in enumerate(path)) + sum(move[a, b] for a, b in zip(path, path[1:])))
            for t, y in enumerate(path):
                want[t, y] += w
        got = np.array([post[edges[t] + k] for t in range(len(s))])
        assert np.allclose(got, want / want.sum(axis=1, keepdims=True))


def test_expected_transitions_against_enumeration():
    rng = np.random.default_rng(5)
    move = rng.normal(size=(3, 3))
    seqs = [rng.normal(size=(n, 3)) for n in (4, 3, 1)]
    flat = np.concatenate([[s[t] for s in seqs if t < len(s)] for t in range(4)])
    got, want = np.zeros((3, 3)), np.zeros((3, 3))
    language.forward_backward(flat, move, np.array([3, 2, 2, 1]), got)
    for s in seqs:
        paths = list(product(range(3), repeat=len(s)))
        w = np.array([np.exp(sum(s[t, y] for t, y in enumerate(p)) + sum(move[a, b] for a, b in zip(p, p[1:])))
                      for p in paths])
        for p, x in zip(paths, w / w.sum()):
            for a, b in zip(p, p[1:]):
                want[a, b] += x
    assert np.allclose(got, want)


def test_sample_has_whole_texts(docs):
    rows = [(i, "word " * 2000 + f"late{i}", "en") for i in range(40)]
    got = language.sample(docs(rows))
    assert got and all(t.startswith("word ") and t.split()[-1].startswith("late") for _, t in got)


def test_a_hundred_languages(docs):
    names = [chr(97 + k // 26) + chr(97 + k % 26) for k in range(100)]
    rows = [(100 * k + i, f"{x}xa {x}xb {x}xc {x}xd " * 3, x) for k, x in enumerate(names) for i in range(4)]
    model = language.train(language.sample(docs(rows)), epochs=2)
    assert len(model.languages) == 100
    member = language.membership(model.lexicons, [names[99] + "xa", "none", names[3] + "xb"], 100)
    assert member.sum(axis=1).tolist() == [1, 0, 1] and member[0, model.languages.index(names[99])] == 1
    got = {r.doc_id: r.lang_pred for r in language.with_language(docs(rows[:40]), model).collect()}
    assert sum(got[i] == lang for i, _, lang in rows[:40]) >= 36


def test_sample_is_bounded_in_characters(docs, monkeypatch):
    monkeypatch.setattr(language, "SAMPLE_CHARS", 1000)
    got = language.sample(docs([(i, "word " * 60, "en") for i in range(40)] + [(100 + i, "lang " * 3000, "de") for i in range(9)]))
    sizes = {}
    for lang, t in got:
        sizes.setdefault(lang, []).append(len(t))
    assert sizes == {"en": [300] * 4, "de": [15000]}


def test_language_cases(docs, clash):
    rows = [(i, "the cat and the dog are here with that", "en") for i in range(20)] + \
           [(i, "der Hund und die Katze sind hier mit dem", "de") for i in range(20, 40)]
    model = language.train(language.sample(docs(rows)))
    d = clash(docs([(1, None), (2, "123 ²½ !"), (3, "the dog " * 8000), (4, "the cat and the dog und die Katze sind hier")]))
    got = {r.doc_id: r for r in language.with_language(d, model, runs=True).collect()}
    assert got[1].lang_pred == got[2].lang_pred == "und" and got[1].score == 0
    assert got[3].lang_pred == "en"
    assert [r.lang for r in got[4].lang_runs] == ["en", "de"]
    assert language.op1(docs([])).count() == 0
    assert {r.lang_pred for r in language.op1(docs([(1, "a b", None)])).collect()} == {"und"}


# -- tokens --------------------------------------------------------------------

@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_encoder_equals_library(spark, name):
    enc = Encoder(vocabulary(name))
    texts = [r.text for r in spark.read.parquet(f"{SF}/documents.parquet").select("text").collect()] + ODD
    for _ in range(2):  # cold and remembered
        got = enc.ids(texts + [None])
        want = [np.asarray(e.ids, "<u4").tobytes() for e in enc.tokenizer.encode_batch(texts, add_special_tokens=False)]
        assert got == want + [b""]


ADDED = ["a b<|endoftext|>c d", "<|startoftext|>word, word<|endoftext|>", "A <|ENDOFTEXT|> b", "A <|EndOfText|>.",
         "é́ 日本 <|endoftext|> x", "日本 <|ENDOFTEXT|> x", "no token <|endoftext |>", "a  <|endoftext|>\n\nb"]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_added_tokens_as_in_the_fresh_library(docs, name):
    from tokenizers import Tokenizer

    enc, fresh = Encoder(vocabulary(name)), Tokenizer.from_file(vocabulary(name))
    for _ in range(2):  # cold and remembered
        want = [fresh.encode(t, add_special_tokens=False).ids for t in ODD + ADDED]
        assert [np.frombuffer(x, "<u4").tolist() for x in enc.ids(ODD + ADDED)] == want
    sizes = {r.doc_id: r.n_tokens for r in token_files.op4(docs(list(enumerate(ODD + ADDED))), vocabulary(name)).collect()}
    assert [sizes[i] for i in range(len(want))] == [len(x) + 1 for x in want]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_every_letter_before_every_mark(name):
    from tokenizers import Tokenizer

    letters = [c for c in map(chr, range(sys.maxunicode + 1)) if c.isalpha() and not "\u3400" <= c <= "\ud7a3"]
    changed = [c for c in letters if unicodedata.normalize("NFKC", c).lower() != c]
    texts = [f"x {w}{m} y" for c in changed for w in (c, "ab" + c) for m in ENDS] + [f"{c}." for c in letters]
    rng = np.random.default_rng(3)
    some = [c for c in "EVİeviŞKışk\u0958\u095f\u09dc\u0a33\ufb1d\ufb2aàé字.,;:!? \n" for _ in range(2)]
    texts += ["".join(rng.choice(some, rng.integers(1, 30))) for _ in range(20_000)]
    enc, fresh = Encoder(vocabulary(name)), Tokenizer.from_file(vocabulary(name))
    want = [np.asarray(e.ids, "<u4").tobytes() for e in fresh.encode_batch(texts, add_special_tokens=False)]
    wrong = [t for t, a, b in zip(texts, enc.ids(texts), want) if a != b]
    assert not wrong, (len(wrong), wrong[:5])


def test_bounded_encoder_and_worker_memory():
    """An encoder that remembers little gives the same ids, and building one
    frees what other stages left in the worker."""
    path = vocabulary("word_bpe_49k.json")
    rng = random.Random(5)
    texts = [" ".join(f"w{rng.randrange(900)}x" for _ in range(60)) for _ in range(80)]
    small = Encoder(path, pieces=50, group=1000)
    assert small.ids(texts) == Encoder(path).ids(texts)
    assert len(small.old) + len(small.young) < 400  # of 900 words and more
    common.word_hashes()
    assert packing.encoder(path, packing.KNOWN_PIECES, packing.GROUP_CHARS).pieces == packing.KNOWN_PIECES < 600_000
    assert [k for k in vars(sys.modules["_orderflow_llm_worker"]) if not k.startswith("__")] == [
        f"encoder_word_bpe_49k.json_{packing.KNOWN_PIECES}_{packing.GROUP_CHARS}"]


def test_token_files(spark, docs, clash):
    rows = [(7, "b"), (3, None), (5, ""), (7, "a"), (1, "long text " * 9000), (None, "no id")] + [
        (100 + i, t) for i, t in enumerate(ODD)]
    checkpoint_root(spark)
    path = scratch_path(spark, "test-orc")
    vocab = vocabulary("byte_bpe_50k.json")
    token_files.write(clash(docs(rows)), path, vocab)
    enc = Encoder(vocab)
    got = token_files.read(spark, path).orderBy("part", "start_in_part").collect()
    want = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    assert [r.doc_id for r in got] == [r[0] for r in want]
    assert [r.tokens for r in got] == [np.frombuffer(enc.ids([t])[0], "<u4").tolist() + [2] for _, t in want]
    some = token_files.read(spark, path, [3, 101])
    assert sorted(r.doc_id for r in some.collect()) == [3, 101]
    plan = some._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    assert re.search(r"PushedFilters: \[.*doc_id", plan), plan
    rows2 = sorted(token_files.op4(docs(rows[:5]), vocab).collect(), key=lambda r: r.start)
    at = 0
    for r in rows2:
        assert r.start == at
        at += r.n_tokens
    assert token_files.op4(docs([]), vocab).count() == 0


def test_token_file_metadata(spark, docs):
    from pyarrow import fs, orc

    checkpoint_root(spark)
    path = scratch_path(spark, "test-orc-meta")
    token_files.write(docs([(i, "some words here") for i in range(5000)]), path, vocabulary("byte_bpe_50k.json"))
    local, root = fs.FileSystem.from_uri(path)
    files = [f.path for f in local.get_file_info(fs.FileSelector(root)) if f.path.endswith(".orc")]
    f = orc.ORCFile(local.open_input_file(files[0]))
    assert f.row_index_stride == 1000 and f.compression == "ZSTD"
    raw = local.open_input_stream(files[0]).read()
    assert f.stripe_statistics_length > 0 and len(raw) > 0


# -- packing ---------------------------------------------------------------------

def test_solution_holds_every_piece():
    rng = random.Random(1)
    for _ in range(20):
        cap = rng.choice([10, 64, 200])
        counts = {k: rng.choice([0, 1, 5, 300]) for k in rng.sample(range(1, cap + 1), rng.randrange(1, min(cap, 40)))}
        out = packing.solve(counts, cap)
        used: dict = {}
        for pattern, times in out:
            assert times > 0 and sum(k * n for k, n in pattern) <= cap
            for k, n in pattern:
                used[k] = used.get(k, 0) + n * times
        assert used == {k: n for k, n in counts.items() if n}
        plain = packing.best_fit({k: n for k, n in counts.items() if n}, cap)
        assert sum(t for _, t in out) <= sum(t for _, t in plain)


def test_program_is_near_its_bound_and_better_than_best_fit():
    rng = random.Random(1)
    counts = {k: rng.randrange(50, 900) for k in rng.sample(range(1100, 2900), 60)}
    use, bound = packing.cover(counts, 4096)
    covered = {k: sum(x * dict(c).get(k, 0) for c, x in use.items()) for k in counts}
    assert all(covered[k] >= counts[k] * (1 - 1e-9) for k in counts)
    assert bound <= sum(use.values()) + 1e-6 <= 1.01 * bound
    found = sum(n for _, n in packing.solve(counts, 4096))
    assert bound <= found + 1e-6 and found <= 1.005 * bound
    assert found < sum(n for _, n in packing.best_fit(counts, 4096))


def test_never_above_best_fit(monkeypatch):
    monkeypatch.setattr(packing, "STEPS", 200)
    monkeypatch.setattr(packing, "RATES", (0.1, 0.01))
    for seed in range(20):
        rng = random.Random(seed)
        counts = {k: rng.randrange(50, 900) for k in rng.sample(range(270, 720), 30)}
        use, bound = packing.cover(counts, 1024, 2)
        found = sum(n for _, n in packing.solve(counts, 1024))
        assert bound <= min(found, sum(use.values())) + 1e-6
        assert found <= sum(n for _, n in packing.best_fit(counts, 1024))


def test_mixed_length_lists_are_placed_by_the_program():
    counts = {k: 1000 for k in (500, 700, 1100, 1300, 1900, 2300)}
    out, placed = packing.rounded(counts, 4096)
    assert placed >= 0.9 * 6000, placed


def test_knapsack_against_enumeration():
    rng = np.random.default_rng(3)
    for _ in range(20):
        price = np.full(13, -1.0)
        lengths = rng.choice(np.arange(1, 13), 4, replace=False)
        price[lengths] = rng.random(4)
        found = packing.best_configuration(price, 12)
        best = max(sum(n * price[k] for n, k in zip(ns, lengths)) for ns in product(range(13), repeat=4)
                   if sum(n * k for n, k in zip(ns, lengths)) <= 12)
        assert abs(sum(n * price[k] for k, n in found) - best) < 1e-9


def test_packed_pieces(docs, clash):
    rows = [(i, "word " * (i * 7 % 90)) for i in range(120)] + [(500, "long words " * 400), (501, None), (502, ""),
                                                               (7, "again"), (7, "again"), (None, "no id")]
    vocab = vocabulary("word_bpe_49k.json")
    got = packing.pack(clash(docs(rows)), vocab, sequence=128).collect()
    by: dict = {}
    for r in got:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in by.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 128
    enc = Encoder(vocab)
    want = sorted((str(d), p // 128, p, zlib.crc32(ids[4 * p:4 * p + 512])) for d, ids in
                  ((d, enc.ids([t])[0] + b"\1\0\0\0") for d, t in rows) for p in range(0, len(ids) // 4, 128))
    assert sorted((str(r.doc_id), r.piece, r.start, r.ids_crc32) for r in got) == want
    assert len(by) <= sum(r.length for r in got) / 128 * 1.1 + 1
    assert packing.pack(docs([]), vocab).count() == 0


# -- WARC ----------------------------------------------------------------------------

PAGES = [(1, "http://a", "same"), (2, "http://b", "same"), (3, None, None), (4, "u r l\nx", ""), (None, "http://n", "same"),
         (6, "http://c", "é" * 40_000), (7, "http://d", "\x1f\x8b\x08" * 30), (2, "http://b", "same")]


def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id bigint, url string, html string")


def test_archives(spark):
    got = sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to)
                  for r in warc.op2(pages(spark, PAGES).withColumn("refers_to", F.lit(1))).collect()), key=str)
    want = []
    for p, _, h in PAGES:
        b = (h or "").encode()
        top = max(q for q, _, x in PAGES if q is not None and (x or "") == (h or ""))
        want.append((p, len(b), base64.b32encode(hashlib.sha1(b).digest()).decode(),
                     "response" if p == top else "revisit", None if p == top else top))
    assert got == sorted(want, key=str)
    assert warc.op2(pages(spark, [])).count() == 0


@pytest.mark.parametrize("range_bytes", [7, 100, 1 << 20])
def test_ranges_read_every_record_once(spark, range_bytes):
    rng = random.Random(2)
    rows = [(i, f"http://x/{i}", rng.randbytes(rng.randrange(0, 900)).decode("latin-1")) for i in range(40)]
    checkpoint_root(spark)
    path = scratch_path(spark, "test-warc")
    manifest = warc.write(warc.with_revisits(pages(spark, rows)), path, file_bytes=4000)
    got = {r.page_id: bytes(r.payload) for r in warc.read(spark, manifest, path, True, range_bytes).collect()}
    assert got == {i: h.encode() for i, _, h in rows}


def test_false_magic_is_skipped():
    class File:
        def __init__(self, data):
            self.data = data

        def read_at(self, n, at):
            return self.data[at:at + n]

    good = [warc.record(i, "u", b"payload" * i, None, False) for i in range(1, 4)]
    other = zlib.compressobj(6, zlib.DEFLATED, 31)
    data = good[0] + b"junk\x1f\x8b\x08junk" + other.compress(b"not a record") + other.flush() + good[1] + b"\0\0" + good[2]
    for cut in range(0, len(data), 13):
        seen = [warc.parse(x)["length"] for a, b in ((0, cut), (cut, len(data)))
                for x in warc.records_in(File(data), a, b, len(data))]
        assert seen == [7, 14, 21]


# -- registered queries ------------------------------------------------------------------

@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, name):
    from scripts.check_oracle import compare, duck

    res = compare(spark, name, QUERIES[name], ORACLE[name], SF, duck(SF))
    assert res["spark_rows"] == res["oracle_rows"] and res["schema_ok"] and res["hash_ok"], res


def test_byte_level_texts_with_runs_of_white_space_are_not_cut():
    import gc

    from orderflow.llm import tokens

    e = tokens.Encoder.__new__(tokens.Encoder)
    e.added, e.drops_space = [], False
    parts = ["a", "b", " ", "\n", "\t", "\u00a0", "\x1c", ""]
    texts = [a + b + c + d for a in parts for b in parts for c in parts for d in parts]
    for text in filter(None, texts):
        runs = text.replace("\n", " ") != " ".join(text.split())
        assert (e._cut(text) is None) == runs, repr(text)
        if not runs:
            assert [e._cut(text)[0], *e._cut(text)[1]] == text.replace("\n", " \n").split(" ")
    assert gc.isenabled()
    with tokens.uncollected():
        assert not gc.isenabled()
    assert gc.isenabled()


def test_encoder_asks_for_a_word_once_whatever_marks_follow_it():
    enc, asked = Encoder(vocabulary("word_bpe_49k.json")), []
    encode = enc._encode_words
    enc._encode_words = lambda words: asked.extend(words) or encode(words)
    texts = ["Abcde### abcde*** abcde$$$. abcde", "fghij%%% abcde&&& fghij' été_ ÉTÉ@ don't x9##", "abcde|~`^ ıj<> ıj="]
    for _ in range(2):
        want = enc.tokenizer.encode_batch(texts, add_special_tokens=False)
        assert enc.ids(texts) == [np.asarray(e.ids, "<u4").tobytes() for e in want]
    assert sorted(asked) == ["abcde", "fghij", "été", "ıj"]


def test_a_worker_keeps_objects_of_one_stage_only():
    import pyarrow as pa

    def stage():
        def fn(batches):
            common.word_hashes()
            yield from batches
        return fn

    def other(batches):
        yield from batches

    home = common._worker_home()
    batch = pa.RecordBatch.from_pydict({"x": [1]})
    assert list(common.released(stage())([batch])) == [batch]
    kept = vars(home)["word_hashes"]
    assert list(common.released(stage())([batch])) == [batch] and vars(home)["word_hashes"] is kept
    assert list(common.released(other)([batch])) == [batch] and "word_hashes" not in vars(home)


def test_byte_level_ids_tell_their_places():
    """The ids' own bytes cut them into pieces: no call that keeps places in the text."""
    class Placeless:
        def __init__(self, library):
            self.library = library

        def __getattr__(self, name):
            assert name != "encode_batch"
            return getattr(self.library, name)

    e = Encoder(vocabulary("byte_bpe_50k.json"))
    library = e.tokenizer
    e.tokenizer = Placeless(library)
    texts = ["One two, three.\nFour 55 don't", "é über 中文 naïve\n😀 x́ y", "a", None, "a  b\t c", "Zażółć gęślą, one\ntwo!"]
    want = [np.asarray(library.encode(t or "", add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
    assert e.ids(texts) == want and e.ids(texts) == want
