"""Benchmark decontamination: prefix-filtered set join with exact windows.

An item is cut into windows of ten consecutive words (a shorter item is
one window).  The tokens of a window are its three-word shingles.  They
are ordered by rarity, counted over all documents; a document can only
hold a whole window if it holds the window's rarest shingle, so one
prefix token per window is enough (containment needs every token).  The
join probes document shingles against the prefix tokens; a match at a
position must leave room for the whole window inside the document
(positional and length bound) and is then verified word by word.

Words: A-Z lower-cased, then runs of anything but ASCII non-alphanumerics.

The benchmark goes to the tasks in blocks of at most ``BLOCK_WORDS``
expected words, so a broadcast is bounded however large the table is;
every block meets all documents.

Defined cases: NULL or wordless text has no words and no hits; an item
without words or without id matches nothing; repeated items count once
per item id; items of one or two words are matched as one- or two-word
shingles.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_batches, shielded, shingle_hashes, stored, texts_of, word_hashes

WINDOW = 10
SHINGLE = 3
#: Expected words of benchmark text in one broadcast block.
BLOCK_WORDS = 1_000_000
#: Bits of the first-look table over prefix tokens.
TABLE_BITS = 20

_TO_WORDS = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or chr(c).isalnum() else 32
                  for c in range(256))


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(_TO_WORDS).split()


class Windows:
    """Distinct windows of one block of items, and a probe over them."""

    def __init__(self, items: list[tuple]):
        ids: dict[tuple, set] = defaultdict(set)
        for item_id, text in items:
            words = words_of(text)
            length = min(WINDOW, len(words))
            if item_id is None or not length:
                continue
            for i in range(len(words) - length + 1):
                ids[tuple(words[i:i + length])].add(str(item_id))
        self.windows = list(ids)
        self.items = [sorted(ids[w]) for w in self.windows]
        self.tokens: list[np.ndarray] = []
        hashes = word_hashes()
        for w in self.windows:
            self.tokens.append(shingle_hashes(hashes.of(list(w)), min(SHINGLE, len(w))))

    def token_sets(self) -> dict[int, np.ndarray]:
        """width -> sorted distinct shingle hashes."""
        by = defaultdict(list)
        for w, t in zip(self.windows, self.tokens):
            by[min(SHINGLE, len(w))].append(t)
        return {k: np.unique(np.concatenate(v)) for k, v in by.items()}

    def index(self, frequency: dict[tuple[int, int], int]) -> dict[int, "Probe"]:
        """One probe per shingle width, keyed by each window's rarest token."""
        entries: dict[int, dict] = defaultdict(lambda: defaultdict(list))
        for k, (w, tokens) in enumerate(zip(self.windows, self.tokens)):
            width = min(SHINGLE, len(w))
            at = min(range(len(tokens)),
                     key=lambda i: (frequency.get((width, int(tokens[i])), 0), int(tokens[i])))
            entries[width][int(tokens[at])].append((k, at))
        return {width: Probe(width, dict(e)) for width, e in entries.items()}


class Probe:
    """Prefix tokens of one width with the windows behind them."""

    def __init__(self, width: int, entries: dict[int, list]):
        self.width, self.entries = width, entries
        self.first_look = np.zeros(1 << TABLE_BITS, bool)
        keys = np.fromiter(entries, np.uint64, len(entries))
        self.first_look[(keys & np.uint64((1 << TABLE_BITS) - 1)).astype(np.int64)] = True

    def candidates(self, hashed: np.ndarray):
        """(position, [(window, offset of the token in it)]) of matches."""
        tokens = shingle_hashes(hashed, self.width)
        look = self.first_look[(tokens & np.uint64((1 << TABLE_BITS) - 1)).astype(np.int64)]
        for p in np.flatnonzero(look):
            found = self.entries.get(int(tokens[p]))
            if found:
                yield int(p), found


def _frequencies(docs: DataFrame, sets: dict[int, np.ndarray], text: str) -> dict:
    """Occurrences over all documents of each benchmark shingle."""
    def run(batch):
        hashes, widths, keys, counts = word_hashes(), [], [], []
        for width, wanted in sets.items():
            total = np.zeros(len(wanted), np.int64)
            mask = np.uint64((1 << TABLE_BITS) - 1)
            look = np.zeros(1 << TABLE_BITS, bool)
            look[(wanted & mask).astype(np.int64)] = True
            for t in texts_of(batch, text):
                s = shingle_hashes(hashes.of(words_of(t)), width)
                s = s[look[(s & mask).astype(np.int64)]]
                if len(s):
                    at = np.minimum(np.searchsorted(wanted, s), len(wanted) - 1)
                    np.add.at(total, at[wanted[at] == s], 1)
            hit = np.flatnonzero(total)
            widths += [width] * len(hit)
            keys += wanted[hit].astype(np.int64).tolist()
            counts += total[hit].tolist()
        return {"width": pa.array(widths, pa.int32()), "token": pa.array(keys, pa.int64()),
                "n": pa.array(counts, pa.int64())}

    rows = (map_batches(docs.select(text), run, "width int, token bigint, n bigint")
            .groupBy("width", "token").agg(F.sum("n").alias("n")))
    # At most one row per distinct benchmark shingle of this block.
    return {(r["width"], r["token"] % (1 << 64)): r["n"] for r in rows.toLocalIterator()}


def _blocks(benchmark: DataFrame, block_words: int):
    """Lists of (item_id, text), together the whole table."""
    total = benchmark.select("item_id", "text").distinct().agg(F.sum(F.length("text"))).first()[0] or 0
    n = int(total // (6 * block_words)) + 1
    rows = benchmark.select("item_id", "text").distinct()
    if n == 1:
        yield [tuple(r) for r in rows.collect()]
        return
    keyed = stored(rows.withColumn("_b", F.pmod(F.xxhash64("item_id", "text"), F.lit(n))),
                   "benchmark-blocks", partition_by=["_b"])
    for b in range(n):
        yield [tuple(r) for r in keyed.filter(F.col("_b") == b).select("item_id", "text").collect()]


def mark(docs: DataFrame, benchmark: DataFrame, text: str = "text",
         block_words: int = BLOCK_WORDS) -> DataFrame:
    """Every column of ``docs`` plus ``_words`` (count), ``_spans`` (start
    and end word of merged hit runs, flattened) and ``_items`` (ids of
    items with occurring windows)."""
    docs = docs.drop("_words", "_spans", "_items")  # replaced, if there are such
    own = docs.columns
    marked = docs.withColumn("_words", F.lit(0).cast("bigint")) \
        .withColumn("_spans", F.array().cast("array<bigint>")) \
        .withColumn("_items", F.array().cast("array<string>"))
    for number, items in enumerate(_blocks(benchmark, block_words)):
        windows = Windows(items)
        frequency = _frequencies(docs, windows.token_sets(), text) if windows.windows else {}
        index = docs.sparkSession.sparkContext.broadcast(
            (windows.windows, windows.items, windows.index(frequency)))

        def run(batch, index=index):
            wins, ids, probes = index.value
            hashes, n_words, spans, items = word_hashes(), [], [], []
            for t, old_spans, old_items in zip(texts_of(batch, text), texts_of(batch, "_spans"),
                                               texts_of(batch, "_items")):
                words = words_of(t)
                n_words.append(len(words))
                found = set(old_items)
                hit = [tuple(x) for x in zip(old_spans[::2], old_spans[1::2])]
                hashed = hashes.of(words)
                for probe in probes.values():
                    for p, behind in probe.candidates(hashed):
                        for k, offset in behind:
                            start = p - offset
                            end = start + len(wins[k])
                            if start >= 0 and end <= len(words) and tuple(words[start:end]) == wins[k]:
                                hit.append((start, end))
                                found.update(ids[k])
                spans.append(merged(hit))
                items.append(sorted(found))
            return {"_words": pa.array(n_words, pa.int64()),
                    "_spans": pa.array(spans, pa.list_(pa.int64())),
                    "_items": pa.array(items, pa.list_(pa.string()))}

        if number:  # one block's Python step at a time
            marked = stored(marked, "benchmark-marks")
        marked = map_batches(marked, run, "_words bigint, _spans array<bigint>, _items array<string>",
                             keep=own)
    return marked


def merged(spans: list[tuple[int, int]]) -> list[int]:
    """Union of half-open runs, flattened to start, end, start, end, ..."""
    out: list[int] = []
    for start, end in sorted(set(spans)):
        if out and start <= out[-1]:
            out[-1] = max(out[-1], end)
        else:
            out += [start, end]
    return out


def keep_clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Documents without any benchmark window, same columns."""
    return shielded(docs, lambda d: mark(d, benchmark).filter(F.size("_items") == 0).select(*d.columns))


def op9(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    rows = mark(docs.select("doc_id", "text"), benchmark)
    n_hit = F.aggregate(F.sequence(F.lit(0), F.floor(F.size("_spans") / 2) - 1), F.lit(0).cast("bigint"),
                        lambda acc, i: acc + F.get("_spans", (2 * i + 1).cast("int"))
                        - F.get("_spans", (2 * i).cast("int")))
    return rows.select(
        "doc_id", F.col("_words").alias("n_words"),
        F.when(F.size("_spans") > 0, n_hit).otherwise(F.lit(0).cast("bigint")).alias("n_hit"),
        F.size("_items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("_items", ","), 256).alias("items_sha256"),
        (F.size("_spans") > 0).alias("contaminated"))


def brute_force(docs: list[tuple], items: list[tuple]) -> dict:
    """doc_id -> (n_words, n_hit, items), for tests."""
    out = {}
    for doc_id, text in docs:
        words, hit, ids = words_of(text), set(), set()
        for item_id, t in items:
            w = words_of(t)
            length = min(WINDOW, len(w))
            for i in range(len(w) - length + 1 if length else 0):
                for p in range(len(words) - length + 1):
                    if words[p:p + length] == w[i:i + length]:
                        hit.update(range(p, p + length))
                        ids.add(str(item_id))
        names = ",".join(sorted(ids))
        out[doc_id] = (len(words), len(hit), len(ids), hashlib.sha256(names.encode()).hexdigest())
    return out
