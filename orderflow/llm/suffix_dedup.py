"""Substring dedup over suffix arrays built by induced sorting.

A byte goes if a 50-byte string that covers it also starts in a document
with a smaller id.  The work is cut so that no task needs the corpus:

1. Equal texts: all but the smallest id are copies, whose every string
   starts in a smaller document.  The rest is stored in packs.
2. Each 50-byte window has a key, the smallest hash of its 16-byte
   strings, so equal windows have equal keys.  A pack sends its distinct
   keys and their bytes to key shards, a row each (shards are large, as
   these rows grow with packs times shards), and gets back those that other
   packs hold too, and which of them are hot: over ``HOT_BYTES`` in all.
   The windows of a hot key are grouped by their whole 50 bytes instead,
   with the smallest document of a pack, and then of all, per window.
3. Runs of windows under a shared key are cut out as segments and sent to
   the key's shard.  Equal segments are settled at once.  The others form
   the shard's text, whose suffixes are sorted: S* suffixes first, then L
   suffixes by one left-to-right induction and S suffixes by one
   right-to-left induction, each through a queue that hands out suffixes
   by first byte, then in order of arrival.  The queues keep a bounded
   number of suffixes in memory and the rest in a local file.  Adjacent
   suffixes with a common prefix of 50 bytes are one group.
   A shard over ``BLOCK_BYTES`` waits in a local file and is sorted in
   blocks of whole keys, so a sort holds a block and at most one key more.
   A segment is sorted only if it can share a window: the 34 bytes of a
   window beside the string that gave the key leave 17 on one side, so an
   equal window stands in a segment with the same 17 bytes on that side.
4. Removed windows go back to the packs, which cut and hash the texts.

Order is only needed to the depth of a window, so S* suffixes are sorted
by their first 56 bytes instead of by recursion on their names.

Defined cases: NULL text is empty; texts under 50 bytes lose nothing; a
row without id neither loses nor takes anything; rows that repeat an id
are judged by it, and equal rows of one id are not smaller than each
other; no documents give no rows.
"""

from __future__ import annotations

import hashlib
import tempfile

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.joins import broadcast_if_small
from .common import mix, released, settled, shuffle_partitions, stored, worker_cache

WINDOW = 50
GRAM = 16
#: Documents and bytes of one pack.
PACK_DOCS = 4096
PACK_BYTES = 4 << 20
#: Texts are hashed together up to so many bytes.
GROUP_BYTES = 64 << 10
#: Corpus bytes per key shard; smaller input has up to FEW_SHARDS smaller ones.
SHARD_BYTES = 32 << 20
FEW_SHARDS = 64
#: Segment bytes of one key from which its windows are grouped one by one.
HOT_BYTES = 1 << 20
#: Segment bytes of hot keys in one row.
HOT_ROW_BYTES = 256 << 10
#: Segment bytes sorted at once.
BLOCK_BYTES = 4 << 20
#: Suffixes a queue keeps in memory before it writes to its file.
QUEUE_ITEMS = 2 << 20
SORT_DEPTH = 56


def _squeeze(raw: bytes) -> bytes:
    import zstandard

    return worker_cache("zstd_out", lambda: zstandard.ZstdCompressor(level=3)).compress(raw)


def _expand(raw: bytes) -> bytes:
    import zstandard

    return worker_cache("zstd_in", zstandard.ZstdDecompressor).decompress(raw)


def _words(text: np.ndarray, kind: str = "<u8") -> np.ndarray:
    """The 8 bytes from every position on, as one number."""
    return np.ndarray((max(0, len(text) - 7),), kind, text.tobytes(), 0, (1,))


def grams(text: bytes) -> np.ndarray:
    """Hash of the 16-byte string at every start."""
    w = _words(np.frombuffer(text, np.uint8))
    return mix(w[:-8] * np.uint64(0x9E3779B97F4A7C15) ^ mix(w[8:]))


def window_keys(text: bytes) -> np.ndarray:
    """Key of the window at every start; empty for texts under a window."""
    n = len(text) - WINDOW + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    h = grams(text)
    span, have = WINDOW - GRAM + 1, 1
    while 2 * have <= span:  # minima over 1, 2, 4, ... strings
        h = np.minimum(h[:-have], h[have:])
        have *= 2
    rest = span - have
    return np.minimum(h[:-rest], h[rest:]) if rest else h


def pack_runs(raw: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(key, document, first window, number of windows) of runs of equal
    keys inside the documents, in order."""
    parts, at = [], 0
    while at < len(raw):
        end, held = at + 1, len(raw[at])
        while end < len(raw) and held + len(raw[end]) <= GROUP_BYTES:
            held += len(raw[end])
            end += 1
        keys = window_keys(b"".join(raw[at:end]))
        if len(keys):
            edges = np.cumsum([0, *map(len, raw[at:end])])
            over = np.maximum(edges[1:] - WINDOW + 1, edges[:-1])  # windows from here on cross into the next document
            begins = np.concatenate([[True], keys[1:] != keys[:-1]])
            for cuts in (edges, over):
                begins[cuts[cuts < len(keys)]] = True
            first = np.flatnonzero(begins)
            count = np.diff(np.append(first, len(keys)))
            doc = np.searchsorted(edges, first, "right") - 1
            ok = first < over[doc]
            first, count, doc = first[ok], count[ok], doc[ok]
            parts.append((keys[first], doc + at, first - edges[doc], count))
        at = end
    if not parts:
        return np.empty(0, np.uint64), *(np.empty(0, np.int64) for _ in range(3))
    return tuple(np.concatenate(c) for c in zip(*parts))


def equal_strings(text: bytes, at: np.ndarray, size: np.ndarray) -> np.ndarray:
    """A number for each of the strings (8 bytes or more), the same only for equal ones.

    Equal strings have the same number, but for those whose hash another
    string has too: each has its own.
    """
    eight = _words(np.frombuffer(text, np.uint8))

    def by_words(step):
        todo, d = np.arange(len(at)), 0
        while len(todo):
            step(todo, np.minimum(d, size[todo] - 8))
            todo = todo[size[todo] > d + 8]
            d += 8

    h = mix(size.astype(np.uint64))

    def add(todo, d):
        h[todo] = mix(h[todo] * np.uint64(0x9E3779B97F4A7C15) ^ eight[at[todo] + d])

    by_words(add)
    _, first, number = np.unique(h, return_index=True, return_inverse=True)
    like = first[number]
    other = size != size[like]

    def compare(todo, d):
        todo, d = todo[~other[todo]], d[~other[todo]]
        other[todo] |= eight[at[todo] + d] != eight[at[like[todo]] + d]

    by_words(compare)
    number[other] = len(first) + np.arange(np.count_nonzero(other))
    return number


def may_share(text: bytes, at: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Which of the segments, together ``text``, can share a window with
    another: all that do, and few others."""
    half = (WINDOW - GRAM + 1) // 2
    eight, h = _words(np.frombuffer(text, np.uint8)), grams(text)
    key = np.minimum.reduceat(np.append(h, h[-1:]), np.stack([at, at + size - GRAM + 1], 1).ravel())[::2]
    own = np.repeat(np.arange(len(at)), size)[:len(h)]
    spot = np.flatnonzero(h == key[own])
    own = own[spot]
    spot, own = (x[spot + GRAM <= (at + size)[own]] for x in (spot, own))
    hashes, owners = [], []
    for side, start, fits in ((1, spot - half, spot - half >= at[own]),
                              (2, spot + GRAM, spot + GRAM + half <= (at + size)[own])):
        start, whose = start[fits], own[fits]
        x = mix(key[whose] + np.uint64(side))
        for d in (*range(0, half - 7, 8), half - 8):
            x = mix(x * np.uint64(0x9E3779B97F4A7C15) ^ eight[start + d])
        hashes.append(x)
        owners.append(whose)
    hashes, owners = np.concatenate(hashes), np.concatenate(owners)
    out = np.zeros(len(at), bool)
    if len(hashes):
        order = np.argsort(hashes, kind="stable")  # owners stay in order
        hashes, owners = hashes[order], owners[order]
        first = np.flatnonzero(np.concatenate([[True], hashes[1:] != hashes[:-1]]))
        end = np.append(first[1:], len(hashes))
        out[owners[np.repeat(owners[first] != owners[end - 1], end - first)]] = True
    return out


class BucketQueue:
    """Suffixes by bucket, in order of arrival; full buckets go to a file."""

    def __init__(self, buckets: int, limit: int = QUEUE_ITEMS):
        self.parts: list[list] = [[] for _ in range(buckets)]
        self.limit, self.held, self.file = limit, 0, None

    def push(self, bucket: int, items: np.ndarray) -> None:
        self.parts[bucket].append(items)
        self.held += len(items)
        if self.held > self.limit:
            self._spill()

    def push_by(self, buckets: np.ndarray, items: np.ndarray) -> None:
        """Push each item to its bucket, keeping their order."""
        if len(items):
            order = np.argsort(buckets, kind="stable")
            sorted_ = buckets[order]
            cuts = np.concatenate([[0], np.flatnonzero(sorted_[1:] != sorted_[:-1]) + 1, [len(order)]])
            items = items[order]
            for a, b in zip(cuts[:-1], cuts[1:]):
                self.push(int(sorted_[a]), items[a:b])

    def _spill(self) -> None:
        if self.file is None:
            self.file = tempfile.TemporaryFile()
        for parts in self.parts:
            for k, p in enumerate(parts):
                if isinstance(p, np.ndarray) and len(p):
                    at = self.file.seek(0, 2)
                    self.file.write(np.ascontiguousarray(p).tobytes())
                    parts[k] = (at, len(p), p.dtype)
        self.held = 0

    def take(self, bucket: int) -> np.ndarray:
        """All items of a bucket, which becomes empty."""
        out, parts = [], self.parts[bucket]
        for p in parts:
            if isinstance(p, tuple):
                self.file.seek(p[0])
                p = np.frombuffer(self.file.read(p[1] * p[2].itemsize), p[2])
            else:
                self.held -= len(p)
            out.append(p)
        self.parts[bucket] = []
        return np.concatenate(out) if out else np.empty(0, np.int32)

    def close(self) -> None:
        if self.file is not None:
            self.file.close()


def sorted_suffixes(text: np.ndarray, limit: int = QUEUE_ITEMS):
    """Yield suffix positions of ``text`` (uint8, a byte over 0 and then
    SORT_DEPTH zeros at its end) in order of their first SORT_DEPTH bytes,
    bucket by bucket; the last zeros are left out."""
    n = len(text)
    change = np.flatnonzero(text[1:] != text[:-1])
    # A suffix is of type S if the next other byte is larger: one type per run of a byte.
    kind = np.append(text[change] < text[change + 1], True)
    small = np.repeat(kind, np.diff(np.concatenate([[-1], change, [n - 1]])))
    star = (np.flatnonzero(small[1:] & ~small[:-1]) + 1).astype(np.int32)
    words = _words(text, ">u8")
    for d in range(SORT_DEPTH - 8, -1, -8):  # by the last 8 bytes first, stable
        star = star[np.argsort(words[np.minimum(star + d, len(words) - 1)], kind="stable")]
    buckets = text[star]
    cuts = np.searchsorted(buckets, np.arange(257))

    large = BucketQueue(256, limit)  # queue of L suffixes still to be scanned
    kept = BucketQueue(256, limit)  # L suffixes in order
    for c in range(256):
        while True:
            now = large.take(c)
            if not len(now):
                break
            kept.push(c, now)
            _induce_large(text, large, now, c)
        _induce_large(text, large, star[cuts[c]:cuts[c + 1]], c)
    large.close()

    less = BucketQueue(256, limit)  # queue of S suffixes, largest first
    done = BucketQueue(256, limit)
    for c in range(255, -1, -1):
        while True:
            now = less.take(c)
            if not len(now):
                break
            done.push(c, now)
            _induce_small(text, small, less, now)
        now = kept.take(c)
        done.push(c, now[::-1])
        _induce_small(text, small, less, now[::-1])
    less.close()
    kept.close()
    for c in range(256):
        yield done.take(c)[::-1]
    done.close()


def _induce_large(text: np.ndarray, queue: BucketQueue, now: np.ndarray, c: int) -> None:
    before = now[now > 0] - 1
    byte = text[before]
    ok = byte >= c
    queue.push_by(byte[ok], before[ok])


def _induce_small(text: np.ndarray, small: np.ndarray, queue: BucketQueue, now: np.ndarray) -> None:
    before = now[now > 0] - 1
    before = before[small[before]]
    queue.push_by(text[before], before)


def equal_windows(segments: list[bytes], owner: np.ndarray, limit: int = QUEUE_ITEMS) -> list[np.ndarray]:
    """For each segment, which of its windows also start in a segment of a
    smaller owner."""
    sizes = np.array([len(s) for s in segments], np.int64)
    start = np.concatenate([[0], np.cumsum(sizes + 1)[:-1]]).astype(np.int64)
    text = np.frombuffer(b"\0".join(segments) + b"\0\1" + b"\0" * SORT_DEPTH, np.uint8)
    n = len(text)
    valid, whose = np.zeros(n, bool), np.zeros(n, np.int32)
    for k, (a, size) in enumerate(zip(start.tolist(), sizes.tolist())):
        valid[a:a + size - WINDOW + 1] = True
        whose[a:a + size] = k
    words = _words(text)
    removed = np.zeros(n, bool)
    depths = [0, 8, 16, 24, 32, 40, WINDOW - 8]
    for order in sorted_suffixes(text, limit):
        order = order[valid[order]]
        if len(order) < 2:
            continue
        same = np.ones(len(order) - 1, bool)
        for d in depths:
            w = words[order + d]
            same &= w[1:] == w[:-1]
        first = np.concatenate([[0], np.flatnonzero(~same) + 1])
        ids = owner[whose[order]]
        least = np.repeat(np.minimum.reduceat(ids, first), np.diff(np.concatenate([first, [len(ids)]])))
        removed[order[least < ids]] = True
    return [removed[a:a + size - WINDOW + 1] for a, size in zip(start.tolist(), sizes.tolist())]


# -- packs ------------------------------------------------------------------

def packs_of(docs: DataFrame) -> DataFrame:
    """Stored (pack, ids, sizes, texts): documents (doc_id, text) in packs."""
    def run(batches):
        ids, raw, held = [], [], 0
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids.append(doc_id)
                raw.append((text or "").encode("utf-8", "surrogatepass"))
                held += len(raw[-1])
                if len(ids) >= PACK_DOCS or held >= PACK_BYTES:
                    yield _pack(ids, raw)
                    ids, raw, held = [], [], 0
        if ids:
            yield _pack(ids, raw)

    packed = docs.select("doc_id", "text").mapInArrow(released(run), "ids binary, sizes binary, texts binary")
    return stored(packed.withColumn("pack", F.monotonically_increasing_id()), "text-packs")


def _pack(ids: list[int], raw: list[bytes]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([x], pa.binary()) for x in (np.array(ids, "<i8").tobytes(),
                                              np.array([len(r) for r in raw], "<i8").tobytes(),
                                              _squeeze(b"".join(raw)))],
        names=["ids", "sizes", "texts"])


def _unpack(ids: bytes, sizes: bytes, texts: bytes):
    """(doc ids, list of texts)."""
    edges = np.concatenate([[0], np.cumsum(np.frombuffer(sizes, "<i8"))])
    raw = _expand(texts)
    return np.frombuffer(ids, "<i8"), [raw[a:b] for a, b in zip(edges[:-1], edges[1:])]


def _by_shard(keys: np.ndarray, shards: int):
    """(shard, positions of its keys)."""
    shard = (mix(keys) % np.uint64(shards)).astype(np.int64)
    order = np.argsort(shard, kind="stable")
    cuts = np.concatenate([[0], np.flatnonzero(np.diff(shard[order])) + 1, [len(order)]])
    for a, b in zip(cuts[:-1], cuts[1:]):
        if b > a:
            yield int(shard[order[a]]), order[a:b]


def _found(keys: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Positions of the keys that are in ``known`` (sorted)."""
    if not len(known):
        return np.empty(0, np.int64)
    at = np.minimum(np.searchsorted(known, keys), len(known) - 1)
    return np.flatnonzero(known[at] == keys)


def shared_keys(packs: DataFrame, shards: int) -> DataFrame:
    """(pack, keys, hot): keys of the pack that another pack has as well,
    those of more than ``HOT_BYTES`` in ``hot``.

    Bytes of a key travel as one byte, 8 * log2 rounded up.
    """
    def send(batches):
        for batch in batches:
            for row in batch.to_pylist():
                _, raw = _unpack(row["ids"], row["sizes"], row["texts"])
                key, _, _, count = pack_runs(raw)
                keys, which = np.unique(key, return_inverse=True)
                held = np.bincount(which, count + (WINDOW - 1), len(keys))
                level = np.minimum(np.ceil(8 * np.log2(np.maximum(held, 1))), 255).astype(np.uint8)
                out = [(s, row["pack"], keys[at].tobytes(), level[at].tobytes()) for s, at in _by_shard(keys, shards)]
                if out:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([o[0] for o in out], pa.int32()), pa.array([o[1] for o in out], pa.int64()),
                         pa.array([o[2] for o in out], pa.binary()), pa.array([o[3] for o in out], pa.binary())],
                        names=["shard", "pack", "keys", "levels"])

    def answer(batches):
        by: dict[int, list] = {}
        for batch in batches:
            for shard, pack, keys, levels in zip(*(c.to_pylist() for c in batch.columns)):
                by.setdefault(shard, []).append((pack, np.frombuffer(keys, "<u8"), np.frombuffer(levels, np.uint8)))
        for shard in list(by):
            got = by.pop(shard)
            keys = np.concatenate([k for _, k, _ in got])
            held = np.exp2(np.concatenate([v for _, _, v in got]) / 8)
            order = np.argsort(keys, kind="stable")
            sorted_ = keys[order]
            twin = np.zeros(len(keys), bool)
            same = sorted_[1:] == sorted_[:-1]
            twin[order[1:][same]] = True
            twin[order[:-1][same]] = True
            first = np.concatenate([[0], np.flatnonzero(~same) + 1])
            much = np.add.reduceat(held[order], first) > HOT_BYTES
            hot = np.empty(len(keys), bool)
            hot[order] = np.repeat(much, np.diff(np.concatenate([first, [len(keys)]])))
            rows, at = [], 0
            for p, k, _ in got:
                t, h = twin[at:at + len(k)], hot[at:at + len(k)]
                at += len(k)
                if t.any():
                    rows.append((p, k[t & ~h].tobytes(), k[t & h].tobytes()))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()),
                                                  pa.array([r[1] for r in rows], pa.binary()),
                                                  pa.array([r[2] for r in rows], pa.binary())],
                                                 names=["pack", "keys", "hot"])

    return packs.select("pack", "ids", "sizes", "texts").mapInArrow(
        released(send), "shard int, pack bigint, keys binary, levels binary").repartition(shards, "shard").mapInArrow(
        released(answer), "pack bigint, keys binary, hot binary")


def segments_of(packs: DataFrame, keys: DataFrame, shards: int) -> DataFrame:
    """(shard, pack, docs, firsts, sizes, tags, bytes) of segments under shared keys.

    Of equal segments inside a pack only the smallest document's goes out;
    the others come back as settled rows with shard -1.  Segments of hot
    keys stay rows of their pack, with shards -2, -3, ...  Tags are bits of
    the keys that did not choose the shard.
    """
    own = packs.join(keys.groupBy("pack").agg(F.collect_list("keys").alias("keys"),
                                              F.collect_list("hot").alias("hot")), "pack", "left")

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                ids, raw = _unpack(row["ids"], row["sizes"], row["texts"])
                known, hot = (np.unique(np.concatenate([np.frombuffer(k, "<u8") for k in row[c] or []]
                                                       or [np.empty(0, np.uint64)])) for c in ("keys", "hot"))
                key, doc, first, count = pack_runs(raw)
                order = np.argsort(key, kind="stable")  # documents stay in order
                k, d = key[order], doc[order]
                several = k[1:][(k[1:] == k[:-1]) & (d[1:] != d[:-1])]
                at = _found(key, np.unique(np.concatenate([known, hot, several])))
                if not len(at):
                    continue
                key, doc, first, size = key[at], doc[at], first[at], count[at] + (WINDOW - 1)
                text = b"".join(raw)
                start = np.cumsum([0, *map(len, raw)])[doc] + first
                number = equal_strings(text, start, size)
                doc = ids[doc]
                least = np.full(number.max() + 1, np.iinfo(np.int64).max)
                np.minimum.at(least, number, doc)
                goes = doc <= least[number]  # the same id again is judged like the first
                rows = []
                if not goes.all():
                    rows.append((-1, doc[~goes], first[~goes], size[~goes] - (WINDOW - 1), None, b""))
                key, doc, first, size, start = (x[goes] for x in (key, doc, first, size, start))
                apart = np.zeros(len(key), bool)
                apart[_found(key, hot)] = True
                cold, warm = np.flatnonzero(~apart), np.flatnonzero(apart)
                parts = [(s, cold[at]) for s, at in _by_shard(key[cold], shards)] if len(cold) else []
                held = np.cumsum(size[warm]) // HOT_ROW_BYTES
                parts += [(-2 - int(h), warm[held == h]) for h in np.unique(held)]
                tags = (mix(mix(key) + np.uint64(1)) >> np.uint64(32)).astype("<u4")
                for shard, at in parts:
                    rows.append((shard, doc[at], first[at], size[at], tags[at],
                                 b"".join([text[a:b] for a, b in zip(start[at].tolist(), (start[at] + size[at]).tolist())])))
                yield _segment_rows(row["pack"], rows)

    return own.select("pack", "ids", "sizes", "texts", "keys", "hot").mapInArrow(
        released(run), "shard int, pack bigint, docs binary, firsts binary, sizes binary, tags binary, bytes binary")


def _segment_rows(pack: int, rows: list[tuple]) -> pa.RecordBatch:
    columns = [[None if x is None else _squeeze(x if isinstance(x, bytes) else x.tobytes()) for x in c]
               for c in list(zip(*rows))[1:]]
    return pa.RecordBatch.from_arrays(
        [pa.array([r[0] for r in rows], pa.int32()), pa.array([pack] * len(rows), pa.int64())]
        + [pa.array(c, pa.binary()) for c in columns],
        names=["shard", "pack", "docs", "firsts", "sizes", "tags", "bytes"])


def _segments(row: dict) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """Segments, doc ids and first windows of a stored row."""
    edges = np.concatenate([[0], np.cumsum(np.frombuffer(_expand(row["sizes"]), "<i8"))])
    raw = _expand(row["bytes"])
    return ([raw[a:b] for a, b in zip(edges[:-1], edges[1:])],
            np.frombuffer(_expand(row["docs"]), "<i8"), np.frombuffer(_expand(row["firsts"]), "<i8"))


class Shard:
    """Rows of a key shard, kept in a local file from ``limit`` bytes on."""

    FIELDS = ("docs", "firsts", "sizes", "tags", "bytes")

    def __init__(self, limit: int):
        self.file = tempfile.SpooledTemporaryFile(limit)
        self.rows: list[tuple] = []
        self.limit, self.held = limit, 0

    def add(self, row: dict) -> None:
        held = int(np.frombuffer(_expand(row["sizes"]), "<i8").sum())
        self.rows.append((row["pack"], self.file.tell(), [len(row[f]) for f in self.FIELDS], held))
        self.held += held
        for f in self.FIELDS:
            self.file.write(row[f])

    def _chunks(self):
        """(columns pack, document, first window, size, tag; segments) in turn, about ``limit`` bytes each."""
        columns, segs, held = [], [], 0
        for k, (pack, at, sizes, size) in enumerate(self.rows):
            self.file.seek(at)
            row = {f: self.file.read(n) for f, n in zip(self.FIELDS, sizes)}
            own, doc, first = _segments(row)
            tag = np.frombuffer(_expand(row["tags"]), "<u4")
            columns.append(np.stack([np.full(len(own), pack), doc, first, [len(x) for x in own], tag]).astype("<i8"))
            segs += own
            held += size
            if held >= self.limit or k == len(self.rows) - 1:
                yield np.concatenate(columns, 1), segs
                columns, segs, held = [], [], 0

    def blocks(self):
        """(packs, docs, firsts, segments) of whole keys, about ``limit`` bytes each."""
        n = max(1, -(-self.held // self.limit))
        parts: list[list] = [[] for _ in range(n)]
        with tempfile.SpooledTemporaryFile(self.limit) as cut:
            for columns, segs in self._chunks():
                block = columns[4] % n
                order = np.argsort(block, kind="stable")
                edges = np.searchsorted(block[order], np.arange(n + 1))
                for k in range(n):
                    at = order[edges[k]:edges[k + 1]]
                    if len(at):
                        parts[k].append((cut.tell(), len(at), int(columns[3, at].sum())))
                        cut.write(columns[:, at].tobytes())
                        cut.write(b"".join([segs[i] for i in at.tolist()]))
            self.file.close()
            for block in parts:
                columns, segs = [], []
                for at, m, size in block:
                    cut.seek(at)
                    columns.append(np.frombuffer(cut.read(40 * m), "<i8").reshape(5, m))
                    raw = cut.read(size)
                    ends = np.cumsum(columns[-1][3]).tolist()
                    segs += [raw[a:b] for a, b in zip([0, *ends], ends)]
                if segs:
                    yield *np.concatenate(columns, 1)[:3], segs


def _spans(flag: np.ndarray, doc: int, first: int) -> list[tuple]:
    edge = np.flatnonzero(np.diff(np.concatenate([[0], flag.astype(np.int8), [0]])))
    return [(doc, first + int(a), int(b - a)) for a, b in zip(edge[::2], edge[1::2])]


def _span_rows(pack: int, rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([pack], pa.int64()),
         pa.array([_squeeze(np.array(rows, "<i8").tobytes())], pa.binary())], names=["pack", "spans"])


def removed_windows(segments: DataFrame, shards: int, limit: int = QUEUE_ITEMS) -> DataFrame:
    """(pack, spans): flattened (doc_id, first window, windows) to remove."""
    def settle(shard):
        found = []
        for packs, docs, firsts, segs in shard.blocks():
            text, size = b"".join(segs), np.array([len(x) for x in segs])
            start = np.cumsum(size) - size
            number = equal_strings(text, start, size)
            order = np.lexsort((docs, number))
            begins = np.concatenate([[True], number[order][1:] != number[order][:-1]])
            top = np.empty(len(segs), np.int64)
            top[order] = order[np.flatnonzero(begins)[np.cumsum(begins) - 1]]
            whole = docs[top] < docs
            found.append(np.stack([packs, docs, firsts, size - (WINDOW - 1)], 1)[whole])
            chosen = np.unique(top)
            text = b"".join([segs[k] for k in chosen.tolist()])
            chosen = chosen[may_share(text, np.cumsum(size[chosen]) - size[chosen], size[chosen])]
            marks = dict(zip(chosen.tolist(), equal_windows([segs[k] for k in chosen.tolist()], docs[chosen], limit)
                             if len(chosen) else ()))
            marks = {k: m for k, m in marks.items() if m.any()}
            rest = np.flatnonzero(~whole & np.isin(top, np.fromiter(marks, np.int64, len(marks))))
            rows = [(int(packs[k]), *span) for k in rest for span in _spans(marks[int(top[k])], int(docs[k]), int(firsts[k]))]
            if rows:
                found.append(np.array(rows, np.int64))
        found = np.concatenate(found) if found else np.empty((0, 4), np.int64)
        found = found[np.argsort(found[:, 0], kind="stable")]
        cuts = np.flatnonzero(np.diff(found[:, 0])) + 1
        parts = [x for x in np.split(found, cuts) if len(x)]
        if parts:
            yield pa.RecordBatch.from_arrays(
                [pa.array([int(x[0, 0]) for x in parts], pa.int64()),
                 pa.array([_squeeze(x[:, 1:].astype("<i8").tobytes()) for x in parts], pa.binary())], names=["pack", "spans"])

    def sort(batches):  # rows come shard by shard
        now, shard = None, None
        for batch in batches:
            for row in batch.to_pylist():
                if row["shard"] != now:
                    if shard:
                        yield from settle(shard)
                    now, shard = row["shard"], Shard(BLOCK_BYTES)
                shard.add(row)
        if shard:
            yield from settle(shard)

    def settled(batches):
        for batch in batches:
            for row in batch.to_pylist():
                cols = [np.frombuffer(_expand(row[c]), "<i8") for c in ("docs", "firsts", "sizes")]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["pack"]], pa.int64()),
                     pa.array([_squeeze(np.stack(cols, 1).tobytes())], pa.binary())], names=["pack", "spans"])

    return segments.filter("shard >= 0").repartition(shards, "shard").sortWithinPartitions("shard").mapInArrow(
        released(sort), "pack bigint, spans binary").unionByName(
        segments.filter("shard = -1").mapInArrow(settled, "pack bigint, spans binary")).unionByName(
        hot_windows(segments.filter("shard < -1")))


def hot_windows(segments: DataFrame) -> DataFrame:
    """(pack, spans) of the segments of hot keys, window by window."""
    def smallest(row: dict):
        segs, docs, firsts = _segments(row)
        least: dict[bytes, int] = {}
        for seg, doc in zip(segs, docs.tolist()):
            for k in range(len(seg) - WINDOW + 1):
                w = seg[k:k + WINDOW]
                if least.get(w, doc) >= doc:
                    least[w] = doc
        return segs, docs, firsts, least

    def split(batches):
        for batch in batches:
            for row in batch.to_pylist():
                least = smallest(row)[3]
                n = len(least)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["pack"]] * n, pa.int64()), pa.array([row["shard"]] * n, pa.int32()),
                     pa.array(list(least), pa.binary()), pa.array(list(least.values()), pa.int64())],
                    names=["pack", "shard", "window", "doc"])

    windows = segments.mapInArrow(released(split), "pack bigint, shard int, window binary, doc bigint")
    least = stored(windows.groupBy("window").agg(F.min("doc").alias("least"), F.count(F.lit(1)).alias("n"))
                   .filter("n > 1").select("window", "least"), "hot-windows")
    answers = (windows.join(broadcast_if_small(least), "window").filter("least < doc").groupBy("pack", "shard")
               .agg(F.collect_list("window").alias("windows"), F.collect_list("least").alias("leasts")))

    def settle(batches):
        for batch in batches:
            for row in batch.to_pylist():
                segs, docs, firsts, least = smallest(row)
                least.update(zip(row["windows"] or [], row["leasts"] or []))
                out = []
                for seg, doc, first in zip(segs, docs.tolist(), firsts.tolist()):
                    flag = np.array([least[seg[k:k + WINDOW]] < doc for k in range(len(seg) - WINDOW + 1)])
                    out += _spans(flag, doc, first)
                if out:
                    yield _span_rows(row["pack"], out)

    return segments.join(answers, ["pack", "shard"], "left").mapInArrow(
        released(settle), "pack bigint, spans binary")


def cut(packs: DataFrame, spans: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept bytes of every packed document."""
    own = packs.join(spans.groupBy("pack").agg(F.collect_list("spans").alias("spans")), "pack", "left")

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                ids, raw = _unpack(row["ids"], row["sizes"], row["texts"])
                rows = np.concatenate([np.frombuffer(_expand(s), "<i8").reshape(-1, 3)
                                       for s in row["spans"] or []] or [np.empty((0, 3), np.int64)])
                rows = rows[np.argsort(rows[:, 0], kind="stable")]
                out = []
                for doc, text in zip(ids, raw):
                    a, b = np.searchsorted(rows[:, 0], [doc, doc + 1])
                    out.append((int(doc), *kept(text, rows[a:b, 1], rows[a:b, 2])))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.int64(), pa.int64(), pa.int64(),
                                                                pa.binary()))],
                    names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])

    return own.select("ids", "sizes", "texts", "spans").mapInArrow(
        released(run), "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept binary")


def kept(text: bytes, first: np.ndarray, count: np.ndarray) -> tuple[int, int, int, bytes]:
    """Bytes, removed bytes, removed runs and remaining bytes of a text."""
    edge = np.zeros(len(text) + 1, np.int64)
    np.add.at(edge, first, 1)
    np.add.at(edge, first + count + WINDOW - 1, -1)
    gone = np.cumsum(edge[:-1]) > 0
    runs_ = int(np.count_nonzero(np.diff(np.concatenate([[0], gone.astype(np.int8)])) == 1))
    left = np.frombuffer(text, np.uint8)[~gone].tobytes() if runs_ else text
    return len(text), int(gone.sum()), runs_, left


def shards_for(total: int, partitions: int) -> int:
    """Key shards of ``total`` bytes of text."""
    return max(1, min(partitions, FEW_SHARDS), -(-total // SHARD_BYTES))


def deduplicated(docs: DataFrame, text: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept (remaining bytes) of every
    row; for a copy under 50 bytes ``kept`` is NULL and ``digest`` that of
    its whole text."""
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"),
                       F.coalesce(F.col(text), F.lit("")).alias("text"))
    full = rows.filter(F.col("doc_id").isNotNull())
    digest = F.unhex(F.sha2("text", 256)).alias("digest")
    ids = stored(full.select("doc_id", digest, F.octet_length("text").cast("bigint").alias("n_bytes")), "text-ids")
    total = ids.agg(F.sum("n_bytes")).first()[0] or 0
    shards = shards_for(total, shuffle_partitions(docs))
    first = ids.groupBy("digest").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    copies = stored(ids.join(broadcast_if_small(first.select("digest", "first")), "digest").filter(
        "doc_id > first").select("doc_id", "digest", "n_bytes"), "text-copies")
    single = full.withColumn("digest", digest).join(
        broadcast_if_small(copies.select("doc_id", "digest")), ["doc_id", "digest"], "left_anti")
    packs = packs_of(single)
    spark = docs.sparkSession

    def segments() -> DataFrame:
        keys = settled(spark, "shared-keys", lambda: shared_keys(packs, shards))
        return segments_of(packs, keys, shards)

    # Each step's tables and shuffle files go as soon as the next one is stored.
    spans = settled(spark, "removed-windows", lambda: removed_windows(settled(spark, "segments", segments), shards))
    done = cut(packs, spans)
    goes = F.col("n_bytes") >= WINDOW
    whole = rows.filter(F.col("doc_id").isNull()).select("doc_id", F.octet_length("text").cast("bigint").alias("n_bytes"),
                                                         F.lit(0).cast("bigint").alias("n_removed"),
                                                         F.lit(0).cast("bigint").alias("n_spans"),
                                                         F.encode("text", "UTF-8").alias("kept"))
    gone = copies.select("doc_id", "n_bytes", F.when(goes, F.col("n_bytes")).otherwise(0).alias("n_removed"),
                         goes.cast("bigint").alias("n_spans"), F.when(goes, F.lit(b"")).alias("kept"), "digest")
    return done.withColumn("digest", F.lit(None).cast("binary")).unionByName(
        whole.withColumn("digest", F.lit(None).cast("binary"))).unionByName(gone)


def op3(docs: DataFrame) -> DataFrame:
    return deduplicated(docs).select(
        "doc_id", "n_bytes", "n_removed", "n_spans",
        F.when(F.col("kept").isNull(), F.lower(F.hex("digest"))).otherwise(F.sha2("kept", 256)).alias("kept_sha256"))


def brute_force(docs: list[tuple]) -> dict:
    """(doc_id, text) -> digest columns, for tests."""
    raw = [(d, (t or "").encode()) for d, t in docs]
    least: dict[bytes, int] = {}
    for d, b in raw:
        for i in range(len(b) - WINDOW + 1 if d is not None else 0):
            s = b[i:i + WINDOW]
            least[s] = min(least.get(s, d), d)
    out = {}
    for d, b in raw:
        gone = bytearray(len(b))
        for i in range(len(b) - WINDOW + 1 if d is not None else 0):
            if least[b[i:i + WINDOW]] < d:
                gone[i:i + WINDOW] = b"\1" * WINDOW
        left = bytes(x for x, g in zip(b, gone) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out[d] = (len(b), sum(gone), spans, hashlib.sha256(left).hexdigest())
    return out
