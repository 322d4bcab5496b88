"""Best-fit packing by a configuration linear program.

Pieces of at most ``SEQUENCE`` tokens are counted per length (at most
``SEQUENCE`` counts, however large the corpus).  A configuration is a
multiset of lengths that fits a sequence; the program covers all counts
with as few configurations as it can.  Multiplicative weights raise the
price of lengths that lag behind in coverage, and a knapsack dynamic
program finds the best-priced configuration of each round; the prices
also bound from below what any cover needs.  The solution is rounded down
to whole sequences, what is left is solved again, and the rest goes best
fit into open sequences, by length and count.  Where counts are spread so
thin over lengths that rounding costs more than it gains, best fit alone
is taken.  Pieces then get numbers
within their length, and the number alone tells sequence and offset, so
no task holds more than a share of a length.

Defined cases: NULL or empty text is one piece with the end id; only
documents longer than a sequence are cut; a NULL id is packed as any
other; rows that repeat an id are packed each; no documents give no rows.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import map_batches, released, stored, texts_of
from .tokens import encoder

SEQUENCE = 4096
END_ID = 1
#: Rounds of a phase, steps of multiplicative weights in a round, the phases'
#: step sizes, and the gap between cover and lower bound at which they end.
ROUNDS = 12
STEPS = 2000
RATES = (0.1, 0.03, 0.01, 0.003, 0.001)
GAP = 0.005
#: Beyond so many lengths a round has fewer steps and one knapsack, and what
#: rounding leaves is not solved again.
FEW = 512
#: Knapsacks of a round with changed prices, and configurations of best fit to start from.
CHANGED = 4
MOST_KNOWN = 2000
#: Pieces of text a worker's encoder remembers, and characters it looks up
#: together: packing may follow stages that left the executor little memory.
KNOWN_PIECES = 150_000
GROUP_CHARS = 1 << 18
#: Pieces of one length that one task numbers, about.
NUMBERED = 200_000

Pattern = tuple[tuple[int, int], ...]


def pieces_of(docs: DataFrame, vocabulary: str, sequence: int = SEQUENCE,
              end_id: int = END_ID) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of every document."""
    tail = np.array([end_id], "<u4").tobytes()

    def run(batches):
        known = encoder(vocabulary, KNOWN_PIECES, GROUP_CHARS)
        for whole in batches:
            for first in range(0, whole.num_rows, 512):
                batch = whole.slice(first, 512)
                rows, piece, start, length, crc = [], [], [], [], []
                for k, ids in enumerate(known.ids(texts_of(batch))):
                    ids += tail
                    for p, at in enumerate(range(0, len(ids), 4 * sequence)):
                        part = ids[at:at + 4 * sequence]
                        rows.append(k)
                        piece.append(p)
                        start.append(at // 4)
                        length.append(len(part) // 4)
                        crc.append(zlib.crc32(part))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(rows, pa.int64())), pa.array(piece, pa.int32()),
                     pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())],
                    names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(
        released(run), "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint")


def best_configuration(price: np.ndarray, capacity: int) -> Pattern:
    """Knapsack with repetition: the lengths (1..capacity) of largest total price."""
    value = np.zeros(capacity + 1)
    last = np.zeros(capacity + 1, np.int64)
    for c in range(1, capacity + 1):
        got = value[c - 1::-1] + price[1:c + 1]  # length k leaves value[c - k]
        k = int(got.argmax())
        value[c], last[c] = got[k], k + 1
        if value[c - 1] >= value[c]:
            value[c], last[c] = value[c - 1], 0
    found: dict[int, int] = {}
    c = capacity
    while c > 0:
        if last[c] == 0:
            c -= 1
        else:
            found[int(last[c])] = found.get(int(last[c]), 0) + 1
            c -= int(last[c])
    return tuple(sorted(found.items(), reverse=True))


class Pool:
    """Configurations found so far, as a sparse matrix of lengths x configurations."""

    def __init__(self, demand: dict[int, float]):
        self.place = {k: i for i, k in enumerate(demand)}
        self.demand = np.array(list(demand.values()), float)
        self.found: dict[Pattern, int] = {}
        self.index: list[np.ndarray] = []
        self.count: list[np.ndarray] = []

    def add(self, config: Pattern) -> None:
        if config and config not in self.found:
            self.found[config] = len(self.found)
            self.index.append(np.array([self.place[k] for k, _ in config]))
            self.count.append(np.array([float(n) for _, n in config]))

    def flat(self):
        """(length index, count, share of the length's count, first entry of each configuration)."""
        index, count = np.concatenate(self.index), np.concatenate(self.count)
        first = np.concatenate([[0], np.cumsum([len(x) for x in self.index])])
        return index, count, count / self.demand[index], first


def cover(counts: dict[int, int], capacity: int, rounds: int = ROUNDS) -> tuple[dict[Pattern, float], float]:
    """(fractional use of configurations that covers all counts, lower bound).

    Multiplicative weights in phases of finer and finer steps: a step uses
    the best-priced configuration known, and the prices of its lengths fall
    by how much of their counts it covers.  A round prices all multisets by
    a knapsack, once as the prices are and a few times with small random
    changes, which gives new configurations; at the prices as they are it
    also gives the bound (the demand's price over the best price of one
    sequence is what any cover needs at least).  Configurations of best fit
    are known from the start, and a phase counts its own uses only.  The
    last phase ends when cover and bound are within ``GAP``.
    """
    lengths = np.array(sorted(counts), np.int64)
    demand = np.array([counts[int(k)] for k in lengths], float)
    pool = Pool({int(k): counts[int(k)] for k in lengths})
    for k in lengths:  # each length alone: every count can be covered
        pool.add(((int(k), capacity // int(k)),))
    for pattern, _ in best_fit(counts, capacity)[:MOST_KNOWN]:
        pool.add(_merged(pattern))
    few = len(lengths) <= FEW
    rng = np.random.default_rng(1)
    price_of = lengths / demand  # per piece
    best, bound = None, float((lengths * demand).sum() / capacity)
    price = np.full(capacity + 1, -1.0)
    for rate in RATES:
        use = np.zeros(0)
        for _ in range(rounds):
            price[lengths] = price_of / price_of.max()
            config = best_configuration(price, capacity)
            pool.add(config)
            bound = max(bound, float((price[lengths] * demand).sum() / sum(n * price[k] for k, n in config)))
            for _ in range(CHANGED if few else 0):
                price[lengths] = price_of / price_of.max() * (1 + 0.02 * rng.random(len(lengths)))
                pool.add(best_configuration(price, capacity))
            index, count, share, first = pool.flat()
            use = np.concatenate([use, np.zeros(len(pool.found) - len(use))])
            size = rate / np.maximum.reduceat(share, first[:-1])  # sequences of one step
            fall = np.exp(-share * np.repeat(size, np.diff(first)))
            for _ in range(STEPS if few else STEPS // 16):
                j = int(np.add.reduceat(price_of[index] * count, first[:-1]).argmax())
                use[j] += size[j]
                own = slice(first[j], first[j + 1])
                price_of[index[own]] *= fall[own]
            price_of = price_of / price_of.max()
            covered = np.bincount(index, count * np.repeat(use, np.diff(first)), len(lengths))
            total = use.sum() * (demand / np.maximum(covered, 1e-12)).max()
            if best is None or total < best[0]:
                best = (total, use * (total / use.sum()))
            if best[0] <= (1 + GAP) * bound:
                break
    patterns = list(pool.found)
    return {patterns[j]: float(best[1][j]) for j in np.flatnonzero(best[1])}, bound


def _merged(pattern: Pattern) -> Pattern:
    found: dict[int, int] = {}
    for k, n in pattern:
        found[k] = found.get(k, 0) + n
    return tuple(sorted(found.items(), reverse=True))


def best_fit(counts: dict[int, int], capacity: int) -> list[tuple[Pattern, int]]:
    """Best fit decreasing on counts: equal pieces go into equal sequences at once."""
    open_at: dict[int, list] = {}  # room -> [pattern as list of (length, n), sequences]
    rooms: list[int] = []
    for k in sorted(counts, reverse=True):
        left = counts[k]
        while left:
            at = bisect_left(rooms, k)
            if at == len(rooms):
                per = capacity // k
                full, rest = divmod(left, per)
                for n, times in ((per, full), (rest, 1)):
                    if n and times:
                        _open(open_at, rooms, capacity - n * k, [(k, n)], times)
                left = 0
                break
            room = rooms[at]
            pattern, times = open_at[room].pop()
            if not open_at[room]:
                del open_at[room], rooms[at]
            per = min(room // k, left)
            used = min(times, left // per)
            _open(open_at, rooms, room - per * k, pattern + [(k, per)], used)
            if times > used:
                _open(open_at, rooms, room, pattern, times - used)
            left -= per * used
    return [(tuple(p), n) for groups in open_at.values() for p, n in groups]


def _open(open_at: dict, rooms: list, room: int, pattern: list, times: int) -> None:
    if room not in open_at:
        insort(rooms, room)
        open_at[room] = []
    open_at[room].append((pattern, times))


def rounded(counts: dict[int, int], capacity: int) -> tuple[list[tuple[Pattern, int]], int]:
    """(sequences by the program, pieces that it places): its solution cut to
    whole sequences, again for what is left until that places little, then
    best fit."""
    left, out, placed, every = dict(counts), [], 0, sum(counts.values())
    while left:
        before = placed
        for config, amount in sorted(cover(left, capacity)[0].items(), key=lambda x: -x[1]):
            times = min([int(amount + 1e-9)] + [left[k] // n for k, n in config])
            if times > 0:
                out.append((config, times))
                placed += times * sum(n for _, n in config)
                for k, n in config:
                    left[k] -= n * times
        left = {k: n for k, n in left.items() if n}
        if placed - before < 0.2 * every or len(left) > FEW:
            break
    return out + best_fit(left, capacity), placed


def solve(counts: dict[int, int], capacity: int = SEQUENCE) -> list[tuple[Pattern, int]]:
    """(configuration, sequences) that hold exactly all pieces: the rounded
    program, or best fit alone where that needs fewer sequences."""
    left = {k: n for k, n in counts.items() if n}
    whole = left.pop(capacity, 0)
    out: list[tuple[Pattern, int]] = [(((capacity, 1),), whole)] if whole else []
    if not left:
        return out
    return out + min(rounded(left, capacity)[0], best_fit(left, capacity), key=lambda s: sum(n for _, n in s))


class Places:
    """Sequence and offset of the r-th piece of a length."""

    def __init__(self, solution: list[tuple[Pattern, int]]):
        rows: dict[int, list] = {}
        taken: dict[int, int] = {}
        base = 0
        for pattern, times in solution:
            offset = 0
            for k, n in pattern:
                first = taken.get(k, 0)
                rows.setdefault(k, []).append((first, n, base, offset))
                taken[k] = first + n * times
                offset += k * n
            base += times
        self.rows = {k: np.array(v, np.int64) for k, v in rows.items()}
        self.sequences = base

    def of(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        seq, off = np.zeros(len(rank), np.int64), np.zeros(len(rank), np.int64)
        for k in np.unique(length):
            at = np.flatnonzero(length == k)
            first, n, base, offset = self.rows[int(k)].T
            j = np.searchsorted(first, rank[at], side="right") - 1
            inside = rank[at] - first[j]
            seq[at] = base[j] + inside // n[j]
            off[at] = offset[j] + inside % n[j] * k
        return seq, off


def numbered(pieces: DataFrame, total: int) -> DataFrame:
    """Add ``rank``: 0, 1, 2, ... within each length.

    A length is numbered in shares, each by its own task: a piece's share
    is a hash of its row, so a retried task numbers alike.
    """
    shares = max(8, min(4096, -(-total // NUMBERED)))
    rows = pieces.withColumn("share", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(shares)))
    sizes = rows.groupBy("length", "share").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("length").orderBy("share").rowsBetween(Window.unboundedPreceding, -1)
    base = sizes.select("length", "share", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    inside = Window.partitionBy("length", "share").orderBy("doc_id", "piece", "ids_crc32")
    return (rows.withColumn("_n", F.row_number().over(inside)).join(base, ["length", "share"])
            .withColumn("rank", (F.col("base") + F.col("_n") - 1).cast("bigint"))
            .drop("share", "_n", "base"))


def pack(docs: DataFrame, vocabulary: str, sequence: int = SEQUENCE, end_id: int = END_ID) -> DataFrame:
    """Pieces with sequence_id and offset."""
    pieces = stored(pieces_of(docs, vocabulary, sequence, end_id), "pieces")
    # At most ``sequence`` rows reach the driver.
    counts = {r["length"]: r["n"] for r in
              pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    places = docs.sparkSession.sparkContext.broadcast(Places(solve(counts, sequence)))

    def run(batch):
        length, rank = (np.asarray(batch.column(batch.schema.get_field_index(c)))
                        for c in ("length", "rank"))
        seq, off = places.value.of(length, rank)
        return {"sequence_id": pa.array(seq, pa.int64()), "offset": pa.array(off, pa.int64())}

    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    return map_batches(numbered(pieces, sum(counts.values())), run, "sequence_id bigint, `offset` bigint",
                       keep=columns)
