"""Embedding near-dedup on a robust-pruned flat graph over cluster shards.

1. Vectors of equal direction become one node with a number of copies.
2. Shards: k-means on a bounded sample; every node goes into the
   ``OVERLAP`` shards it is nearest to.  A shard that is too large is
   split by k-means of its own sample, and so on, so that a dense region
   that holds a third of all rows spreads over many shards.
3. Build: in each shard a node's pool (near nodes, some random ones, and
   nodes that point at it) is cut by robust pruning: a node is dropped if
   a kept one is nearer to it by the factor ``ALPHA``.
4. The adjacency lists of a node from all its shards are united.
5. Search: in each shard every node looks for its range by greedy beam
   search from the shard's medoids; then all nodes found within the
   (slightly widened) range are expanded until no new one appears.
   Candidates are verified by cosine in double precision.
6. Visits: where a node has links to members of a shard it is not in, it
   is searched there too, round by round until no shard is new, so a dense
   region larger than a shard is covered.
7. A pair counts once, in the smallest shard where it can meet; what
   leaves a task is a count and tree edges, at most one per node and one
   per visitor, never pairs.  The trees are joined to components.
8. Audit: links of a bounded sample of nodes are counted by brute force
   against all nodes.  If fewer than ``RECALL`` of them were found, all is
   built again with one more shard per node (up to ``MOST_OVERLAP``).

Defined cases: NULL, empty and zero vectors, vectors with NULL or
non-finite components, and rows without id link with nothing; shorter
vectors count as padded with zeros; rows that repeat an id are vectors of
their own (each counts as another's link); directions that agree to 12
decimals are copies, which all link with each other; only the named
columns are looked at.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.joins import broadcast_if_small
from .common import map_batches, released, stored
from .components import connected
from .vectors import centroids, dimension, matrix, unit

THRESHOLD = 0.95
#: Shards of a node, at first and at most.
OVERLAP, MOST_OVERLAP = 2, 4
#: Nodes wanted in a shard; a shard beyond ``LARGEST`` is split again.
SHARD, LARGEST = 2_000, 4_096
#: Bounds of a k-means: vectors and bytes of its sample, centroids.
SAMPLE, SAMPLE_BYTES, CHILDREN = 16_384, 32 << 20, 256
#: Rows of a large shard that one task places anew at a time.
PLACED = 65_536
#: Splits of splits; after the last one nodes go by hash.
LEVELS = 6
#: Graph: out-degree, pruning factor, pool of near, random and incoming nodes.
DEGREE, ALPHA, NEAR, FAR, INCOMING = 24, 1.2, 32, 16, 32
#: Search: beam, entry medoids, cosine below the threshold that still expands.
BEAM, MEDOIDS, MARGIN = 16, 8, 0.05
#: Queries searched at once.
QUERIES = 512
#: Audit: nodes of the sample, and the share of their links to find.
AUDITED, RECALL = 512, 0.97


# -- nodes and shards ---------------------------------------------------------

def keyed(rows: DataFrame, dim: int) -> DataFrame:
    """(vec_id, embedding, key): key NULL for vectors that link with nothing."""
    def run(batch):
        x, ok = matrix(batch.column(batch.schema.get_field_index("embedding")), dim)
        direction, has = unit(np.where(ok[:, None], x, 0.0))
        rounded = np.round(direction, 12) + 0.0
        keys = [hashlib.blake2b(v.tobytes(), digest_size=16).digest() if good else None
                for v, good in zip(rounded, ok & has)]
        return {"key": pa.array(keys, pa.binary())}

    own = rows.select(F.col("vec_id").cast("bigint").alias("vec_id"), "embedding")
    return map_batches(own, run, "key binary", keep=["vec_id", "embedding"])


def nodes_of(rows: DataFrame, dim: int) -> DataFrame:
    """(node, key, vec, copies, least): one row per direction."""
    usable = keyed(rows, dim).filter("key IS NOT NULL AND vec_id IS NOT NULL")
    return stored(usable.groupBy("key").agg(
        F.min_by("embedding", "vec_id").alias("vec"), F.count(F.lit(1)).alias("copies"),
        F.min("vec_id").alias("least")).withColumn("node", F.monotonically_increasing_id()), "vec-nodes")


def sample_size(dim: int) -> int:
    return max(64, min(SAMPLE, SAMPLE_BYTES // (8 * max(dim, 1))))


def children(size: int, share: int) -> int:
    """Shards to make of ``size`` members."""
    return min(CHILDREN, max(2, math.ceil(size / share)))


def directions(column: pa.Array, dim: int, kind=np.float32) -> np.ndarray:
    return unit(matrix(column, dim)[0])[0].astype(kind)


def first_shards(nodes: DataFrame, dim: int, count: int, overlap: int) -> DataFrame:
    """members (cell, node, vec, copies): every node in its nearest cells."""
    columns = ["node", "vec", "copies"]
    if count <= SHARD:
        return stored(nodes.select(F.lit(0).cast("bigint").alias("cell"), *columns), "vec-members")
    some = nodes.select("vec", F.xxhash64("key").alias("h")).orderBy("h").limit(sample_size(dim)).select("vec").toArrow()
    found = centroids(directions(some.column("vec"), dim), children(count * overlap, SHARD))
    sent = nodes.sparkSession.sparkContext.broadcast(found)

    def run(batches):
        for batch in batches:
            near = directions(batch.column(1), dim) @ sent.value.T
            most = min(overlap, near.shape[1])
            top = np.argpartition(-near, most - 1, axis=1)[:, :most]
            row = pa.array(np.repeat(np.arange(batch.num_rows), most))
            yield pa.RecordBatch.from_arrays([pa.array(top.ravel().astype(np.int64)), *[
                batch.column(i).take(row) for i in range(3)]], names=["cell", *columns])

    schema = nodes.select(F.lit(0).cast("bigint").alias("cell"), *columns).schema
    return stored(nodes.select(*columns).mapInArrow(released(run), schema), "vec-members")


def split_large(members: DataFrame, dim: int, largest: int = LARGEST, share: int = SHARD) -> DataFrame:
    """Members with every cell of at most ``largest`` nodes, about."""
    schema = members.schema
    for level in range(LEVELS + 1):
        big = members.groupBy("cell").agg(F.count(F.lit(1)).alias("size")).filter(F.col("size") > largest)
        if big.isEmpty():
            return members
        big = stored(big, "vec-large")
        rest = members.join(broadcast_if_small(big), "cell", "left_anti")
        inside = members.join(broadcast_if_small(big), "cell")
        if level == LEVELS:  # vectors so close that no k-means tells them apart
            by_hash = (F.col("cell") * CHILDREN + F.pmod(F.xxhash64("node"), F.ceil(F.col("size") / share)))
            inside = inside.withColumn("cell", by_hash.cast("bigint")).select(*schema.names)
            return stored(rest.select(*schema.names).unionByName(inside), "vec-members")
        w = Window.partitionBy("cell").orderBy(F.xxhash64("node"))
        some = inside.select("cell", "size", "node", "vec").withColumn("r", F.row_number().over(w)).filter(
            F.col("r") <= sample_size(dim) // 4)

        def learn(table):
            k = children(table.column("size")[0].as_py(), share)
            found = centroids(directions(table.column("vec"), dim), k)
            return pa.table({"cell": table.column("cell")[:1], "centroids": pa.array(
                [found.ravel()], pa.list_(pa.float32()))})

        learnt = stored(some.groupBy("cell").applyInArrow(learn, "cell bigint, centroids array<float>"), "vec-centroids")
        parts = F.ceil(F.col("size") / PLACED).cast("bigint")
        models = learnt.join(big, "cell").select("cell", F.explode(F.sequence(
            F.lit(0).cast("bigint"), parts - 1)).alias("part"), "centroids")  # a part without rows gives none
        rows = inside.withColumn("part", F.pmod(F.xxhash64("node"), parts)).drop("size")

        def place(left, right):
            if not left.num_rows:
                return left.select(schema.names)
            found = matrix(right.column("centroids"), len(right.column("centroids")[0]))[0].reshape(-1, dim)
            child = (directions(left.column("vec"), dim) @ found.astype(np.float32).T).argmax(axis=1)
            cell = np.asarray(left.column("cell")) * CHILDREN + child
            return left.set_column(left.schema.get_field_index("cell"), "cell", pa.array(cell, pa.int64())).select(
                schema.names)

        moved = rows.groupBy("cell", "part").cogroup(models.groupBy("cell", "part")).applyInArrow(place, schema)
        members = stored(rest.select(*schema.names).unionByName(moved), "vec-members")
    return members


# -- graph --------------------------------------------------------------------

def robust_prune(v: np.ndarray, own: np.ndarray, pool: np.ndarray) -> np.ndarray:
    """For nodes ``own``, their ``pool`` (indexes, -1: none) cut to ``DEGREE``.

    From near to far, a node is kept unless one kept before is ``ALPHA``
    times nearer to it than the owner is.
    """
    near = np.einsum("bkd,bd->bk", v[pool], v[own])
    near[(pool < 0) | (pool == own[:, None])] = -np.inf
    order = np.argsort(-near, axis=1, kind="stable")
    pool, near = np.take_along_axis(pool, order, 1), np.take_along_axis(near, order, 1)
    x = v[pool]
    away = 2 - 2 * (x @ x.transpose(0, 2, 1))
    mine = 2 - 2 * near
    alive = near > -np.inf
    kept = np.full((len(own), DEGREE), -1, np.int64)
    count = np.zeros(len(own), np.int64)
    for k in range(pool.shape[1]):
        take = np.flatnonzero(alive[:, k] & (count < DEGREE))
        if not len(take):
            continue
        kept[take, count[take]] = pool[take, k]
        count[take] += 1
        alive[take] &= ALPHA ** 2 * away[take, k] > mine[take]
    return kept


def incoming(adjacent: np.ndarray, v: np.ndarray) -> np.ndarray:
    """The nearest ``INCOMING`` nodes that point at each node (-1: none)."""
    m = len(adjacent)
    source, place = np.nonzero(adjacent >= 0)
    target = adjacent[source, place]
    near = np.einsum("ed,ed->e", v[source], v[target])
    order = np.lexsort((-near, target))
    source, target = source[order], target[order]
    rank = np.arange(len(target)) - np.searchsorted(target, target)
    out = np.full((m, INCOMING), -1, np.int64)
    keep = rank < INCOMING
    out[target[keep], rank[keep]] = source[keep]
    return out


def shard_graph(v: np.ndarray, seed: int = 0) -> np.ndarray:
    """Adjacency (nodes x ``DEGREE``, -1: none) of one shard."""
    m = len(v)
    if m < 2:
        return np.full((m, DEGREE), -1, np.int64)
    rng = np.random.default_rng(seed)
    pools = np.full((m, min(NEAR, m - 1) + FAR), -1, np.int64)
    for at in range(0, m, 512):
        near = v[at:at + 512] @ v.T
        rows = np.arange(len(near))
        near[rows, at + rows] = -np.inf
        some = min(NEAR, m - 1)
        pools[at:at + 512, :some] = np.argpartition(-near, some - 1, axis=1)[:, :some]
    pools[:, -FAR:] = rng.integers(0, m, (m, FAR))
    adjacent = pruned(v, pools)
    return pruned(v, np.concatenate([adjacent, incoming(adjacent, v), pools[:, -FAR // 2:]], axis=1))


def pruned(v: np.ndarray, pools: np.ndarray) -> np.ndarray:
    return np.concatenate([robust_prune(v, np.arange(at, min(at + 256, len(v))), pools[at:at + 256])
                           for at in range(0, len(v), 256)])


def medoids(v: np.ndarray) -> np.ndarray:
    """The node nearest to the mean, and those nearest to a few centroids."""
    middle = np.concatenate([v.mean(axis=0, keepdims=True), centroids(v, min(MEDOIDS - 1, len(v)), rounds=2)])
    return np.unique((middle @ v.T).argmax(axis=1))


def range_search(v: np.ndarray, adjacent: np.ndarray, entries: np.ndarray, queries: np.ndarray,
                 floor: float) -> np.ndarray:
    """(queries x nodes) whether a node of cosine ``floor`` and more was met.

    Greedy beam search from ``entries``, then every node met within the
    floor is expanded until nothing new is met.
    """
    n, m = len(queries), len(v)
    each = np.arange(n)
    seen, met, expanded = (np.zeros((n, m), bool) for _ in range(3))
    start = queries @ v[entries].T
    seen[:, entries] = True
    met[:, entries] = start >= floor
    width = max(BEAM, len(entries))
    ids, sims = np.full((n, width), -1, np.int64), np.full((n, width), -np.inf, np.float32)
    ids[:, :len(entries)], sims[:, :len(entries)] = entries, start
    open_ = sims > -np.inf

    def look(query, node):
        """Neighbours of ``node`` not yet seen by ``query``, with cosines."""
        around = adjacent[node]
        new = (around >= 0) & ~seen[query[:, None], around]
        near = np.einsum("ard,ad->ar", v[around], queries[query])
        near[~new] = -np.inf
        r, c = np.nonzero(new)
        seen[query[r], around[r, c]] = True
        r, c = np.nonzero(near >= floor)
        met[query[r], around[r, c]] = True
        return around, near

    while True:
        best = np.where(open_, sims, -np.inf).argmax(axis=1)
        act = np.flatnonzero(open_[each, best])
        if not len(act):
            break
        best = best[act]
        node = ids[act, best]
        open_[act, best] = False
        expanded[act, node] = True
        around, near = look(act, node)
        all_ids = np.concatenate([ids[act], around], axis=1)
        all_sims = np.concatenate([sims[act], near], axis=1)
        all_open = np.concatenate([open_[act], near > -np.inf], axis=1)
        top = np.argpartition(-all_sims, width - 1, axis=1)[:, :width]
        ids[act], sims[act], open_[act] = (np.take_along_axis(x, top, 1) for x in (all_ids, all_sims, all_open))
    while True:
        query, node = np.nonzero(met & ~expanded)
        if not len(query):
            return met
        for at in range(0, len(query), 16_384):
            q, u = query[at:at + 16_384], node[at:at + 16_384]
            expanded[q, u] = True
            look(q, u)


def local_graph(node: np.ndarray, near: list) -> np.ndarray:
    """United adjacency lists as indexes of this shard's nodes (ascending);
    neighbours that only live in other shards stay out."""
    m = len(node)
    flat = np.concatenate(near) if m else np.empty(0, np.int64)
    owner = np.repeat(np.arange(m), [len(x) for x in near])
    other = np.minimum(np.searchsorted(node, flat), m - 1)
    here = node[other] == flat
    owner, other = owner[here], other[here]
    rank = np.arange(len(owner)) - np.searchsorted(owner, owner)
    adjacent = np.full((m, int(rank.max(initial=0)) + 1), -1, np.int64)
    adjacent[owner, rank] = other
    return adjacent


def shard_links(vec: np.ndarray, adjacent: np.ndarray, queries: np.ndarray, threshold: float) -> np.ndarray:
    """(queries x nodes) links found in a shard, verified in double precision."""
    v, q32 = vec.astype(np.float32), queries.astype(np.float32)
    links = np.zeros((len(queries), len(vec)), bool)
    entries = medoids(v)
    for at in range(0, len(queries), QUERIES):
        met = range_search(v, adjacent, entries, q32[at:at + QUERIES], threshold - MARGIN)
        query, u = np.nonzero(met)
        for k in range(0, len(query), 65_536):
            q, w = query[k:k + 65_536] + at, u[k:k + 65_536]
            good = np.einsum("ed,ed->e", queries[q], vec[w]) >= threshold
            links[q[good], w[good]] = True
    return links


def trees(links: np.ndarray) -> np.ndarray:
    """The first node of each node's component."""
    root = np.full(len(links), -1, np.int64)
    for first in np.flatnonzero(links.any(axis=1)):
        if root[first] >= 0:
            continue
        reached = np.zeros(len(links), bool)
        reached[first] = True
        edge = np.array([first])
        while len(edge):
            new = np.zeros(len(links), bool)
            for at in range(0, len(edge), 512):
                new |= links[edge[at:at + 512]].any(axis=0)
            edge = np.flatnonzero(new & ~reached)
            reached[edge] = True
        root[reached] = first
    return np.where(root < 0, np.arange(len(links)), root)


def sets(column: pa.Array, known: np.ndarray) -> np.ndarray:
    """(rows x ``known``) whether a row's list holds the value."""
    lists = column.combine_chunks()
    row = np.repeat(np.arange(len(lists)), np.asarray(pc.fill_null(pc.list_value_length(lists), 0)))
    out = np.zeros((len(lists), len(known)), np.float32)
    out[row, np.searchsorted(known, np.asarray(lists.flatten()))] = 1
    return out


def values(*columns: pa.Array) -> np.ndarray:
    return np.unique(np.concatenate([np.asarray(c.combine_chunks().flatten(), np.int64) for c in columns]))


def lists_of(flags: np.ndarray, known: np.ndarray) -> pa.ListArray:
    """The reverse of ``sets``."""
    offsets = np.concatenate([[0], np.cumsum(flags.sum(axis=1))])
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(known[np.nonzero(flags)[1]], pa.int64()))


FOUND = "node bigint, links bigint, root bigint, visit array<bigint>"


def graph_of(members: DataFrame, dim: int) -> DataFrame:
    """Members with their united adjacency list and all their cells."""
    def build(table):
        table = table.sort_by("node")  # rows come in any order
        node = np.asarray(table.column("node"))
        adjacent = shard_graph(directions(table.column("vec"), dim), int(node[0]) & 0xFFFF)
        near = lists_of_rows(adjacent, node)
        return pa.table({"cell": table.column("cell"), "node": table.column("node"), "near": near})

    def lists_of_rows(adjacent, node):
        offsets = np.concatenate([[0], np.cumsum((adjacent >= 0).sum(axis=1))])
        return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(node[adjacent[adjacent >= 0]], pa.int64()))

    built = members.select("cell", "node", "vec").groupBy("cell").applyInArrow(
        build, "cell bigint, node bigint, near array<bigint>")
    united = built.groupBy("node").agg(F.array_distinct(F.flatten(F.collect_list("near"))).alias("near"),
                                       F.collect_set("cell").alias("cells"))
    return stored(members.join(united, "node"), "vec-graph")


def own_links(graph: DataFrame, dim: int, threshold: float) -> DataFrame:
    """``FOUND`` per node and shard: every node searched in its own shards.

    ``visit`` has the other shards that hold a linked node.
    """
    def search(table):
        table = table.sort_by("node")
        node, copies = np.asarray(table.column("node")), np.asarray(table.column("copies"))
        cell = table.column("cell")[0].as_py()
        vec = directions(table.column("vec"), dim, np.float64)
        adjacent = local_graph(node, [np.asarray(x, np.int64) for x in table.column("near").to_pylist()])
        links = shard_links(vec, adjacent, vec, threshold)
        links |= links.T
        np.fill_diagonal(links, False)
        root = trees(links)
        known = values(table.column("cells"))
        cells = sets(table.column("cells"), known)
        smaller = cells[:, known < cell]
        count, visit = np.zeros(len(node), np.int64), np.zeros(cells.shape, bool)
        for at in range(0, len(node), QUERIES):
            rows = links[at:at + QUERIES]
            visit[at:at + QUERIES] = (rows.astype(np.float32) @ cells > 0) & (cells[at:at + QUERIES] == 0)
            # A pair counts in the smallest of the shards that hold both.
            count[at:at + QUERIES] = (rows & (smaller[at:at + QUERIES] @ smaller.T == 0)) @ copies
        return pa.table({"node": pa.array(node), "links": pa.array(count, pa.int64()), "root": pa.array(node[root]),
                         "visit": lists_of(visit, known)})

    return graph.groupBy("cell").applyInArrow(search, FOUND)


def visit_links(graph: DataFrame, nodes: DataFrame, state: DataFrame, dim: int, threshold: float) -> DataFrame:
    """``FOUND`` of the nodes of ``state`` (node, cells, old, new) in the
    shards ``new``, which they visit.

    A link between nodes without a common shard counts, for both, in the
    smallest shard where one of them visits the other in the first such round.
    """
    guests = state.select("*", F.explode("new").alias("cell")).join(nodes.select("node", "vec", "copies"), "node")
    hosts = guests.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / LARGEST).cast("bigint").alias("parts"))
    guests = guests.join(hosts, "cell").withColumn("part", F.pmod(F.xxhash64("node"), "parts"))
    seats = graph.join(hosts, "cell").join(state.select("node", "old", "new"), "node", "left").withColumn(
        "part", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("parts") - 1)))
    columns = ["cell", "part", "node", "vec", "copies", "near", "cells", "old", "new"]
    both = seats.select(*columns, F.lit(False).alias("guest")).unionByName(guests.withColumn(
        "near", F.lit(None).cast("array<bigint>")).select(*columns, F.lit(True).alias("guest")))

    def search(table):
        guest = np.asarray(table.column("guest").combine_chunks().to_numpy(zero_copy_only=False), bool)
        if guest.all() or not guest.any():
            return pa.Table.from_batches([], pa.schema([("node", pa.int64()), ("links", pa.int64()),
                                                        ("root", pa.int64()), ("visit", pa.list_(pa.int64()))]))
        known = values(*[table.column(c) for c in ("cells", "old", "new")])
        cell = table.column("cell")[0].as_py()
        host, visitor = (table.filter(pa.array(x)).sort_by("node") for x in (~guest, guest))
        node, other = np.asarray(host.column("node")), np.asarray(visitor.column("node"))
        copies, more = np.asarray(host.column("copies")), np.asarray(visitor.column("copies"))
        h = [sets(host.column(c), known) for c in ("cells", "old", "new")]
        g = [sets(visitor.column(c), known) for c in ("cells", "old", "new")]
        vec = directions(host.column("vec"), dim, np.float64)
        adjacent = local_graph(node, [np.asarray(x, np.int64) for x in host.column("near").to_pylist()])
        links = shard_links(vec, adjacent, directions(visitor.column("vec"), dim, np.float64), threshold)
        before = known < cell
        count, back = np.zeros(len(other), np.int64), np.zeros(len(node), np.int64)
        visit = np.zeros(g[0].shape, bool)
        for at in range(0, len(other), QUERIES):
            now = slice(at, at + QUERIES)
            rows = links[now]
            done = g[0][now] @ (h[0] + h[1]).T + g[1][now] @ h[0].T
            earlier = g[2][now][:, before] @ h[0][:, before].T + g[0][now][:, before] @ h[2][:, before].T
            mine = rows & (done + earlier == 0)
            count[now] = mine @ copies
            back += more[now] @ mine
            visit[now] = (rows.astype(np.float32) @ h[0] > 0) & (g[0][now] + g[1][now] + g[2][now] == 0)
        a, b = forest(links)
        out = [(other, count, other, lists_of(visit, known)),
               (node, back, node, lists_of(np.zeros(h[0].shape, bool), known)),
               (other[a], np.zeros(len(a), np.int64), node[b], lists_of(np.zeros((len(a), len(known)), bool), known))]
        return pa.concat_tables([pa.table(dict(zip(("node", "links", "root", "visit"), map(pa.array, x)))) for x in out])

    return both.groupBy("cell", "part").applyInArrow(search, FOUND)


def forest(links: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges (row, column) of a spanning forest of a two-sided link matrix."""
    parent = np.arange(links.shape[1])

    def top(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    edges = []
    for row in np.flatnonzero(links.any(axis=1)):
        found = np.flatnonzero(links[row])
        while (parent[parent[found]] != parent[found]).any():
            parent[found] = parent[parent[found]]
        first = None
        for k in np.unique(parent[found], return_index=True)[1]:
            x = top(found[k])
            if first is None:
                edges.append((row, found[k]))
                first = x
            elif x != first:
                edges.append((row, found[k]))
                parent[x] = first
    a = np.array(edges, np.int64).reshape(-1, 2)
    return a[:, 0], a[:, 1]


def linked(members: DataFrame, nodes: DataFrame, dim: int, threshold: float) -> DataFrame:
    """``FOUND`` of all rounds: own shards first, then visits until no node
    has links into a shard that it has not been to."""
    graph = graph_of(members, dim)
    found = stored(own_links(graph, dim, threshold), "vec-links")
    everything, round_ = found, found
    none = F.array().cast("array<bigint>")
    past = None
    while True:
        new = round_.filter(F.size("visit") > 0).groupBy("node").agg(
            F.array_distinct(F.flatten(F.collect_list("visit"))).alias("new"))
        if past is None:
            cells = graph.select("node", "cells").dropDuplicates(["node"])
            state = new.join(cells, "node").withColumn("old", none)
        else:  # nodes that stay at home are known by where they have been
            state = past.join(new, "node", "left").withColumn("new", F.coalesce("new", none))
        state = stored(state.select("node", "cells", "old", "new"), "vec-visits")
        if state.filter(F.size("new") > 0).isEmpty():
            return everything
        round_ = stored(visit_links(graph, nodes, state, dim, threshold), "vec-links")
        everything = everything.unionByName(round_)
        past = state.select("node", "cells", F.concat("old", "new").alias("old"))


def audit(nodes: DataFrame, links: DataFrame, dim: int, threshold: float, sample: int = AUDITED) -> float:
    """Share of the links of sampled nodes that were found (1 without any)."""
    size = max(16, min(sample, SAMPLE_BYTES // (8 * max(dim, 1))))
    some = nodes.select("node", "vec", "copies", F.xxhash64("key", F.lit(1)).alias("h")).orderBy("h").limit(size).toArrow()
    if not some.num_rows:
        return 1.0
    own = np.asarray(some.column("node"))
    sent = nodes.sparkSession.sparkContext.broadcast((own, directions(some.column("vec"), dim, np.float64)))

    def run(batches):
        ids, queries = sent.value
        found = np.zeros(len(ids), np.int64)
        for batch in batches:
            near = queries @ directions(batch.column(1), dim, np.float64).T >= threshold
            near &= ids[:, None] != np.asarray(batch.column(0))
            found += near @ np.asarray(batch.column(2))
        yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(found)], names=["node", "true"])

    true = nodes.select("node", "vec", "copies").mapInArrow(released(run), "node bigint, true bigint").groupBy("node").agg(
        F.sum("true").alias("true"))
    got = broadcast_if_small(true).join(links, "node", "left").agg(
        F.sum("true"), F.sum(F.least("true", F.coalesce("links", F.lit(0))))).first()
    return got[1] / got[0] if got[0] else 1.0


def near_copies(rows: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """vec_id, n_links, component_id of every row (vec_id, embedding)."""
    dim = dimension(rows, "embedding")
    nodes = nodes_of(rows, dim)
    count = nodes.count()
    for overlap in range(OVERLAP, MOST_OVERLAP + 1):
        members = split_large(first_shards(nodes, dim, count, overlap), dim)
        found = linked(members, nodes, dim, threshold)
        links = stored(found.groupBy("node").agg(F.sum("links").alias("links")), "vec-counts")
        if count <= SHARD or audit(nodes, links, dim, threshold) >= RECALL:
            break
    component = connected(found.filter("node <> root").select(F.col("node").alias("a"), F.col("root").alias("b")))
    placed = nodes.select("key", "node", "copies", "least").join(links, "node").join(component, "node", "left").withColumn(
        "component", F.coalesce("component", "node"))
    least = placed.groupBy("component").agg(F.min("least").alias("component_id"))
    result = placed.join(least, "component").select(
        "key", (F.col("links") + F.col("copies") - 1).alias("n_links"), "component_id")
    own = keyed(rows, dim).select("vec_id", F.when(F.col("vec_id").isNotNull(), F.col("key")).alias("key"))
    alone = own.filter("key IS NULL").select("vec_id", F.lit(0).cast("bigint").alias("n_links"),
                                             F.col("vec_id").alias("component_id"))
    # Keys of large groups of copies are split by AQE; the other side has one row each.
    return own.filter("key IS NOT NULL").join(broadcast_if_small(stored(result, "vec-result")), "key").select(
        "vec_id", "n_links", "component_id").unionByName(alone)


def op11(embeddings: DataFrame) -> DataFrame:
    return near_copies(embeddings).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
