"""Embedding near-dedup over a robust-pruned flat graph.

Equal vectors are one node with a count.  Nodes are dealt to the shards of
their ``OVERLAP`` nearest centroids, so shards overlap; in each shard a graph
is built by greedy search and robust pruning (two passes), and a node's
adjacency lists from all its shards are united.  Pruning may drop every way
back to a node of a dense group, so each node keeps one list that names it,
and nodes that the medoid still does not reach are attached at the end.  In
each shard, every member is then searched from the shard's medoid: a greedy
beam finds the neighbourhood, and the search expands, along the edges and
against them, from itself and from all nodes in range until it meets no new
one.  Similarities are double-precision cosines, so what is found is verified
as it is found.

A pair that shares several shards counts in the first of them only, so counts
add up without listing pairs; tasks return, per node, a count and the root of
its tree of found links.  An audit compares the counts of sampled nodes, drawn
from layers of equal magnitude of found links (nodes without any are a layer),
with brute force over all vectors, node by node.  Below ``GOAL`` the overlap is
doubled and the work repeated; when ``MAX_OVERLAP`` or all shards are used up,
the links are counted by comparing blocks exactly, so no result below the
goal is returned.

Centroids are fitted on a bounded sample (``FIT_VALUES`` numbers).  A shard
beyond ``TILE`` members is cut into tiles, each with its own graph, and every
member is searched in every tile, in blocks.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import release
from .common import join_spread, written
from .components import components

HOME = 2048
TILE = 16_384
OVERLAP = 3
MAX_SHARDS = 4096
FIT_VALUES = 1_500_000
MAX_OVERLAP = 12
AUDITED, AUDITED_LINKED = 2048, 128
GOAL = 0.999
DEGREE, BEAM, ALPHA, BATCH = 32, 32, 1.2, 512
SLACK = 0.05


def matrix(column) -> np.ndarray:
    """Unit vectors in double precision; shorter vectors are padded with zeros."""
    rows = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    ends = rows.offsets.to_numpy()
    flat, sizes = rows.values.to_numpy(zero_copy_only=False).astype(np.float64), np.diff(ends)
    out = np.zeros((len(sizes), int(sizes.max(initial=1))))
    out[np.arange(out.shape[1])[None, :] < sizes[:, None]] = flat[ends[0]:ends[-1]]
    return unit(out)


def unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)  # no overflow in the norm
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def beam_search(v: np.ndarray, adj: np.ndarray, start: int, q: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Greedy beam search for a batch of queries: (ids, similarities), best first; -1 fills up."""
    n = len(q)
    ids = np.full((n, width), -1)
    sims = np.full((n, width), -2.0)
    done = np.ones((n, width), dtype=bool)
    ids[:, 0], sims[:, 0], done[:, 0] = start, q @ v[start], False
    live = np.arange(n)
    while len(live):
        best = np.where(done[live], -3.0, sims[live]).argmax(axis=1)
        done[live, best] = True
        near = adj[ids[live, best]]
        s = np.einsum("bd,brd->br", q[live], v[near])
        fresh = (near >= 0) & ~(near[:, :, None] == ids[live][:, None, :]).any(axis=2)
        s[~fresh] = -2.0
        all_ids = np.concatenate([ids[live], np.where(fresh, near, -1)], axis=1)
        all_sims = np.concatenate([sims[live], s], axis=1)
        all_done = np.concatenate([done[live], ~fresh], axis=1)
        order = np.argsort(-all_sims, axis=1, kind="stable")[:, :width]
        ids[live] = np.take_along_axis(all_ids, order, 1)
        sims[live] = np.take_along_axis(all_sims, order, 1)
        done[live] = np.take_along_axis(all_done, order, 1)
        live = live[~done[live].all(axis=1)]
    return ids, sims


def robust_prune(v: np.ndarray, p: int, candidates: np.ndarray, degree: int = DEGREE, alpha: float = ALPHA) -> np.ndarray:
    """Nearest first; a kept neighbour drops the candidates that are alpha times nearer to it than to p."""
    c = np.unique(candidates[(candidates >= 0) & (candidates != p)])
    if len(c) <= 1:
        return c
    d = 1 - v[c] @ v[p]
    order = np.argsort(d, kind="stable")
    c, d = c[order], d[order]
    between = 1 - v[c] @ v[c].T
    alive, out = np.ones(len(c), dtype=bool), []
    for i in range(len(c)):
        if alive[i]:
            out.append(c[i])
            if len(out) == degree:
                break
            alive &= alpha * between[i] > d
    return np.array(out)


def build_graph(v: np.ndarray) -> list[np.ndarray]:
    """Adjacency lists: batches of doubling size are searched, pruned and linked back, then all nodes once more."""
    n = len(v)
    adj = np.full((n, DEGREE), -1)
    named = np.zeros(n, dtype=np.int64)  # how many lists name each node
    extra: dict[int, list[int]] = {}  # ways back that pruning must not drop
    start = medoid(v)
    order = np.random.default_rng(0).permutation(n)
    order = np.concatenate([[start], order[order != start]])

    def put(x: int, near: np.ndarray) -> None:
        np.subtract.at(named, adj[x][adj[x] >= 0], 1)
        adj[x] = -1
        adj[x, :len(near)] = near
        np.add.at(named, near, 1)

    def insert(batch: np.ndarray, again: bool) -> None:
        ids, _ = beam_search(v, adj, start, v[batch], BEAM)
        back: dict[int, list[int]] = {}
        for p, near in zip(batch, ids):
            own = robust_prune(v, p, np.concatenate([near, adj[p]]) if again else near)
            put(p, own)
            for x in own:
                back.setdefault(int(x), []).append(int(p))
        for x, new in back.items():
            have = adj[x][adj[x] >= 0]
            new = np.setdiff1d(new, have)
            if len(have) + len(new) > DEGREE:
                dropped = np.concatenate([have, new])
                have = robust_prune(v, x, dropped)
                put(x, have)
                for p in np.setdiff1d(dropped, have):
                    if named[p] == 0 and p != start:
                        extra.setdefault(x, []).append(int(p))
                        named[p] += 1
            else:
                put(x, np.concatenate([have, new]))

    at = 1
    while at < n:
        batch = order[at:at + min(BATCH, at)]
        insert(batch, False)
        at += len(batch)
    for at in range(0, n, BATCH):
        insert(order[at:at + BATCH], True)
    lists = [np.unique(np.concatenate([adj[x][adj[x] >= 0], np.array(extra.get(x, []), dtype=np.int64)])) for x in range(n)]
    return attach(v, lists, start)


def reach(lists: list, frontier: list[int], seen: np.ndarray) -> None:
    """Mark all nodes that the lists lead to."""
    while frontier:
        x = frontier.pop()
        for y in lists[x]:
            if not seen[y]:
                seen[y] = True
                frontier.append(int(y))


def attach(v: np.ndarray, lists: list[np.ndarray], start: int) -> list[np.ndarray]:
    """Name every node that ``start`` does not reach in the list of the most similar node that it reaches; nothing is evicted."""
    seen = np.zeros(len(v), dtype=bool)
    seen[start] = True
    lists = [list(x) for x in lists]
    reach(lists, [start], seen)
    for p in np.flatnonzero(~seen):
        if not seen[p]:
            there = np.flatnonzero(seen)
            room = there[[len(lists[x]) < 4 * DEGREE for x in there]]
            there = room if len(room) else there
            lists[int(there[(v[there] @ v[p]).argmax()])].append(int(p))
            seen[p] = True
            reach(lists, [int(p)], seen)
    return [np.array(x, dtype=np.int64) for x in lists]


def both_ways(lists: list[np.ndarray]) -> list[np.ndarray]:
    """Each node's neighbours along the edges and against them."""
    n = len(lists)
    out = np.concatenate(lists) if n else np.zeros(0, dtype=np.int64)
    src = np.repeat(np.arange(n), [len(x) for x in lists])
    a, b = np.concatenate([src, out]), np.concatenate([out, src])
    order = np.argsort(a, kind="stable")
    cuts = np.searchsorted(a[order], np.arange(n + 1))
    return [np.unique(b[order[cuts[i]:cuts[i + 1]]]) for i in range(n)]


def medoid(v: np.ndarray) -> int:
    return int((v @ v.mean(axis=0)).argmax())


def in_range(v: np.ndarray, neighbours: list[np.ndarray], q: np.ndarray, first: np.ndarray, least: float) -> np.ndarray:
    """All nodes with a similarity >= least that expansion from ``first`` reaches over nodes almost in range."""
    seen = np.zeros(len(v), dtype=bool)
    seen[first] = True
    frontier, hits = first, []
    while len(frontier):
        s = v[frontier] @ q
        hits.append(frontier[s >= least])
        wide = frontier[s >= least - SLACK]
        if not len(wide):
            break
        near = np.unique(np.concatenate([neighbours[x] for x in wide]))
        frontier = near[~seen[near]]
        seen[frontier] = True
    return np.concatenate(hits) if hits else first[:0]


def fit_centroids(nodes: DataFrame, n: int) -> np.ndarray:
    """K-means centroids from a bounded sample of nodes, one per ``HOME`` of them, ``MAX_SHARDS`` at most."""
    k = min(MAX_SHARDS, max(1, math.ceil(n / HOME)))
    dim = nodes.agg(F.max(F.size("v"))).first()[0]
    rows = nodes.orderBy(F.xxhash64("node"), "node").limit(max(k, FIT_VALUES // dim)).select("v").toArrow()
    x = matrix(rows.column("v"))
    if x.shape[1] < dim:
        x = np.pad(x, ((0, 0), (0, dim - x.shape[1])))
    rng = np.random.default_rng(0)
    c = x[rng.choice(len(x), size=min(k, len(x)), replace=False)]
    for _ in range(10):
        home = (x @ c.T).argmax(axis=1)
        sums = np.zeros_like(c)
        np.add.at(sums, home, x)
        empty = np.abs(sums).max(axis=1) == 0
        sums[empty] = c[empty]
        c = unit(sums)
    return c


def deal(nodes: DataFrame, centroids: np.ndarray, overlap: int) -> DataFrame:
    """(node, v, dims, copies, shards): the nearest ``overlap`` centroids of each node, in order of their numbers."""
    shared = nodes.sparkSession.sparkContext.broadcast(centroids)

    def run(batches):
        for b in batches:
            if b.num_rows:
                x, c = matrix(b.column("v")), shared.value
                s = x @ c[:, :x.shape[1]].T
                m = min(overlap, len(c))
                top = np.sort(np.argpartition(-s, m - 1, axis=1)[:, :m], axis=1).astype(np.int32)
                flat = pa.FixedSizeListArray.from_arrays(pa.array(top.ravel()), m).cast(pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays([*b.columns, flat], [*b.schema.names, "shards"])

    return nodes.mapInArrow(run, "node long, v array<double>, copies long, shards array<int>")


def _build(key, table):
    v = matrix(table.column("v"))
    node = table.column("node").to_numpy()
    order = np.argsort(node)
    v, node = v[order], node[order]
    lists = [node[a] for a in build_graph(v)]
    return pa.table({"node": pa.array(node), "near": pa.array(lists, pa.list_(pa.int64()))})


class _Trees:
    """Trees of found links over the rows of one task."""

    def __init__(self, n: int):
        self.root = np.arange(n)
        self.members = {i: [i] for i in range(n)}

    def join(self, rows: np.ndarray) -> None:
        trees = np.unique(self.root[rows])
        if len(trees) > 1:
            keep = max(trees, key=lambda r: len(self.members[r]))
            for r in trees:
                if r != keep:
                    self.root[self.members[r]] = keep
                    self.members[keep] += self.members.pop(r)


def _columns(table):
    data = np.asarray(table.column("is_data").to_pylist(), dtype=bool)
    asks = np.asarray(table.column("is_query").to_pylist(), dtype=bool)
    names = ("node", "dims", "copies")
    return data, asks, matrix(table.column("v")), *(table.column(c).to_numpy() for c in names)


def _search(least: float):
    def run(key, table):
        shard = key[0].as_py()
        data, asks, v, node, dims, copies = _columns(table)
        shards = table.column("shards").to_pylist()
        of = np.full((len(shards), max(map(len, shards))), -1)
        for i, x in enumerate(shards):
            of[i, :len(x)] = x
        at_data = np.flatnonzero(data)
        place = {int(x): i for i, x in enumerate(node[at_data])}
        near = [np.array([place[x] for x in row or () if x in place], dtype=np.int64) for row in table.column("near").take(pa.array(at_data)).to_pylist()]
        width = max(1, max(map(len, near), default=1))
        adj = np.full((len(near), width), -1)
        for i, x in enumerate(near):
            adj[i, :len(x)] = x
        around = both_ways(near)
        dv = v[at_data]
        start = medoid(dv)
        counts = np.zeros(len(node), dtype=np.int64)
        trees = _Trees(len(node))
        ask = np.flatnonzero(asks)
        for s in range(0, len(ask), BATCH):
            part = ask[s:s + BATCH]
            ids, _ = beam_search(dv, adj, start, v[part], BEAM)
            for x, first in zip(part, ids):
                first = first[first >= 0]
                if data[x] and place[int(node[x])] not in first:  # a member also looks around itself
                    first = np.append(first, place[int(node[x])])
                got = at_data[in_range(dv, around, v[x], first, least)]
                got = got[(node[got] != node[x]) & (dims[got] == dims[x])]
                if not len(got):
                    continue
                smaller = [c for c in of[x] if 0 <= c < shard]
                here = ~np.isin(of[got], smaller).any(axis=1) if smaller else np.ones(len(got), dtype=bool)
                counts[x] += copies[got[here]].sum()
                trees.join(np.append(got, x))
        return pa.table({"node": node, "n": counts, "tree": node[trees.root]})

    return run


def search_shards(dealt: DataFrame, least: float) -> DataFrame:
    """(node, n, tree): linked copies of other nodes that each shard found, and the node's tree there."""
    members = dealt.withColumn("shard", F.explode("shards")).withColumn("dims", F.size("v").cast("long"))
    sizes = members.groupBy("shard").agg(F.ceil(F.count("*") / TILE).cast("int").alias("tiles"))  # at most MAX_SHARDS rows
    members = members.join(F.broadcast(sizes), "shard").withColumn("tile", F.pmod(F.xxhash64("node"), F.col("tiles")).cast("int"))
    lists = members.groupBy("shard", "tile").applyInArrow(_build, "node long, near array<long>")
    union = written(lists.groupBy("node").agg(F.array_distinct(F.flatten(F.collect_list("near"))).alias("near")), "graph")
    other = F.explode(F.sequence(F.lit(0), F.col("tiles") - 1))
    both = members.join(union, "node").withColumn("other", other)
    same = F.col("tile") == F.col("other")
    cols = ["shard", "node", "v", "dims", "copies", "shards"]
    data = both.select(*cols, "near", F.col("tile").alias("data"), F.col("other").alias("asking"), F.lit(True).alias("is_data"), same.alias("is_query"))
    queries = both.where(~same).select(*cols, F.lit(None).cast("array<long>").alias("near"), F.col("other").alias("data"), F.col("tile").alias("asking"),
                                       F.lit(False).alias("is_data"), F.lit(True).alias("is_query"))
    return data.unionByName(queries).groupBy("shard", "data", "asking").applyInArrow(_search(least), "node long, n long, tree long")


def _exact(least: float):
    def run(key, table):
        data, asks, v, node, dims, copies = _columns(table)
        at_data, ask = np.flatnonzero(data), np.flatnonzero(asks)
        counts, trees = np.zeros(len(node), dtype=np.int64), _Trees(len(node))
        for s in range(0, len(ask), BATCH):
            part = ask[s:s + BATCH]
            hit = (v[part] @ v[at_data].T >= least) & (dims[part][:, None] == dims[at_data][None, :]) & (node[part][:, None] != node[at_data][None, :])
            counts[part] = hit @ copies[at_data]
            for x, row in zip(part, hit):
                if row.any():
                    trees.join(np.append(at_data[row], x))
        return pa.table({"node": node, "n": counts, "tree": node[trees.root]})

    return run


def compare_blocks(nodes: DataFrame, centroids: np.ndarray, least: float) -> DataFrame:
    """(node, n, tree) like ``search_shards``, by comparing blocks of vectors exactly.

    A node lives in the block of its nearest centroid.  If x and y are within
    the angle t, and y lives with centroid c, then y is not farther from c
    than from x's own centroid, so x is within angle(x, own) + 2 t of c: only
    blocks of such centroids can hold y, and x is compared with these in full.
    """
    shared = nodes.sparkSession.sparkContext.broadcast(centroids)
    angle = math.acos(min(1.0, least))

    def run(batches):
        for b in batches:
            if b.num_rows:
                x, c = matrix(b.column("v")), shared.value
                a = np.arccos(np.clip(x @ c[:, :x.shape[1]].T, -1, 1))
                home = a.argmin(axis=1)
                meets = a <= a.min(axis=1, keepdims=True) + 2 * angle + 1e-9
                where = [np.flatnonzero(m).astype(np.int32) for m in meets]
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(home.astype(np.int32)), pa.array(where, pa.list_(pa.int32()))], [*b.schema.names, "home", "meets"])

    dealt = written(nodes.withColumn("dims", F.size("v").cast("long")).mapInArrow(run, "node long, v array<double>, copies long, dims long, home int, meets array<int>"), "blocks")
    sizes = dealt.groupBy("home").agg(F.ceil(F.count("*") / TILE).cast("int").alias("tiles"))  # at most MAX_SHARDS rows
    tile = F.pmod(F.xxhash64("node"), F.col("tiles")).cast("int")
    cols = ["node", "v", "dims", "copies"]
    lives = dealt.join(F.broadcast(sizes), "home").withColumn("tile", tile)
    block = F.explode(F.sequence(F.lit(0), F.col("tiles") - 1))
    part = F.pmod(F.xxhash64("node", F.lit(3)), F.lit(max(1, len(centroids) // 8))).cast("int")  # askers of one block, in parts
    asks = dealt.select(*cols, F.explode("meets").alias("home")).join(F.broadcast(sizes), "home").select(*cols, "home", block.alias("tile"), part.alias("part"))
    parts = F.explode(F.sequence(F.lit(0), F.lit(max(1, len(centroids) // 8) - 1)))
    data = lives.select(*cols, "home", "tile", parts.alias("part"), F.lit(True).alias("is_data"), F.lit(False).alias("is_query"))
    asking = asks.withColumns({"is_data": F.lit(False), "is_query": F.lit(True)})
    return data.unionByName(asking).groupBy("home", "tile", "part").applyInArrow(_exact(least), "node long, n long, tree long")


def audit(nodes: DataFrame, found: DataFrame, least: float) -> float:
    """Estimated mean, over all nodes that have links, of the share of a node's links that were found.

    Nodes are sampled by magnitude of their found links: ``AUDITED`` of those
    without any, ``AUDITED_LINKED`` of each power of two.  Their true counts
    come from brute force over all nodes; layers count by their sizes.
    """
    told = nodes.join(found, "node", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    told = told.withColumn("layer", F.when(F.col("n") > 0, F.floor(F.log2("n")).cast("int")).otherwise(-1))
    sizes = {r["layer"]: r["c"] for r in told.groupBy("layer").agg(F.count("*").alias("c")).collect()}  # at most 64 layers
    picked = []
    for layer in sizes:
        rows = told.where(F.col("layer") == layer).orderBy(F.xxhash64("node", F.lit(7)), "node").limit(AUDITED if layer < 0 else AUDITED_LINKED)
        picked.append(rows.select("node", "v", "n", "layer").toArrow())  # bounded by its limit
    ids, got, layers = (np.concatenate([p.column(c).to_numpy() for p in picked]) for c in ("node", "n", "layer"))
    width = max(int(np.diff(p.column("v").combine_chunks().offsets.to_numpy()).max(initial=1)) for p in picked)
    q = np.zeros((len(ids), width))
    dims, at = np.zeros(len(ids), dtype=np.int64), 0
    for p in picked:
        m = matrix(p.column("v"))
        q[at:at + len(m), :m.shape[1]] = m
        dims[at:at + len(m)] = np.diff(p.column("v").combine_chunks().offsets.to_numpy())
        at += len(m)

    def run(batches):
        total = np.zeros(len(ids), dtype=np.int64)
        for b in batches:
            for s in range(0, b.num_rows, BATCH):
                c = b.slice(s, BATCH)
                x, own = matrix(c.column("v")), np.diff(c.column("v").offsets.to_numpy())
                d = min(x.shape[1], q.shape[1])
                hit = (x[:, :d] @ q[:, :d].T >= least) & (own[:, None] == dims[None, :]) & (c.column("node").to_numpy()[:, None] != ids[None, :])
                total += c.column("copies").to_numpy() @ hit
        yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(total)], ["node", "true"])

    true = nodes.mapInArrow(run, "node long, true long").groupBy("node").agg(F.sum("true").alias("true")).collect()  # the sample
    true = {r["node"]: r["true"] for r in true}
    linked, share = 0.0, 0.0
    for layer, size in sizes.items():
        rows = [(got[i], true.get(int(ids[i]), 0)) for i in np.flatnonzero(layers == layer)]
        has = [(g, t) for g, t in rows if t > 0]
        linked += size * len(has) / len(rows)
        share += size * sum(min(g, t) / t for g, t in has) / len(rows)
    return 1.0 if linked == 0 else share / linked


def link_vectors(vectors: DataFrame, least: float = 0.95, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(vec_id, n_links, component_id, kept, audited_recall), one row per input row.

    Null, empty, zero and non-finite vectors, and rows with a null id, link
    with nothing (component: their own id; kept).  Vectors of different
    lengths do not link.  Rows that repeat a vector are links of each other,
    also under one id.  An empty table gives no rows; other columns, whatever
    their names, are not read.
    """
    raw = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0)
    usable = F.coalesce(F.col("vec_id").isNotNull() & (F.size("v") > 0) & finite, F.lit(False))
    rows = raw.withColumn("v", F.when(usable, F.col("v"))).withColumn("key", F.xxhash64("v"))
    nodes = written(rows.where("v is not null").groupBy("key", "v").agg(F.min("vec_id").alias("least_id"), F.count("*").alias("copies"))
                    .withColumn("node", F.monotonically_increasing_id()), "nodes")
    n = nodes.count()
    recall = 1.0
    if n:
        points = nodes.select("node", "v", "copies")
        centroids = fit_centroids(points, n)
        overlap, parts = OVERLAP, None
        while parts is None:
            dealt = written(deal(points, centroids, overlap), "dealt")
            parts = written(search_shards(dealt, least), "parts")
            release(dealt)
            counts = parts.groupBy("node").agg(F.sum("n").alias("n"))
            recall = audit(points, counts, least)
            if recall < GOAL:
                release(parts)
                if overlap >= min(MAX_OVERLAP, len(centroids)):
                    parts, recall = written(compare_blocks(points, centroids, least), "parts"), 1.0
                    counts = parts.groupBy("node").agg(F.sum("n").alias("n"))
                else:
                    overlap, parts = overlap * 2, None
        trees = components(parts.select(F.col("node").alias("a"), F.col("tree").alias("b")))
        joined = nodes.join(counts, "node").join(trees, "node", "left").withColumn("root", F.coalesce("component", "node"))
        # The least id of each component, per node of a table with one row a node: a large component is split by its salt first.
        salted = joined.groupBy("root", F.pmod(F.xxhash64("node"), F.lit(64)).alias("salt")).agg(F.min("least_id").alias("least"), F.count("*").alias("rows"))
        least_ids = written(salted.groupBy("root").agg(F.min("least").alias("component_id"), F.sum("rows").alias("rows")), "least")
        named = join_spread(written(joined, "joined"), least_ids, ["root"], "rows").select(
            "key", "v", (F.col("n") + F.col("copies") - 1).alias("n_links"), "component_id", "copies")
    else:
        named = nodes.select("key", "v", F.lit(0).cast("long").alias("n_links"), F.col("least_id").alias("component_id"), "copies")
    linked = join_spread(rows.where("v is not null"), written(named, "named"), ["key", "v"], "copies").select("vec_id", "n_links", "component_id")
    alone = rows.where("v is null").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone).select(
        "vec_id", "n_links", "component_id", F.col("vec_id").eqNullSafe(F.col("component_id")).alias("kept"), F.lit(recall).alias("audited_recall"))
