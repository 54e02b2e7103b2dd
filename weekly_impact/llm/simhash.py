"""SimHash near-dedup with BK-trees.

A document's 64-bit fingerprint takes each bit by majority over the XXH64
hashes of its word shingles.  Fingerprints within ``radius`` bits link.

Two fingerprints within radius r agree on at least one of r + 1 bands of bits,
so each distinct fingerprint is dealt to r + 1 groups, one per band and band
value.  A group is a shard of at most ``SHARD`` fingerprints or is cut into
several; every shard becomes a BK-tree, a node's children keyed by their
integer Hamming distance to it, and the shard's tree is sent to the blocks of
its own group only (a group of s shards: s (s + 1) / 2 meetings).  A search
follows only edges within the radius of the distance just measured.  Trees
have a fixed greatest size; nothing that grows with the table is broadcast.
A task gives back a spanning forest of the links it found, never all pairs,
and the forests become components in a distributed job.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import release
from .common import join_spread, slices, without, written
from .components import components

SHARD = 256
SEED = 42


def fingerprint(text: str | None, words: int = 3, seed: int = SEED) -> int:
    """The majority fingerprint as an unsigned integer; A-Z lower-cased, words cut at ASCII white space."""
    ws = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: ASCII rules only
    if not ws:
        return 0
    if len(ws) < words:
        shingles = [b" ".join(ws)]
    else:
        shingles = map(b" ".join, zip(*(ws[i:] for i in range(words))))
    h = np.array([xxhash.xxh64_intdigest(s, seed) for s in shingles], dtype=">u8")
    n, ones = len(h), np.zeros(64, dtype=np.int64)
    for i in range(0, n, 65536):
        ones += np.unpackbits(h[i:i + 65536].view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > n).tobytes(), "big")


def fingerprints(docs: DataFrame, words: int = 3, text_col: str = "text") -> DataFrame:
    """The input's columns and ``fp``, the fingerprint as a signed long."""
    docs = without(docs, "fp")
    at = docs.columns.index(text_col)

    def run(batches):
        for b in slices(batches):
            fp = np.array([fingerprint(t, words) for t in b.column(at).to_pylist()], dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(fp, pa.int64())], [*b.schema.names, "fp"])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField("fp", T.LongType())]))


class BKTree:
    """A BK-tree over distinct integers, built level by level; a node's children are keyed by distance."""

    def __init__(self, values: np.ndarray):
        self.values: list[int] = []
        self.children: list[dict[int, int]] = []
        todo = [(None, 0, values)]
        while todo:
            parent, d, group = todo.pop()
            at = len(self.values)
            root = group[len(group) // 2]
            self.values.append(int(root))
            self.children.append({})
            if parent is not None:
                self.children[parent][d] = at
            rest = np.delete(group, len(group) // 2)
            if len(rest):
                dist = np.bitwise_count(rest ^ root)
                for k in np.unique(dist):
                    todo.append((at, int(k), rest[dist == k]))

    def search(self, q: int, radius: int) -> list[int]:
        """All values within ``radius`` bits of q, following only edges that can lead to one."""
        out, todo = [], [0]
        while todo:
            at = todo.pop()
            d = (self.values[at] ^ q).bit_count()
            if d <= radius:
                out.append(self.values[at])
            kids = self.children[at]
            if kids:
                for k in range(d - radius, d + radius + 1):
                    if k in kids:
                        todo.append(kids[k])
        return out


def _forest(links, out_a, out_b):
    """Adds a spanning forest of the links, each node with the least node of its tree."""
    up: dict[int, int] = {}

    def find(x):
        root = x
        while up.get(root, root) != root:
            root = up[root]
        while up.get(x, x) != root:
            up[x], x = root, up[x]
        return root

    for a, b in links:
        a, b = find(a), find(b)
        if a != b:
            up[max(a, b)] = min(a, b)
    for x in up:
        root = find(x)
        if root != x:
            out_a.append(x)
            out_b.append(root)


def _bands(bits: int = 64, n: int = 3) -> list[tuple[int, int]]:
    """(shift, mask) of n bands that cover the bits."""
    cut = [bits * i // n for i in range(n + 1)]
    return [(lo, (1 << (hi - lo)) - 1) for lo, hi in zip(cut, cut[1:])]


def _changes(cols) -> np.ndarray:
    """Where a new meeting begins in ordered rows."""
    change = np.zeros(len(cols[5]), dtype=bool)
    change[:1] = True
    for c in cols[:4]:
        change[1:] |= c[1:] != c[:-1]
    return change


def link_forest(distinct: DataFrame, radius: int, shard: int = SHARD) -> DataFrame:
    """(a, b): links between distinct fingerprints ``fp`` that connect all that are within ``radius`` bits."""
    bands = _bands(64, radius + 1)
    keys = F.array(*[
        F.struct(F.lit(i).alias("band"), F.shiftrightunsigned("fp", lo).bitwiseAND(F.lit(mask)).alias("value"))
        for i, (lo, mask) in enumerate(bands)
    ])
    members = distinct.select("fp", F.explode(keys).alias("k")).select("fp", "k.band", "k.value")
    groups = members.groupBy("band", "value").agg(F.count("*").alias("n")).where("n > 1")
    groups = groups.select("band", "value", F.ceil(F.col("n") / shard).cast("int").alias("shards"))
    # A member belongs to one shard, by a hash; it takes part in each meeting of its shard with a shard of its group.
    own = members.join(groups, ["band", "value"]).withColumn("own", F.pmod(F.xxhash64("fp"), F.col("shards")).cast("int"))
    met = own.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("shards") - 1)))
    meetings = met.select(
        "band", "value", F.least("own", "other").alias("tree"), F.greatest("own", "other").alias("block"), "own", "fp")

    def search(cols, out_a, out_b):
        """Adds the links of whole meetings; rows are in order."""
        fps = cols[5].view(np.uint64)
        starts = [*np.flatnonzero(_changes(cols)), len(fps)]
        for s, e in zip(starts, starts[1:]):
            if e - s < 2:
                continue
            tree, block, own_, fp = int(cols[2][s]), int(cols[3][s]), cols[4][s:e], fps[s:e]
            if e - s == 2 and tree == block:
                if int(np.bitwise_count(fp[0] ^ fp[1])) <= radius:
                    _forest([(int(fp[0]), int(fp[1]))], out_a, out_b)
                continue
            mine, asking = (fp, fp) if tree == block else (fp[own_ == tree], fp[own_ == block])
            if len(mine) and len(asking):
                bk = BKTree(mine)
                _forest(((int(q), x) for q in asking.tolist() for x in bk.search(q, radius) if x != q), out_a, out_b)

    def run(batches):
        rest = [np.empty(0, dtype=np.int64)] * 6
        for b in itertools.chain(batches, [None]):
            cols = rest if b is None else [np.concatenate(x) for x in zip(rest, (b.column(c).to_numpy() for c in (*meeting, "own", "fp")))]
            changes = np.flatnonzero(_changes(cols))
            end = len(cols[5]) if b is None else int(changes[-1]) if len(changes) else 0  # the last meeting may go on
            rest = [x[end:] for x in cols]
            a: list[int] = []
            z: list[int] = []
            search([x[:end] for x in cols], a, z)
            if a:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.array(x, dtype=np.uint64).view(np.int64), pa.int64()) for x in (a, z)], ["a", "b"])

    # Sorted by Spark, which spills, so that a task holds one batch and one meeting at a time.
    meeting = ("band", "value", "tree", "block")
    dealt = meetings.repartition(*meeting).sortWithinPartitions(*meeting, "fp")
    return dealt.mapInArrow(run, "a long, b long")


def near_duplicates(docs: DataFrame, words: int = 3, radius: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, fp (signed long), fingerprint (hex), component_id, kept, group, text_a, text_b.

    component_id is the smallest id that links reach; equal fingerprints link.
    Documents without words have fingerprint zero and link like any other.
    Null texts count as empty.  A null id never becomes a component's id while
    another id is there (it sorts last); repeated rows stay, each in its
    component.  ``kept`` marks one row per component: that of the smallest id
    (of repeated ids, all rows).  ``group`` names the component by a
    fingerprint, as ids may repeat; text_a and text_b (64-bit hashes) name the
    text.  An empty table gives no rows; other columns, whatever their names,
    are not read.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    named = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text).alias("text_a"), F.xxhash64(F.lit(1), text).alias("text_b"), F.col(text_col).alias("text"))
    prints = written(fingerprints(named, words).drop("text"), "fps")
    distinct = written(prints.groupBy("fp").agg(F.min("doc_id").alias("least"), F.count("*").alias("rows")), "distinct")
    member = components(link_forest(distinct.select("fp", "least"), radius))
    # A fingerprint's component, then the least document of the component; hot ones are spread (see ``join_spread``).
    joined = written(distinct.join(member.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("component", "fp")), "joined")
    ids = written(joined.groupBy("root").agg(F.min("least").alias("component_id"), F.count("*").alias("kinds")), "ids")
    told = written(join_spread(joined.select("fp", "root", "rows"), ids, ["root"], "kinds"), "named")
    out = join_spread(prints, told, ["fp"], "rows").select(
        "doc_id", "fp", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id",
        F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"), F.col("root").alias("group"), "text_a", "text_b")
    release(distinct, joined, ids)
    return out
