"""Line dedup with sharded minimal perfect hashes.

Line keys (stripped, lower-cased) become 128-bit hashes.  One pre-aggregated
pass finds each hash's count, smallest and largest document.  The hashes that
at least two documents hold are dealt into shards; in each shard a minimal
perfect hash maps the n hashes onto 0..n-1, and compact arrays indexed by it
hold a fingerprint (to turn away lines that are not in the shard), the count
and the owner, the smallest document.  Documents send their lines' hashes to
the shards and probe the arrays; lines themselves are never joined.

A shard that would get more probes than usual is copied, so that a line that a
third of all documents hold is probed in many tasks.  What returns is
only the hashes that a document loses, grouped by document.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import slices, text_of, without, written

SHARD_KEYS = 100_000
PROBES = 400_000
MAX_LEVELS = 64  # each level leaves well under half of the keys, if they are distinct
BROADCAST_SHARDS = 1_000_000
WHITE_BYTES = b" \t\n\x0b\x0c\r"
ADDED = ("n_lines", "n_dropped", "kept")


def line_key(line: Column) -> Column:
    """Stripped of ASCII white space at both ends, A-Z lower-cased."""
    stripped = F.btrim(line, F.lit(" \t\n\u000b\f\r"))
    return F.translate(stripped, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


class PerfectHash:
    """Minimal perfect hash of distinct 64-bit keys: levels of bit arrays, a key's place is its bit's rank.

    At each level the keys left over hash into a bit array; those alone on
    their bit stay, the others go to the next level.
    """

    def __init__(self, levels: list[np.ndarray]):
        self.levels = levels
        ones = [int(x.sum()) for x in levels]
        self.before = np.cumsum([0, *ones])
        self.ranks = [np.cumsum(x) - x for x in levels]

    @staticmethod
    def spot(keys: np.ndarray, level: int, size: int) -> np.ndarray:
        x = keys ^ np.uint64((0x9E3779B97F4A7C15 * (level + 1)) & (2**64 - 1))
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return ((x ^ (x >> np.uint64(31))) % np.uint64(size)).astype(np.int64)

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        levels = []
        while len(keys):
            if len(levels) == MAX_LEVELS:
                raise ValueError(f"{len(keys)} keys of one shard are equal in their 64-bit mix")
            size = max(64, 2 * len(keys))
            at = cls.spot(keys, len(levels), size)
            n = np.bincount(at, minlength=size)
            levels.append((n == 1).astype(np.uint8))
            keys = keys[n[at] != 1]
        return cls(levels)

    def places(self, keys: np.ndarray) -> np.ndarray:
        """0..n-1 for the keys it was built from; for others any place or -1."""
        out = np.full(len(keys), -1, dtype=np.int64)
        left = np.arange(len(keys))
        for i, bits in enumerate(self.levels):
            if not len(left):
                break
            at = self.spot(keys[left], i, len(bits))
            hit = bits[at] == 1
            out[left[hit]] = self.before[i] + self.ranks[i][at[hit]]
            left = left[~hit]
        return out

    def to_bytes(self) -> list[bytes]:
        return [np.packbits(x).tobytes() + len(x).to_bytes(8, "big") for x in self.levels]

    @classmethod
    def from_bytes(cls, blocks: list[bytes]) -> PerfectHash:
        return cls([np.unpackbits(np.frombuffer(b[:-8], np.uint8), count=int.from_bytes(b[-8:], "big")) for b in blocks])


def line_hashes(docs: DataFrame, min_chars: int) -> DataFrame:
    """(doc_id, h1, h2) of every line key of at least ``min_chars`` code points, once per document row."""
    keys = F.array_distinct(F.filter(F.transform(F.split("text", "\n", -1), line_key), lambda k: F.length(k) >= min_chars))
    lines = docs.select("doc_id", F.explode(keys).alias("key"))
    return lines.select("doc_id", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), "key").alias("h2"))


INDEX = "shard int, copy int, n_keys long, hash_levels array<binary>, fingerprints binary, counts binary, owners binary"


def _shard_rows(shard: int, copies: int, parts: list) -> Iterator[pa.RecordBatch]:
    """One shard's arrays, once per copy."""
    h1, h2, owner, n_lines = (np.concatenate(x) for x in zip(*parts))
    # Keys equal in their first half tell themselves apart by the second: the perfect hash sees both mixed.
    h1, h2 = h1.view(np.uint64), h2.view(np.uint64)
    mixed = h1 ^ (h2 * np.uint64(0x9E3779B97F4A7C15))
    mph = PerfectHash.build(mixed)
    at = mph.places(mixed)
    prints, counts, owners = (np.empty(len(h1), dtype=t) for t in (np.uint64, np.int64, np.int64))
    prints[at], counts[at], owners[at] = h2, n_lines, owner
    one = {"n_keys": len(h1), "hash_levels": mph.to_bytes(), "fingerprints": prints.tobytes(), "counts": counts.tobytes(), "owners": owners.tobytes()}
    for copy in range(copies):
        yield pa.RecordBatch.from_pylist(
            [{"shard": shard, "copy": copy, **one}],
            pa.schema([("shard", pa.int32()), ("copy", pa.int32()), ("n_keys", pa.int64()), ("hash_levels", pa.list_(pa.binary())),
                       ("fingerprints", pa.binary()), ("counts", pa.binary()), ("owners", pa.binary())]))


def _build_shards(batches):
    """Arrays of the shards, which come one after another: a task holds one shard's keys at a time."""
    now, parts = None, []
    for b in batches:
        if not b.num_rows:
            continue
        shard, copies, *columns = (b.column(c).to_numpy() for c in ("shard", "copies", "h1", "h2", "owner", "n_lines"))
        cuts = np.flatnonzero(np.append(True, shard[1:] != shard[:-1]))
        for s, e in zip(cuts, np.append(cuts[1:], len(shard))):
            key = (int(shard[s]), int(copies[s]))
            if key != now:
                if parts:
                    yield from _shard_rows(*now, parts)
                now, parts = key, []
            parts.append([c[s:e] for c in columns])
    if parts:
        yield from _shard_rows(*now, parts)


def _probe(left, right):
    """The (document, line hash) pairs that lose their lines; left: probes, right: one shard's arrays."""
    import pandas as pd

    if left.num_rows == 0 or right.num_rows == 0:
        return pa.table({"doc_id": pa.array([], pa.int64()), "h1": pa.array([], pa.int64())})
    row = {c: right.column(c)[0].as_py() for c in ("hash_levels", "fingerprints", "counts", "owners")}
    mph = PerfectHash.from_bytes(row["hash_levels"])
    prints, owners = np.frombuffer(row["fingerprints"], np.uint64), np.frombuffer(row["owners"], np.int64)
    counts = np.frombuffer(row["counts"], np.int64)
    doc, h1, h2 = (left.column(c).to_numpy() for c in ("doc_id", "h1", "h2"))
    h2u = h2.view(np.uint64)
    at = mph.places(h1.view(np.uint64) ^ (h2u * np.uint64(0x9E3779B97F4A7C15)))
    lost = at >= 0
    lost[lost] = (prints[at[lost]] == h2u[lost]) & (counts[at[lost]] > 1) & (owners[at[lost]] != doc[lost])
    return pa.Table.from_pandas(pd.DataFrame({"doc_id": doc[lost], "h1": h1[lost]}), preserve_index=False)


def losses(docs: DataFrame, min_chars: int = 10) -> DataFrame:
    """(doc_id, lost): the hashes of the lines that a document loses, for documents that lose any."""
    hashes = line_hashes(docs.where("doc_id is not null"), min_chars)
    per_key = hashes.groupBy("h1", "h2").agg(
        F.min("doc_id").alias("owner"), F.max("doc_id").alias("last"), F.count("*").alias("n_lines"))
    keys = written(per_key, "keys")
    repeated = keys.where("owner <> last")
    total = keys.agg(F.coalesce(F.sum("n_lines"), F.lit(0)).alias("probes"), F.count_if(F.expr("owner <> last")).alias("keys")).first()
    tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    shards = max(tasks, math.ceil(total["keys"] / SHARD_KEYS), math.ceil(total["probes"] / PROBES))
    shard = F.pmod(F.col("h1"), F.lit(shards)).cast("int")
    each = max(1000, 2 * math.ceil(total["probes"] / shards))  # probes of a copy: up to twice the usual shard's
    copies = keys.groupBy(shard.alias("shard")).agg(F.ceil(F.sum("n_lines") / each).cast("int").alias("copies"))
    several = written(copies.where("copies > 1"), "copies")  # usual shards have one copy and are not listed
    if several.count() <= BROADCAST_SHARDS:
        several = F.broadcast(several)  # else the planner joins by a shuffle
    times = F.coalesce("copies", F.lit(1))
    dealt = repeated.withColumn("shard", shard).join(several, "shard", "left").select("shard", times.alias("copies"), "h1", "h2", "owner", "n_lines")
    index = written(dealt.repartition("shard").sortWithinPartitions("shard", "copies").mapInArrow(_build_shards, INDEX), "index")
    spread = F.pmod(F.xxhash64("doc_id"), times).cast("int")
    probes = hashes.withColumn("shard", shard).join(several, "shard", "left").select("shard", spread.alias("copy"), "doc_id", "h1", "h2")
    lost = (
        probes.groupBy("shard", "copy").cogroup(index.select("shard", "copy", "hash_levels", "fingerprints", "counts", "owners").groupBy("shard", "copy"))
        .applyInArrow(_probe, "doc_id long, h1 long")
    )
    return lost.groupBy("doc_id").agg(F.collect_set("h1").alias("lost"))


def _kept_lines(text: str, lost: set[int]) -> tuple[str, int, int]:
    lines = text.split("\n")
    if not lost:
        return text, len(lines), 0
    kept = [x for x in lines if xxhash.xxh64_intdigest(x.encode().strip(WHITE_BYTES).lower(), 42) not in lost]
    return "\n".join(kept), len(lines), len(lines) - len(kept)


def dedup_lines(docs: DataFrame, min_chars: int = 10, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The input's columns and n_lines, n_dropped, kept (the text of the lines that stay).

    A key of at least ``min_chars`` code points that at least two documents
    (ids) hold keeps its lines only in the smallest id.  Null and empty texts
    are one empty line.  Rows with a null id keep all their lines and own
    none.  Rows that repeat an id count as one document.  An empty table gives
    no rows; input columns named like an added one are replaced.
    """
    docs = without(docs, *ADDED, "_id", "_lost")
    lost = losses(docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("text")), min_chars)
    joined = docs.withColumn("_id", F.col(id_col).cast("long")).join(
        lost.select(F.col("doc_id").alias("_id"), F.col("lost").alias("_lost")), "_id", "left").select(*docs.columns, "_lost")
    at, hashes_at = docs.columns.index(text_col), len(docs.columns)

    def run(batches):
        for b in slices(batches):
            done = [_kept_lines(t or "", {x & (2**64 - 1) for x in lost or ()})
                    for t, lost in zip(b.column(at).to_pylist(), b.column(hashes_at).to_pylist())]
            new = [pa.array([d[1] for d in done], pa.int64()), pa.array([d[2] for d in done], pa.int64()), pa.array([d[0] for d in done], pa.string())]
            yield pa.RecordBatch.from_arrays([*b.columns[:hashes_at], *new], [*b.schema.names[:hashes_at], *ADDED])

    fields = [T.StructField("n_lines", T.LongType()), T.StructField("n_dropped", T.LongType()), T.StructField("kept", T.StringType())]
    return joined.mapInArrow(run, T.StructType([*docs.schema.fields, *fields]))
