"""Shuffled sharding: a keyed Feistel permutation over global row numbers.

Every row gets a global number 0..N-1 (its rank by id, text checksum and
size), the number goes through a Feistel permutation of 0..N-1, and the image
p alone gives the place: shard = p mod shards, slot = p div shards.  So any
reader that knows N, the key and the shard count can compute both ways
without a lookup, shards differ by at most one row, and the shuffle is the
same on every cluster and for every file layout.

The permutation works on the rectangle a x b with a = ceil(sqrt N) and
b = ceil(N / a); the fewer than a images outside 0..N-1 are walked further
along their cycle.  The length of the longest walk is measured exactly (a job
over those fewer than sqrt N + 1 numbers), so the expression that walks is
finite and never cut short.

Only DataFrame functions; texts never leave the scan, which reduces each row
to (id, size, crc32) before the first shuffle.  Equal triples are counted
before the range shuffle and numbered from the count afterwards, so repeated
rows, however many, cost one row there; a count beyond ``RUN`` is dealt out in
runs of numbers, which are spread over the tasks before they become rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import written

ROUNDS = 6
RUN = 10_000
PRIME = 2_147_483_647  # 2^31 - 1: products of two residues stay below 2^62


def round_keys(seed: int, rounds: int = ROUNDS) -> list[tuple[int, int, int]]:
    """Three multipliers/offsets per round, derived from the seed by a linear congruence."""
    out, x = [], seed % PRIME
    for _ in range(rounds):
        k = []
        for _ in range(3):
            x = (x * 48271 + 11) % PRIME
            k.append(x or 1)
        out.append(tuple(k))
    return out


def rectangle(n: int) -> tuple[int, int]:
    """a, b with a * b >= n and a * b - n < a."""
    a = max(1, int(n**0.5))
    while a * a < n:
        a += 1
    return a, max(1, -(-n // a))


def permute_once(x: Column, a: int, b: int, keys) -> Column:
    """One pass of the unbalanced Feistel network over 0..a*b-1."""
    ks = F.array(*[F.struct(F.lit(p).alias("p"), F.lit(q).alias("q"), F.lit(r).alias("r"),
                            F.lit(a if i % 2 == 0 else b).cast("long").alias("m")) for i, (p, q, r) in enumerate(keys)])
    start = F.struct((x % a).alias("l"), F.floor(x / a).cast("long").alias("r")) if a * b < 2**52 else \
        F.struct((x % a).alias("l"), ((x - x % a) / a).cast("long").alias("r"))

    def step(acc, k):
        v = (acc["r"] % PRIME * k["p"] + k["q"]) % PRIME
        return F.struct(acc["r"].alias("l"), ((acc["l"] + (v * v + k["r"]) % PRIME) % k["m"]).alias("r"))

    odd = len(keys) % 2
    return F.aggregate(ks, start, step, lambda s: s["l"] * (a if odd else b) + s["r"])


def walk(x: Column, n: int, a: int, b: int, keys, steps: int) -> Column:
    """The permutation of 0..n-1: once, then on along the cycle while outside, at most ``steps`` times."""
    once = permute_once(x, a, b, keys)
    if not steps:
        return once
    return F.aggregate(F.sequence(F.lit(1), F.lit(steps)), once,
                       lambda acc, _: F.when(acc < n, acc).otherwise(permute_once(acc, a, b, keys)))


def longest_walk(spark, n: int, a: int, b: int, keys) -> int:
    """Steps after which every walk that began inside 0..n-1 is inside again.

    The fewer than a numbers outside shrink with each step until only cycles
    that never come inside are left; no walk from inside can enter those.
    """
    outside, left, steps = spark.range(n, a * b).withColumnRenamed("id", "x"), a * b - n, 0
    while left:
        outside = written(outside.select(permute_once(F.col("x"), a, b, keys).alias("x")).where(F.col("x") >= n), "walk")
        steps, before, left = steps + 1, left, outside.count()
        if left == before:
            break
    return steps


def global_numbers(triples: DataFrame, keys: list[str], run: int = RUN) -> tuple[DataFrame, int]:
    """Rows with ``number``, their rank 0..N-1 by ``keys`` (nulls first), and N.

    A range shuffle deals out the counted keys, small per-range totals give
    each range its offset, and a running sum inside the range does the rest.
    Ranks do not depend on where the ranges are cut.
    """
    counted = triples.groupBy(*keys).agg(F.count("*").alias("copies"))
    ranged = written(counted.repartitionByRange(*keys).withColumn("part", F.spark_partition_id()), "ranged")
    totals = ranged.groupBy("part").agg(F.sum("copies").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per range
    offsets = written(totals.select("part", "n", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset")), "offsets")
    n = offsets.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()["n"]
    inside = Window.partitionBy("part").orderBy(*keys).rowsBetween(Window.unboundedPreceding, -1)
    first = F.col("offset") + F.coalesce(F.sum("copies").over(inside), F.lit(0))
    ends = ranged.join(F.broadcast(offsets.select("part", "offset")), "part").withColumn("first", first)
    ends = ends.withColumn("last", F.col("first") + F.col("copies") - 1)
    many = ends.where(F.col("copies") > run).withColumn("first", F.explode(F.sequence("first", "last", F.lit(run).cast("long"))))
    many = many.withColumn("last", F.least("last", F.col("first") + (run - 1))).repartition("first")
    runs = ends.where(F.col("copies") <= run).unionByName(many)
    return runs.select(*keys, F.explode(F.sequence("first", "last")).alias("number")), n


def shard_rows(docs: DataFrame, shards: int = 16, seed: int = 42, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, size, text_crc32, law, shard, slot, grown_shard, number, place.

    Law ``rows``: shard counts differ by at most one, slots are 0.. without a
    gap in every shard.  Size is UTF-8 bytes plus 1 (null text: 1, crc of the
    empty text).  Null ids come first in the numbering; repeated rows each get
    a place of their own; an empty table gives no rows.  Other columns of the
    input, whatever their names, are not read.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    triples = docs.select(
        F.col(id_col).alias("doc_id"),
        (F.octet_length(text).cast("long") + 1).alias("size"),
        F.crc32(text.cast("binary")).cast("long").alias("text_crc32"),
    )
    numbered, n = global_numbers(triples, ["doc_id", "text_crc32", "size"])
    a, b = rectangle(max(n, 1))
    keys = round_keys(seed)
    steps = longest_walk(docs.sparkSession, max(n, 1), a, b, keys)
    place = numbered.withColumn("place", walk(F.col("number"), max(n, 1), a, b, keys, steps))
    return place.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"),
        (F.col("place") % shards).cast("int").alias("shard"),
        F.expr(f"place div {int(shards)}").cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
        "number", "place",
    )
