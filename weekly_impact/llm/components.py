"""Connected components of a link table, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import release
from .common import join_spread, written

MAX_ROUNDS = 60


def _least(edges: DataFrame) -> DataFrame:
    """(a, m, rows): the least b of each a and how many rows a has, for ``join_spread``; map-side minima first."""
    return written(edges.groupBy("a").agg(F.min("b").alias("m"), F.count("*").alias("rows")), "least")


def _large_star(edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Each node's larger neighbours are linked to the least of its neighbours and itself."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = _least(both)
    out = join_spread(both, least, ["a"], "rows").where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.least("a", "m").alias("b"))
    return out, least


def _small_star(edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Each node and its smaller neighbours are linked to the least of them (a > b in every row)."""
    least = _least(edges)
    down = join_spread(edges, least, ["a"], "rows").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
    return down.unionByName(least.select("a", F.col("m").alias("b"))), least


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): the least node that links reach, for every node with a link to another one.

    Large-star and small-star steps (joins and pre-aggregated minima) until
    the links no longer change; each round is a table in the shared folder,
    and the last round's tables are deleted.  No component is ever held in one
    task, and the neighbours of a hub are not either: its row of the small
    side is broadcast (see ``join_spread``).  Self-links, repeated links and
    links with a null end change nothing.
    """
    edges = links.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b"))
    edges = written(edges.where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col("a") > F.col("b"))).distinct(), "links")
    seen = None
    for _ in range(MAX_ROUNDS):
        large, least1 = _large_star(edges)
        large = written(large.where("a > b").distinct(), "links")
        small, least2 = _small_star(large)
        new = written(small.distinct(), "links")
        release(edges, large, least1, least2)
        edges = new
        now = edges.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.lit(0)).alias("h")).first()
        if now == seen:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
                edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
        seen = now
    raise RuntimeError("components did not settle")
