"""Small helpers that several operators share."""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialize

# Upper bound of the rows that one Arrow batch builds results for at a time.
SLICE_ROWS = 256


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables; only Spark opens the path."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def text_of(col: str = "text") -> Column:
    """The text, with null read as the empty text."""
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


def without(df: DataFrame, *names: str) -> DataFrame:
    """``df`` without columns that clash (in any case) with the names an operator adds."""
    low = {n.lower() for n in names}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in low])


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the shared checkpoint folder (lineage cut, survives lost executors)."""
    return materialize(df, f"llm-{name}")


def slices(batches, rows: int = SLICE_ROWS):
    """Arrow batches cut into pieces of at most ``rows`` rows."""
    for b in batches:
        for i in range(0, b.num_rows, rows):
            yield b.slice(i, rows)


HOT_KEYS = 1000


def join_spread(big: DataFrame, small: DataFrame, on: list[str], rows: str, how: str = "left") -> DataFrame:
    """``big`` joined (left or inner) with ``small``, a written table; ``rows``: how many rows of ``big`` have the key.

    Keys with over a ``HOT_KEYS``-th of all counted rows are at most
    ``HOT_KEYS`` many, whatever the data: they are broadcast, so that their
    rows stay where they are, and the rest is shuffled without a hot key.
    """
    total = small.agg(F.sum(rows)).first()[0] or 0
    hot = F.broadcast(small.where(F.col(rows) * HOT_KEYS > total).drop(rows))
    cold = small.where(F.col(rows) * HOT_KEYS <= total).drop(rows)
    return big.join(hot, on).unionByName(big.join(hot.select(*on), on, "left_anti").join(cold, on, how))


def ordered_digest(pieces: DataFrame, key: str, order: list[str], text: str, between: str = "", into: str = "sha256") -> DataFrame:
    """(key, digest): lowercase hex SHA-256 of each key's texts, in order, with ``between`` between them.

    Spark sorts (and spills); a task reads one Arrow batch at a time and holds
    one running hash, so a key of any size needs no memory of its size.  The
    hash of one key is sequential by its definition, so one task reads all of
    a key's rows.
    """

    def run(batches):
        now, state, sep = None, None, between.encode()
        for b in batches:
            keys, digests = [], []
            for k, t in zip(b.column(key).to_pylist(), b.column(text).to_pylist()):
                if state is None or k != now:
                    if state is not None:
                        keys.append(now)
                        digests.append(state.hexdigest())
                    now, state = k, hashlib.sha256()
                else:
                    state.update(sep)
                state.update(t.encode())
            if keys:
                yield pa.RecordBatch.from_arrays([pa.array(keys, kind), pa.array(digests, pa.string())], [key, into])
        if state is not None:
            yield pa.RecordBatch.from_arrays([pa.array([now], kind), pa.array([state.hexdigest()])], [key, into])

    dtype = pieces.schema[key].dataType.simpleString()
    kind = pa.int64() if dtype == "bigint" else pa.string()
    dealt = pieces.select(key, *order, text).repartition(key).sortWithinPartitions(key, *order)
    return dealt.select(key, text).mapInArrow(run, f"{key} {dtype}, {into} string")
