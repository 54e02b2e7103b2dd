"""Session helpers: local test sessions and the shared checkpoint folder."""

from __future__ import annotations

import atexit
import contextlib
import contextvars
import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

from .sources import files

# Settings every job relies on: UTC dates, ANSI, AQE (runtime coalescing,
# skew-join splitting and size-checked broadcast conversion).
JOB_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, app: str = "weekly_impact") -> SparkSession:
    """A local[N] session for tests and the bench (UI off, no server started)."""
    b = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "8g")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        # Local cores only: let AQE coalesce small shuffles, but not below
        # 64 KB, so CPU-heavy aggregates keep one task per core.
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64k")
    )
    for k, v in JOB_CONF.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster the setting names shared storage and is only read here; its
    absence is an error there.  A local folder is set only under a local
    master that has none (tests, local bench).
    """
    global _LOCAL_DIR
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - sessions without a local context (Spark Connect)
        sc = None
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d and sc is not None:
        d = sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not d:
        master = sc.master if sc is not None else "remote"
        if master != "local" and not master.startswith("local["):
            raise ValueError(f"set spark.checkpoint.dir to a folder that all executors share (master {master})")
        if _LOCAL_DIR is None:
            _LOCAL_DIR = tempfile.mkdtemp(prefix="wi-ckpt-", dir="/tmp")
        d = _LOCAL_DIR
    if sc is not None and not sc.getCheckpointDir():
        sc.setCheckpointDir(d)
    return d


_LOCAL_DIR: str | None = None


class _Scratch:
    """The scratch tables of one scope."""

    def __init__(self):
        self.paths: list[str] = []

    def drop(self, spark: SparkSession) -> None:
        while self.paths:
            files.delete(spark, self.paths.pop())


_SCOPE: contextvars.ContextVar[_Scratch] = contextvars.ContextVar("scratch", default=_Scratch())


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint folder for a written table; it belongs to the innermost scope."""
    path = os.path.join(ensure_checkpoint_dir(spark), f"{name}-{uuid.uuid4().hex[:12]}")
    _SCOPE.get().paths.append(path)
    return path


@contextlib.contextmanager
def scratch_scope(spark: SparkSession):
    """Scratch tables made inside are deleted at the end, also if it fails.

    Nothing that is read later may depend on them: write results inside.
    Scopes nest, and each thread has its own.
    """
    own = _Scratch()
    token = _SCOPE.set(own)
    try:
        yield own
    finally:
        _SCOPE.reset(token)
        own.drop(spark)


def release(*tables: DataFrame) -> None:
    """Delete tables of ``materialize`` that nothing reads any more (loops: the last round's)."""
    for df in tables:
        path = getattr(df, "_scratch", None)
        if path:
            files.delete(df.sparkSession, path)
            with contextlib.suppress(ValueError):
                _SCOPE.get().paths.remove(path)


# Input bytes meant for one shuffle partition: rows of item events take some fifty times their Parquet bytes in a sort or hash map.
PARTITION_BYTES = 8 << 20
# Input bytes of one scan task: with over 200 shuffle partitions, a task holds its shuffled rows before it writes them.
SPLIT_BYTES = 16 << 20
SHUFFLE_PARTITIONS = "spark.sql.shuffle.partitions"
TARGET_BYTES = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
MAX_SPLIT_BYTES = "spark.sql.files.maxPartitionBytes"


def partitions_for(df: DataFrame) -> int:
    """Shuffle partitions that the files ``df`` is read from ask for (0 without files)."""
    return -(-files.size(df.sparkSession, df.inputFiles()) // PARTITION_BYTES)


@contextlib.contextmanager
def sized_shuffles(df: DataFrame):
    """What runs inside shuffles to as many partitions as the input of ``df`` asks for; yields whether the session's settings fall short.

    The runtime joins partitions to its target size and splits skewed ones as
    ever.  With a fixed number of partitions each task's rows, and the memory
    of its sorts and hash maps, would grow with the input; with Spark's target
    of 64 MB they would as well, up to eight partitions' worth, as soon as the
    cores have more than that.  So the target is held at one partition's bytes
    and scan tasks at theirs; smaller settings of the session stay.
    """
    spark = df.sparkSession
    conf, n = spark.conf, partitions_for(df)
    in_bytes = spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes
    before = {k: conf.get(k) for k in (SHUFFLE_PARTITIONS, TARGET_BYTES, MAX_SPLIT_BYTES)}
    held = {
        SHUFFLE_PARTITIONS: str(max(n, int(before[SHUFFLE_PARTITIONS]))),
        TARGET_BYTES: str(min(PARTITION_BYTES, in_bytes(before[TARGET_BYTES]))),
        MAX_SPLIT_BYTES: str(min(SPLIT_BYTES, in_bytes(before[MAX_SPLIT_BYTES]))),
    }
    # Up to a partition for each core, the runtime leaves every core its own.
    if n <= min(int(before[SHUFFLE_PARTITIONS]), spark.sparkContext.defaultParallelism):
        yield False
        return
    try:
        for k, v in held.items():
            conf.set(k, v)
        yield True
    finally:
        for k, v in before.items():
            conf.set(k, v)


def materialize_sized(df: DataFrame, name: str = "stage", partition_by: tuple[str, ...] = ()) -> DataFrame:
    """``materialize`` with the shuffles that the input of ``df`` asks for."""
    with sized_shuffles(df):
        return materialize(df, name, partition_by)


def settle(df: DataFrame, name: str = "settled") -> DataFrame:
    """``df`` itself; with an input too large for the session's settings, ``df`` computed in enough shuffle partitions and stored.

    For small results of large shuffles: weekly rows, not items or users.
    """
    with sized_shuffles(df) as more:
        return materialize(df, name) if more else df


def materialize_bucketed(df: DataFrame, keys: list[str], name: str = "buckets", buckets: int | None = None) -> DataFrame:
    """``materialize``, bucketed and sorted by ``keys``: aggregates and joins on all of them need no exchange.

    One file per bucket (as many as shuffle partitions by default).  The table
    is external (its files belong to the scratch scope) and is known to the
    session's catalog under a name of its own.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    n = buckets or int(spark.conf.get(SHUFFLE_PARTITIONS))
    known = f"scratch_{uuid.uuid4().hex}"
    dealt = df.repartition(n, *keys)
    dealt.write.mode("overwrite").option("path", path).bucketBy(n, *keys).sortBy(*keys).saveAsTable(known)
    return spark.table(known)


def _drop_at_exit() -> None:
    """Outside all scopes: what lazy results were read from goes when the program ends."""
    with contextlib.suppress(Exception):  # a stopped context can't delete any more
        spark = SparkSession.getActiveSession()
        if spark is not None:
            _SCOPE.get().drop(spark)


def materialize(df: DataFrame, name: str = "stage", partition_by: tuple[str, ...] = ()) -> DataFrame:
    """Compute ``df`` once, write it as a Parquet table in the shared folder, read it back.

    For a plan that feeds several branches (a top-K list and the rows it
    filters, two grains of one query): the optimizer rewrites each branch
    differently, so their shuffles are not reused and the scan, join and
    unnest would run once per branch.  The table lands under the session's
    ``spark.checkpoint.dir`` (shared storage on a cluster), so the lineage is
    cut and a lost executor does not force recomputation from the scan; it
    is columnar, so each branch reads only the columns it needs (never
    ``localCheckpoint``, which lives on executors).  ``partition_by`` lays it
    out by columns of few values, so that filters on them skip whole folders.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._scratch = path
    return out


atexit.register(_drop_at_exit)
