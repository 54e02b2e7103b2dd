"""Small files and folders through Hadoop's file systems, so that any store Spark reads will do."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def _path(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _path(spark, path)
    return fs.exists(p)


def delete(spark: SparkSession, path: str) -> None:
    fs, p = _path(spark, path)
    fs.delete(p, True)


def size(spark: SparkSession, uris: list[str]) -> int:
    """Bytes of files named as ``DataFrame.inputFiles`` does; of folders that many of them lie in, the whole folder's."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    by_folder: dict[str, list[str]] = {}
    for uri in uris:
        by_folder.setdefault(uri.rpartition("/")[0], []).append(uri)
    total = 0
    for folder, inside in by_folder.items():
        for uri in inside if len(inside) <= 16 else [folder]:
            p = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(uri))
            total += p.getFileSystem(conf).getContentSummary(p).getLength()
    return total


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the sub-folders of ``path``, sorted; none if it isn't there."""
    fs, p = _path(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory()) if fs.exists(p) else []


def read_text(spark: SparkSession, path: str) -> str | None:
    """A small file's text; None if it isn't there."""
    fs, p = _path(spark, path)
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def replace_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file beside ``path`` and rename it over ``path``: readers see the old text or the new one.

    The rename is atomic on HDFS and local file systems; object stores may
    copy instead, where a reader still never sees half a file.
    """
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    fs, p = _path(spark, path)
    fs.mkdirs(p.getParent())
    fs, new = _path(spark, f"{path}.{uuid.uuid4().hex[:12]}")
    stream = fs.create(new, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    kind = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    options = spark.sparkContext._gateway.new_array(kind, 1)
    options[0] = kind.OVERWRITE
    jvm.org.apache.hadoop.fs.FileContext.getFileContext(p.toUri(), conf).rename(new, p, options)
