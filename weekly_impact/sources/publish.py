"""S-7: result sets that readers see whole or not at all.

A publication is a folder of versions and a small file, ``CURRENT``, that
names the one to read.  A run writes all its tables into a new version folder
and then swaps the name by one atomic rename: a run that fails leaves the old
set in place, and a reader that resolved a version keeps reading it, as the
last ``KEEP`` versions stay.
"""

from __future__ import annotations

import datetime as _dt
import uuid

from pyspark.sql import DataFrame, SparkSession

from . import files

KEEP = 2


class Publication:
    """``root/CURRENT`` and ``root/versions/<version>/<table>``."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def current(self) -> str | None:
        """The version that readers see."""
        return files.read_text(self.spark, f"{self.root}/CURRENT")

    def path(self, table: str, version: str | None = None) -> str:
        """Where a table of a version (default: the current one) is."""
        version = version or self.current()
        if version is None:
            raise FileNotFoundError(f"nothing published under {self.root}")
        return f"{self.root}/versions/{version}/{table}"

    def stage(self) -> str:
        """A new version's name; nobody reads it before ``swap``."""
        return f"{_dt.datetime.now(_dt.timezone.utc):%Y%m%dT%H%M%S%f}-{uuid.uuid4().hex[:6]}"

    def swap(self, version: str) -> None:
        """Make ``version`` current, then delete versions before the last ``KEEP`` (unfinished ones too)."""
        files.replace_text(self.spark, f"{self.root}/CURRENT", version)
        for old in files.folders(self.spark, f"{self.root}/versions")[:-KEEP]:
            if old < version:
                files.delete(self.spark, f"{self.root}/versions/{old}")

    def abandon(self, version: str) -> None:
        """Delete an unfinished version."""
        files.delete(self.spark, f"{self.root}/versions/{version}")


def read_published(spark: SparkSession, root: str, table: str, fmt: str = "parquet") -> DataFrame:
    """A table of the current version."""
    return spark.read.format(fmt).load(Publication(spark, root).path(table))
