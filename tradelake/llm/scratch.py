"""Intermediate tables and files of the operators, all below the session's shared folder."""

from __future__ import annotations

import atexit
from urllib.parse import urlparse

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession

from tradelake.session import scratch_path
from tradelake.sources import paths


class Scratch:
    """One operator call's folder; `drop` removes a part of it as soon as nothing reads it.

    What a returned DataFrame still reads stays until the application ends.
    """

    def __init__(self, spark: SparkSession, label: str):
        self.spark = spark
        self.root = scratch_path(spark, label)
        self._count = 0
        atexit.register(self.drop)

    def path(self, label: str) -> str:
        self._count += 1
        return f"{self.root}/{self._count:03d}-{label}"

    def table(self, df: DataFrame, label: str, *partition_by: str) -> tuple[DataFrame, str]:
        """Write rows once and read them back: lineage ends here, and sizes become known."""
        path = self.path(label)
        writer = df.write.partitionBy(*partition_by) if partition_by else df.write
        writer.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path), path

    def keep(self, df: DataFrame, label: str) -> DataFrame:
        return self.table(df, label)[0]

    def drop(self, path: str | None = None) -> None:
        try:
            paths.remove(self.spark, path or self.root)
        except Exception:  # at exit the session may be gone; the folder is then the user's
            if path:
                raise


def filesystem(path: str) -> tuple[fs.FileSystem, str]:
    """File system and path within it, for plain files that tasks write and read."""
    if urlparse(path).scheme in ("", "file"):
        return fs.LocalFileSystem(), urlparse(path).path
    return fs.FileSystem.from_uri(path)
