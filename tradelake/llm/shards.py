"""Deterministic range shards and the commit of files that tasks have written."""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradelake.llm.scratch import filesystem
from tradelake.sources import paths

# Keys looked at per shard to place its bounds.
KEYS_PER_SHARD = 64


def with_shard(
    rows: DataFrame,
    key: str,
    shards: int,
    among: DataFrame | None = None,
    tie: Column | None = None,
) -> DataFrame:
    """Add `shard`, the range of (`key`, `tie`) that a row lies in; ranges have about as many different ones.

    Bounds come from the pairs of `among` (default: the rows) with the smallest hashes: a sample of a
    size set by the number of shards, that is the same in every run. Each pair counts once, so
    a frequent one does not fill the sample. Nulls come first. `tie` (long, never null) splits the rows of
    one key, or those without any, over shards; without it they lie together.
    """
    among = rows if among is None else among
    tie = F.lit(0).cast("long") if tie is None else tie
    picked = (
        among.select(F.col(key).cast("long").alias("key"), tie.alias("tie"))
        .distinct()
        .orderBy(F.xxhash64("key", "tie"), "key", "tie")
        .limit(KEYS_PER_SHARD * shards)
    )
    pairs = sorted((r.key is not None, r.key or 0, r.tie) for r in picked.collect())
    bounds = [pairs[len(pairs) * i // shards] for i in range(1, shards)] if pairs else []
    known, keys, ties = (np.array([b[i] for b in bounds], np.int64) for i in range(3))

    @F.pandas_udf("int")
    def of(has: pd.Series, number: pd.Series, second: pd.Series) -> pd.Series:
        # Bounds go before the rows that equal them: a row's shard is the number of bounds so far.
        row = np.arange(len(known) + len(has)) >= len(known)
        order = np.lexsort(
            (
                row,
                np.concatenate([ties, second.to_numpy(np.int64)]),
                np.concatenate([keys, number.to_numpy(np.int64)]),
                np.concatenate([known, has.to_numpy(np.int64)]),
            )
        )
        shard = np.empty(len(order), np.int32)
        shard[order] = np.cumsum(~row[order])
        return pd.Series(shard[len(known) :])

    number = F.col(key).cast("long")
    # Apart, as a null would turn a column of whole numbers into one of floats.
    return rows.withColumn("shard", of(number.isNotNull(), F.coalesce(number, F.lit(0)), tie))


def shard_count(spark: SparkSession, size: int, target: int, least: int) -> int:
    """As many shards as `size` fills at `target` bytes, or as there are tasks to keep busy."""
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return max(1, -(-size // target), min(tasks, size // least))


def in_shards(rows: DataFrame, shards: int, *order: str | Column) -> DataFrame:
    """A task for each shard, with its rows in order."""
    return rows.repartitionById(shards, "shard").sortWithinPartitions("shard", *order)


class OutputFile:
    """A file under a temporary name of this attempt alone; the driver gives it its final one."""

    def __init__(self, folder: str, name: str, attempt: str):
        self.final, self.temporary = name, f"{name}.{attempt}.tmp"
        system, path = filesystem(f"{folder}/{self.temporary}")
        self._stream = system.open_output_stream(path)
        self.size = 0

    def write(self, raw: bytes) -> None:
        self._stream.write(raw)
        self.size += len(raw)

    def close(self) -> None:
        self._stream.close()


def attempt_name() -> str:
    import uuid

    return uuid.uuid4().hex


def commit(manifest: DataFrame, folder: str) -> list:
    """Rename the files of the attempts that succeeded, then publish the manifest.

    The manifest table is written first under a temporary name: Spark keeps the rows of one attempt
    of each task only, so files of lost attempts are in no manifest and never get a final name. A
    reader goes by the published manifest. Returns its rows, one for each file.
    """
    spark = manifest.sparkSession
    pending, done = f"{folder}/_manifest.tmp", f"{folder}/_manifest"
    manifest.write.parquet(pending)
    rows = spark.read.schema(manifest.schema).parquet(pending).orderBy("shard", "part").collect()
    for row in rows:
        paths.rename(spark, f"{folder}/{row.temporary}", f"{folder}/{row.file}")
    paths.rename(spark, pending, done)
    for name in paths.child_names(spark, folder):
        if name.endswith(".tmp"):
            paths.remove(spark, f"{folder}/{name}")
    return rows


def manifest_of(spark: SparkSession, folder: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).parquet(f"{folder}/_manifest")


def each_file(rows: list, spark: SparkSession, schema: T.StructType) -> DataFrame:
    """Manifest rows as a table with a task for each file."""
    files = spark.createDataFrame(rows, schema)
    return files.repartition(max(len(rows), 1))


def read_files(files: DataFrame, read, schema, **options) -> DataFrame:
    """Apply `read(row, **options)`, which yields Arrow batches, to each file of a manifest."""
    return files.mapInArrow(partial(_each, read=read, options=options), schema)


def _each(batches: Iterator[pa.RecordBatch], read, options) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            yield from read(row, **options)
