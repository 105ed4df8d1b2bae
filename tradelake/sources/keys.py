"""Which partitions may hold a key: sorted digests of the keys of each partition.

A row has some digests of one partition, of one slice of all digests. Rows are only ever added, before
the data they stand for, so that the digests cover the table's keys at any time; what they say too
much (keys that moved away) costs a look into a partition. `rebuild` writes them anew.
"""

from __future__ import annotations

from collections.abc import Sequence, Set

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradelake.session import stage
from tradelake.sources import paths
from tradelake.sources.tables import Partition, PartitionedTable

# Slices of the digests; one of a partition or an update is an array in memory.
SLICES = 64


class KeyIndex:
    """The digests beside a table's files, in a folder that readers of the table don't see."""

    def __init__(self, table: PartitionedTable, key: Sequence[str], slices: int = SLICES):
        self.table, self.key, self.slices = table, list(key), slices
        self.path = f"{table.location}/_keys"

    def _digests(self, rows: DataFrame, *by: str) -> DataFrame:
        """Sorted digests by slice; rows without a key never match and have none."""
        keyed = rows.dropna(subset=self.key).select(*by, F.xxhash64(*self.key).alias("digest"))
        return (
            keyed.withColumn("slice", F.pmod("digest", F.lit(self.slices)).cast("int"))
            .groupBy(*by, "slice")
            .agg(F.array_sort(F.collect_set("digest")).alias("digests"))
        )

    def _schema(self) -> T.StructType:
        parts = [T.StructField(c, self.table.schema[c].dataType) for c in self.table.partition_by]
        more = [T.StructField("slice", T.IntegerType()), T.StructField("digests", T.ArrayType(T.LongType()))]
        return T.StructType(parts + more)

    def add(self, rows: DataFrame) -> None:
        """Take in the keys of rows that are about to be written."""
        self._digests(rows, *self.table.partition_by).write.mode("append").parquet(self.path)

    def rebuild(self) -> None:
        """Scan the table's key columns once and replace the digests.

        The new ones are complete before the old ones go; a job that breaks off between finds none and
        builds them again.
        """
        spark = self.table.spark
        rows, path = stage(self._digests(self.table.read(), *self.table.partition_by), "keys")
        paths.remove(spark, self.path)
        rows.write.parquet(self.path)
        paths.remove(spark, path)

    def holding(self, updates: DataFrame) -> DataFrame:
        """Partition values of the partitions that may hold a key of `updates`.

        Reads digests only. A partition's slice and the updates' one are compared as sets; no pairs are made.
        """
        self._build()
        held = self.table.spark.read.schema(self._schema()).parquet(self.path)
        wanted = self._digests(updates).withColumnRenamed("digests", "wanted")
        found = held.join(wanted, "slice").filter(F.arrays_overlap("digests", "wanted"))
        return found.select(*self.table.partition_by).distinct()

    def _build(self) -> None:
        if not paths.exists(self.table.spark, f"{self.path}/_SUCCESS"):
            self.rebuild()

    def partitions(self, updates: DataFrame, known: Set[Partition] = frozenset()) -> set[Partition]:
        """Those of `holding` that the table has, with none of `known`; no digest is read if it has no others."""
        there = self.table.partitions()
        unknown = there - known
        if not unknown:
            if there:
                self._build()
            return set()
        return {tuple(row) for row in self.holding(updates).collect()} & unknown
