"""Partitioned tables, by folder or by catalog name, changed by Spark's own writers.

Partitions are replaced by a dynamic overwrite: Spark writes new files aside and moves them into the
partitions that have rows, so that the rows may come from the table itself. Partitions that end
up without rows are dropped after it. A file table has no transaction over all its partitions: a job that
breaks off during the last moves leaves some partitions replaced and others not, and is to be run
again. Tables of a catalog with row-level operations are changed by those, in one commit.
"""

from __future__ import annotations

from abc import ABC, abstractmethod
from collections.abc import Iterable, Iterator, Sequence
from contextlib import contextmanager
from threading import Lock

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradelake.schemas import TableSpec
from tradelake.session import empty, observed
from tradelake.sources import paths
from tradelake.sources.layout import by_partition

# Fixed value: the folder name of a null partition value.
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"

# Formats whose tables Spark's file writers change.
FILE_FORMATS = ("parquet", "orc", "json", "csv", "avro")

_DYNAMIC = "spark.sql.sources.partitionOverwriteMode"

# Partition values of one partition, in the order of the table's partition columns.
Partition = tuple[int | None, ...]


class PartitionedTable(ABC):
    """Partition columns must be integers, as they all are here."""

    spark: SparkSession
    schema: T.StructType
    partition_by: tuple[str, ...]

    @abstractmethod
    def partitions(self) -> set[Partition]:
        """The partitions there are; bounded by their number, not by the rows."""

    @abstractmethod
    def read(self, only: Iterable[Partition] | None = None) -> DataFrame:
        """All rows, or those of some partitions, opening no others."""

    @abstractmethod
    def append(self, df: DataFrame) -> None:
        """Add rows as they are."""

    @abstractmethod
    def _overwrite(self, df: DataFrame) -> None:
        """Replace every partition that `df` has rows of."""

    @abstractmethod
    def _drop(self, gone: set[Partition]) -> None:
        """Remove partitions with their files."""

    @property
    @abstractmethod
    def location(self) -> str:
        """The folder of the table's files."""

    def distinct_partitions(self, df: DataFrame) -> set[Partition]:
        return {tuple(row) for row in df.select(*self.partition_by).distinct().collect()}

    def replace_partitions(self, df: DataFrame, touched: Iterable[Partition]) -> None:
        """Make `df` the whole content of its own partitions and of the `touched` ones.

        `df` may read this table. Which partitions it has is noticed while it is written.
        """
        seen = Observation()
        parts = F.collect_set(F.struct(*self.partition_by)).alias("parts")
        self._overwrite(df.select(self.schema.fieldNames()).observe(seen, F.count(F.lit(1)).alias("rows"), parts))
        written = {tuple(row) for row in observed(seen).get("parts") or ()}
        gone = set(touched) - written
        if gone:
            self._drop(gone & self.partitions())

    def where(self, partitions: Iterable[Partition]) -> Column:
        """A predicate over partition columns only; the first one's values let catalogs prune early."""
        wanted = sorted(set(partitions), key=str)
        if not wanted:
            return F.lit(False)
        name = F.concat_ws("/", *(F.coalesce(F.col(c).cast("string"), F.lit("-")) for c in self.partition_by))
        exact = name.isin(["/".join("-" if v is None else str(v) for v in p) for p in wanted])
        firsts = {p[0] for p in wanted}
        if None in firsts:
            return exact
        return F.col(self.partition_by[0]).isin(sorted(firsts)) & exact


class FolderTable(PartitionedTable):
    """A Parquet table that is known by its folder alone."""

    def __init__(
        self, spark: SparkSession, root: str, schema: T.StructType, partition_by: Sequence[str]
    ):
        self.spark = spark
        self.root = root.rstrip("/")
        self.schema = schema
        self.partition_by = tuple(partition_by)

    @classmethod
    def of(cls, spark: SparkSession, warehouse: str, spec: TableSpec) -> FolderTable:
        root = f"{warehouse.rstrip('/')}/{spec.database}/{spec.name}"
        return cls(spark, root, spec.schema, spec.partition_by)

    @property
    def location(self) -> str:
        return self.root

    def _folder(self, partition: Partition) -> str:
        parts = (
            f"{name}={NULL_PARTITION if value is None else value}"
            for name, value in zip(self.partition_by, partition)
        )
        return "/".join([self.root, *parts])

    def partitions(self) -> set[Partition]:
        found: list[Partition] = [()]
        for name in self.partition_by:
            found = [(*p, _value(v)) for p in found for v in self._children(p, name)]
        return set(found)

    def _children(self, partition: Partition, name: str) -> list[str]:
        names = (n.partition("=") for n in paths.child_names(self.spark, self._folder(partition)))
        return [value for key, _, value in names if key == name]

    def read(self, only: Iterable[Partition] | None = None) -> DataFrame:
        folders = [self.root] if paths.exists(self.spark, self.root) else []
        if only is not None:
            folders = [self._folder(p) for p in sorted(set(only) & self.partitions(), key=str)]
        if not folders:
            return empty(self.spark, self.schema)
        reader = self.spark.read.schema(self.schema).option("basePath", self.root)
        return reader.parquet(*folders).select(self.schema.fieldNames())

    def append(self, df: DataFrame) -> None:
        rows = by_partition(df.select(self.schema.fieldNames()), self.partition_by)
        rows.write.mode("append").partitionBy(*self.partition_by).parquet(self.root)

    def _overwrite(self, df: DataFrame) -> None:
        writer = by_partition(df, self.partition_by).write.mode("overwrite")
        writer.option("partitionOverwriteMode", "dynamic").partitionBy(*self.partition_by).parquet(self.root)

    def _drop(self, gone: set[Partition]) -> None:
        for partition in gone:
            paths.remove(self.spark, self._folder(partition))


class CatalogTable(PartitionedTable):
    """A table of a catalog, known by its name."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.name = name
        self.schema = T.StructType([T.StructField(f.name, f.dataType) for f in spark.table(name).schema])
        columns = spark.catalog.listColumns(name)
        self.partition_by = tuple(c.name for c in columns if c.isPartition)

    def _described(self, what: str) -> str:
        rows = self.spark.sql(f"DESCRIBE TABLE EXTENDED {self.name}").filter(F.col("col_name") == what)
        return rows.first().data_type

    @property
    def location(self) -> str:
        return self._described("Location")

    @property
    def row_level(self) -> bool:
        """Whether the table is changed by row-level operations, not by replacing partitions."""
        return self._described("Provider").lower() not in FILE_FORMATS

    def partitions(self) -> set[Partition]:
        shown = self.spark.sql(f"SHOW PARTITIONS {self.name}").collect()
        return {tuple(_value(part.partition("=")[2]) for part in row[0].split("/")) for row in shown}

    def read(self, only: Iterable[Partition] | None = None) -> DataFrame:
        df = self.spark.table(self.name)
        return df if only is None else df.filter(self.where(only))

    def append(self, df: DataFrame) -> None:
        rows = df.select(self.schema.fieldNames())
        if self.row_level:
            rows.writeTo(self.name).append()
        else:
            by_partition(rows, self.partition_by).write.insertInto(self.name)

    def _overwrite(self, df: DataFrame) -> None:
        if self.row_level:
            df.writeTo(self.name).overwritePartitions()
            return
        with _dynamic_overwrite(self.spark):
            by_partition(df, self.partition_by).write.insertInto(self.name, overwrite=True)

    def _drop(self, gone: set[Partition]) -> None:
        if self.row_level:
            for partition in gone:
                pairs = zip(self.partition_by, partition)
                same = " AND ".join(f"{n} <=> {'NULL' if v is None else v}" for n, v in pairs)
                self.spark.sql(f"DELETE FROM {self.name} WHERE {same}")
            return
        for partition in gone:
            parts = ", ".join(
                f"{name}={'NULL' if value is None else value}"
                for name, value in zip(self.partition_by, partition)
            )
            self.spark.sql(f"ALTER TABLE {self.name} DROP IF EXISTS PARTITION ({parts})")


def _value(text: str) -> int | None:
    return None if text in (NULL_PARTITION, "null") else int(text)


_writing: dict[str, list] = {}
_lock = Lock()


@contextmanager
def _dynamic_overwrite(spark: SparkSession) -> Iterator[None]:
    """The session overwrites partitions dynamically as long as any such block is open in it."""
    session = str(spark._jsparkSession.hashCode())
    with _lock:
        count, before = _writing.get(session) or [0, spark.conf.get(_DYNAMIC)]
        _writing[session] = [count + 1, before]
        spark.conf.set(_DYNAMIC, "dynamic")
    try:
        yield
    finally:
        with _lock:
            count, before = _writing[session]
            _writing[session] = [count - 1, before]
            if count == 1:
                spark.conf.set(_DYNAMIC, before)
                del _writing[session]

