"""Catalog databases and tables."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tradelake.schemas import BRONZE, TABLES, TableSpec
from tradelake.sources.layout import by_partition
from tradelake.sources.raw import BATCH


# The raw table of file formats, where a streamed batch is a partition and can replace itself.
RAW_BY_BATCH = TableSpec(
    BRONZE.database,
    BRONZE.name,
    T.StructType([*BRONZE.schema.fields, T.StructField(BATCH, T.StringType())]),
    (*BRONZE.partition_by, BATCH),
)


def table_name(spec: TableSpec, prefix: str = "") -> str:
    return f"{prefix}{spec.database}.{spec.name}"


def create_table_sql(spec: TableSpec, prefix: str = "", using: str = "parquet") -> str:
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in spec.schema)
    return (
        f"CREATE TABLE IF NOT EXISTS {table_name(spec, prefix)} ({columns}) "
        f"USING {using} PARTITIONED BY ({', '.join(spec.partition_by)})"
    )


def create_tables(
    spark: SparkSession,
    specs: Iterable[TableSpec] = TABLES,
    prefix: str = "",
    using: str = "parquet",
    location: str | None = None,
) -> None:
    """Create databases and tables that do not exist yet.

    `prefix` goes before the database name, a catalog (`"lake."`) or part of the name;
    `location` is the folder new databases are put in.
    """
    specs = list(specs)
    for database in dict.fromkeys(f"{prefix}{spec.database}" for spec in specs):
        place = f" LOCATION '{location}/{database}'" if location else ""
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}{place}")
    for spec in specs:
        spark.sql(create_table_sql(spec, prefix, using))


def drop_databases(
    spark: SparkSession, specs: Iterable[TableSpec] = TABLES, prefix: str = ""
) -> None:
    """Drop the databases of the tables, with all that is in them."""
    for database in dict.fromkeys(f"{prefix}{spec.database}" for spec in specs):
        spark.sql(f"DROP DATABASE IF EXISTS {database} CASCADE")


def append_to(df: DataFrame, spec: TableSpec, prefix: str = "") -> None:
    """INSERT INTO a partitioned table, whose partition columns come last in its schema."""
    rows = df.select(df.sparkSession.table(table_name(spec, prefix)).columns)
    by_partition(rows, spec.partition_by).write.insertInto(table_name(spec, prefix))
