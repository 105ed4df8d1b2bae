"""The raw table: day partitions, one leaf folder per streamed batch, until batches are packed.

A packed folder is named after the range of batches it took in (`stream-00000000..00000041`). Readers
leave out what such a range covers, so that packing may leave the single batches for a while.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradelake.functions.calendar import Days, on_days, today
from tradelake.schemas import DAY_PARTS, RAW
from tradelake.session import empty
from tradelake.sources import paths
from tradelake.sources.tables import NULL_PARTITION, CatalogTable

# Between the first and the last batch number of a packed folder.
RANGE = ".."

# Innermost partition column: which stream and batch a folder came from. Not part of the table.
BATCH = "ingest"


def write_batch(rows: DataFrame, path: str, batch: str) -> None:
    """Write one batch so that writing it again replaces it instead of adding to it.

    A day's rows are gathered into files of the advisory size, a hot day's over several tasks.
    """
    (
        rows.hint("rebalance", *DAY_PARTS)
        .withColumn(BATCH, F.lit(batch))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*DAY_PARTS, BATCH)
        .parquet(path)
    )


def write_batch_into(rows: DataFrame, table: str, batch: str) -> None:
    """The same into a catalog table that has the batch as its last partition column."""
    CatalogTable(rows.sparkSession, table).replace_partitions(rows.withColumn(BATCH, F.lit(batch)), ())


def read_raw_table(
    spark: SparkSession, table: str, days: Days | str = "all", schema: T.StructType = RAW
) -> DataFrame:
    """Raw rows of a catalog table; the days are a predicate over its partition columns."""
    rows = spark.table(table).select(schema.fieldNames())
    return rows if days == "all" else rows.filter(on_days(today(spark) if days is None else days))


def read_raw(
    spark: SparkSession,
    path: str,
    days: Days | str = "all",
    schema: T.StructType = RAW,
) -> DataFrame:
    """Raw rows of the given days. A day lists only its own folder, several days those of their months."""
    if days is None:
        days = today(spark)
    folders = [path]
    if isinstance(days, date):
        folders = [f"{path}/ts_year={days.year}/ts_month={days.month}/ts_day={days.day}"]
    elif days != "all":
        folders = _month_folders(spark, path, days)
    full = T.StructType([*schema.fields, T.StructField(BATCH, T.StringType())])
    folders = [f for f in folders if paths.exists(spark, f)]
    reader = spark.read.schema(full).option("basePath", path)
    df = reader.parquet(*folders) if folders else empty(spark, full)
    stale = [f.removeprefix(f"{path}/") for f in covered(spark, path, folders)]
    if stale:
        df = df.filter(~leaf_of_row().isin(stale))
    rows = df.select(schema.fieldNames())
    return rows if days == "all" else rows.filter(on_days(days))


def leaf_of_row() -> Column:
    """The folder of a row's batch, below the table's; partition columns only."""
    value = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(NULL_PARTITION))
    return F.concat_ws("/", *(F.concat(F.lit(f"{c}="), value(c)) for c in (*DAY_PARTS, BATCH)))


def batch_range(name: str) -> tuple[str, int, int] | None:
    """Stream, first and last batch number of a leaf folder's batch; None for other names."""
    stream, _, numbers = name.rpartition("-")
    first, _, last = numbers.partition(RANGE)
    if not stream or not first.isdigit() or not (last or first).isdigit():
        return None
    return stream, int(first), int(last or first)


def covered_names(names: list[str]) -> list[str]:
    """Those of a day's batches that lie within another one's range."""
    ranges = {n: r for n in names if (r := batch_range(n))}
    wide = [(n, r) for n, r in ranges.items() if RANGE in n]
    return [
        n
        for n, (stream, first, last) in ranges.items()
        if any(n != m and s == stream and low <= first and last <= high for m, (s, low, high) in wide)
    ]


def covered(spark: SparkSession, path: str, folders: list[str]) -> list[str]:
    """Leaf folders below `folders` that a packed one stands for. Only days with a packed one are listed."""
    depth = len(DAY_PARTS)
    out = []
    days = set()
    for folder in folders:
        below = "/*" * (depth - folder.removeprefix(path).count("/"))
        packed = paths.glob(spark, f"{folder}{below}/{BATCH}=*{RANGE}*")
        days |= {p.rsplit("/", 1)[0] for p in packed}
    for day in sorted(days):
        names = [n.partition("=")[2] for n in paths.child_names(spark, day) if n.startswith(f"{BATCH}=")]
        out += [f"{day}/{BATCH}={n}" for n in covered_names(names)]
    return out


def _month_folders(
    spark: SparkSession, path: str, days: tuple[date, date] | frozenset[date]
) -> list[str]:
    """Existing month folders that may hold rows of the days."""

    def numbers(folder: str, part: str) -> list[int]:
        names = (n.partition("=") for n in paths.child_names(spark, folder))
        return [int(value) for name, _, value in names if name == part and value.isdigit()]

    first, last = (min(days), max(days)) if days else (date.max, date.min)
    single = None if isinstance(days, tuple) else {(d.year, d.month) for d in days}
    year_part, month_part, _ = DAY_PARTS
    return [
        f"{path}/{year_part}={year}/{month_part}={month}"
        for year in numbers(path, year_part)
        if first.year <= year <= last.year
        for month in numbers(f"{path}/{year_part}={year}", month_part)
        if (first.year, first.month) <= (year, month) <= (last.year, last.month)
        and (single is None or (year, month) in single)
    ]
