"""What each streamed batch brought: the days it touched, and which of them were cleaned since."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradelake.session import empty
from tradelake.sources import paths

_ENTRY = T.StructType(
    [
        T.StructField("day", T.DateType()),
        T.StructField("rows", T.LongType()),
        T.StructField("batch", T.StringType()),
    ]
)


class Ledger:
    """Two small tables in a folder: entries, written with each batch, and marks of cleaned entries.

    A batch that is written again replaces its entry. A day without a date (null) is kept, and never
    asked for.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def add(self, batch: str, days: list[date | None], rows: int) -> None:
        """One row per day of the batch; `rows` is the whole batch's number."""
        entry = self.spark.createDataFrame([(d, rows, batch) for d in days], _ENTRY).coalesce(1)
        writer = entry.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy("batch").parquet(f"{self.path}/entries")

    def _read(self, name: str) -> DataFrame:
        place = f"{self.path}/{name}"
        if not paths.exists(self.spark, place):
            return empty(self.spark, _ENTRY)
        return self.spark.read.schema(_ENTRY).parquet(place)

    def entries(self) -> DataFrame:
        return self._read("entries")

    def pending(self) -> DataFrame:
        """Entries that no mark says are cleaned."""
        marks = self._read("marks").select("batch", F.col("day").alias("_day"))
        same = (F.col("e.batch") == F.col("m.batch")) & F.col("e.day").eqNullSafe(F.col("m._day"))
        return self.entries().alias("e").join(marks.alias("m"), same, "left_anti")

    def mark(self, cleaned: DataFrame) -> None:
        """Note entries as cleaned; saying it twice is no harm."""
        cleaned.select("day", "rows", "batch").coalesce(1).write.mode("append").parquet(f"{self.path}/marks")
