"""Day slices and raw-table columns."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tradelake.functions.calendar import Days, day_parts, on_days


def to_raw(records: DataFrame, ts: str = "timestamp") -> DataFrame:
    """Wire records to raw rows: date parts added, the time column named `ts`."""
    return records.withColumns(day_parts(ts)).withColumnRenamed(ts, "ts")


def day_slice(df: DataFrame, days: Days = None) -> DataFrame:
    """Rows of one day, of a range of days, of some days, or (None) of the current date."""
    return df.filter(on_days(days))
