"""Day-wise writes of summary rows: replace a day, or append to it."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradelake.functions.calendar import among
from tradelake.session import staged
from tradelake.sources.tables import CatalogTable, PartitionedTable

DAY = "report_date"


def replace_days(
    table: PartitionedTable, rows: DataFrame, days: date | tuple[date, date] | frozenset[date] | None = None
) -> None:
    """Make `rows` the only rows of their days; other days of the same month stay.

    `days` names the days to replace, so that a day without any new row is emptied, and rows of
    other days or without a date are left out. Without it, the days that occur in `rows` are
    replaced; rows without a date count as a day of their own.
    """
    columns = table.schema.fieldNames()
    if days is None:
        with staged(rows, "replace-days") as new:
            touched = table.distinct_partitions(new)
            dates = new.select(F.col(DAY).alias("_day")).distinct()
            other = table.read(touched).join(dates, F.col(DAY).eqNullSafe(F.col("_day")), "left_anti")
            table.replace_partitions(other.select(columns).unionByName(new), touched)
            return
    inside = F.coalesce(among(F.col(DAY), days), F.lit(False))
    if isinstance(table, CatalogTable) and table.row_level:
        rows.select(columns).filter(inside).writeTo(table.name).overwrite(inside)
        return
    touched = {p for p in table.partitions() if None not in p and _in_month(p, days)}
    merged = table.read(touched).filter(~inside).unionByName(rows.filter(inside))
    table.replace_partitions(merged, touched)


def _in_month(month: tuple[int, int], days: date | tuple[date, date] | frozenset[date]) -> bool:
    if isinstance(days, tuple):
        first, last = days
        return (first.year, first.month) <= month <= (last.year, last.month)
    return month in {(d.year, d.month) for d in ([days] if isinstance(days, date) else days)}


def append_rows(table: PartitionedTable, rows: DataFrame) -> None:
    """Add `rows` as they are: running it twice gives two rows per key."""
    table.append(rows)
