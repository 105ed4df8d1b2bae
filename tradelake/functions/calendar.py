"""Date parts, day predicates and the day-based names of files, topics and messages."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from tradelake.schemas import DAY_PARTS

# One day, an inclusive range of days, some days, or None for the current date.
Days = date | tuple[date, date] | frozenset[date] | None


def today(spark: SparkSession) -> date:
    """The current date in the session's time zone."""
    return spark.range(1).select(F.current_date()).first()[0]


def among(day: Column, days: date | tuple[date, date] | frozenset[date]) -> Column:
    """Whether a date is one of the days; NULL for a NULL date."""
    if isinstance(days, tuple):
        return day.between(*map(F.lit, days))
    if isinstance(days, frozenset):
        return day.isin(sorted(days))
    return day == F.lit(days)


def day_parts(ts: str) -> dict[str, Column]:
    """`ts_year`, `ts_month`, `ts_day` of a timestamp column."""
    return {"ts_year": F.year(ts), "ts_month": F.month(ts), "ts_day": F.day(ts)}


def on_days(days: Days) -> Column:
    """Predicate over the day partition columns only, so the scan can prune by it."""
    year, month, day = (F.col(c) for c in DAY_PARTS)
    if days is None:
        today = F.current_date()
        return (year == F.year(today)) & (month == F.month(today)) & (day == F.day(today))
    if not isinstance(days, date):
        # The years let a store drop whole years before it evaluates the date.
        if isinstance(days, tuple):
            years = year.between(days[0].year, days[1].year)
        else:
            years = year.isin(sorted({d.year for d in days}))
        return years & among(F.make_date(year, month, day), days)
    return (year == days.year) & (month == days.month) & (day == days.day)


def day_label(day: date) -> str:
    """Unpadded `year_month_day`."""
    return f"{day.year}_{day.month}_{day.day}"


def day_name(day: date) -> str:
    """Name shared by the day file and the day topic."""
    return f"stock_transactions_{day_label(day)}"


def message_key(day: date, offset: Column) -> Column:
    return F.concat_ws("_", F.lit(day_label(day)), offset.cast("string"))


def transaction_id(number: Column, width: int = 7) -> Column:
    """`tx_` and a zero-padded number; longer numbers keep all their digits."""
    digits = number.cast("string")
    return F.concat(F.lit("tx_"), F.lpad(digits, F.greatest(F.length(digits), F.lit(width)), F.lit("0")))
