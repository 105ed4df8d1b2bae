"""Minute grids and lookups."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import time

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradelake.functions.minutes import (
    SESSION_CLOSE,
    SESSION_OPEN,
    STEP_SECONDS,
    at_time,
    minute_index,
    session_minute,
)


def lookup(df: DataFrame, dimension: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Left join with a table that has one row per key.

    No broadcast hint: the planner broadcasts the dimension when its measured size is below
    `spark.sql.autoBroadcastJoinThreshold`, and otherwise shuffles both sides, where adaptive
    execution splits a key that holds much of `df`.
    """
    return df.join(dimension, on, "left")


def minute_grid(
    days: DataFrame, day: str, opens: time = SESSION_OPEN, closes: time = SESSION_CLOSE
) -> DataFrame:
    """Every minute of the session, both ends included, for each distinct day in `days`."""
    step = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(STEP_SECONDS))
    sessions = days.filter(F.col(day).isNotNull()).select(
        F.to_date(day).alias("trade_date")
    ).distinct()
    start = F.col("trade_date").cast("timestamp_ntz")
    points = F.sequence(at_time(start, opens), at_time(start, closes), step)
    return sessions.select("trade_date", F.posexplode(points).alias("minute_index", "minute"))


def to_minute(
    df: DataFrame, ts: str, opens: time = SESSION_OPEN, closes: time = SESSION_CLOSE
) -> DataFrame:
    """Add the nearest grid minute of each row and its index, by arithmetic alone."""
    return df.withColumns(
        {
            "minute": session_minute(F.col(ts), opens, closes),
            "minute_index": minute_index(F.col(ts), opens, closes),
        }
    )


def at_minute(
    df: DataFrame,
    grid: DataFrame,
    ts: str,
    by: Sequence[str] = (),
    opens: time = SESSION_OPEN,
    closes: time = SESSION_CLOSE,
) -> DataFrame:
    """Look up each row's nearest minute in a grid with one row per minute and `by` key.

    The nearest point is known from the time itself, so this is an equi join and never compares
    a row with the whole grid.
    """
    return lookup(to_minute(df, ts, opens, closes).drop("minute_index"), grid, ["minute", *by])
