"""Minute arithmetic for trading sessions."""

from __future__ import annotations

from datetime import time

from pyspark.sql import Column
from pyspark.sql import functions as F

# The trading session and the distance between two grid points.
SESSION_OPEN = time(9, 30)
SESSION_CLOSE = time(16, 0)
STEP_SECONDS = 60


def at_time(day: Column, clock: time) -> Column:
    """`day` at a time of day, as a timestamp without zone."""
    offset = F.make_dt_interval(
        F.lit(0), F.lit(clock.hour), F.lit(clock.minute), F.lit(clock.second)
    )
    return day.cast("date").cast("timestamp_ntz") + offset


def nearest_minute(ts: Column) -> Column:
    """The whole minute closest to `ts`; exactly half way goes to the earlier one."""
    # Intervals keep times without zone so; truncation would read them in the session's zone.
    second = F.extract(F.lit("second"), ts)
    minute = ts.cast("timestamp_ntz") - F.make_dt_interval(secs=second)
    past_half = second > STEP_SECONDS / 2
    step = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(STEP_SECONDS))
    return F.when(past_half, minute + step).otherwise(minute)


def session_minute(
    ts: Column, opens: time = SESSION_OPEN, closes: time = SESSION_CLOSE
) -> Column:
    """`nearest_minute` held inside the session of its own day."""
    first, last = at_time(ts, opens), at_time(ts, closes)
    return F.when(ts.isNotNull(), F.least(F.greatest(nearest_minute(ts), first), last))


def minute_index(
    ts: Column, opens: time = SESSION_OPEN, closes: time = SESSION_CLOSE
) -> Column:
    """Position of `session_minute` on the session's grid, starting at 0."""
    minute = session_minute(ts, opens, closes)
    since_open = F.timestamp_diff("SECOND", at_time(ts, opens), minute)
    return F.floor(since_open / STEP_SECONDS).cast("int")
