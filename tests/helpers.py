"""Small row builders and plan text for the tests."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from tradelake.operators.slices import to_raw
from tradelake.schemas import RAW, RECORD


def at(day: int, hour: int = 10, minute: int = 0, second: int = 0, month: int = 6) -> datetime:
    return datetime(2025, month, day, hour, minute, second)


def record(
    key, ts, symbol="AAPL", price=1.0, quantity=1, order_type="buy", exchange="NASDAQ"
) -> tuple:
    return (key, ts, symbol, price, quantity, order_type, exchange)


def raw(spark: SparkSession, *records: tuple) -> DataFrame:
    return to_raw(spark.createDataFrame(list(records), RECORD)).select(RAW.fieldNames())


def key_times(df: DataFrame) -> list[tuple]:
    return sorted(((r.transaction_id, r.ts) for r in df.collect()), key=repr)


def plan(df: DataFrame) -> str:
    """The executed plan; run the query first to see what adaptive execution made of it."""
    return df._jdf.queryExecution().executedPlan().toString()
