"""Record, raw, cleaned and summary schemas with their partition columns."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields])


_STRING, _DOUBLE, _INT, _LONG = T.StringType(), T.DoubleType(), T.IntegerType(), T.LongType()
_DATE, _NTZ, _BINARY = T.DateType(), T.TimestampNTZType(), T.BinaryType()

# Column names, types and order of the wire record and of every table.
RECORD = _struct(
    ("transaction_id", _STRING),
    ("timestamp", _NTZ),
    ("stock_symbol", _STRING),
    ("price", _DOUBLE),
    ("quantity", _INT),
    ("order_type", _STRING),
    ("exchange", _STRING),
)
RAW = _struct(
    ("transaction_id", _STRING),
    ("ts", _NTZ),
    ("stock_symbol", _STRING),
    ("price", _DOUBLE),
    ("quantity", _INT),
    ("order_type", _STRING),
    ("exchange", _STRING),
    ("ts_year", _INT),
    ("ts_month", _INT),
    ("ts_day", _INT),
)
DAILY_MARKET = _struct(
    ("report_date", _DATE),
    ("total_volume", _LONG),
    ("total_value", _DOUBLE),
    ("year", _INT),
    ("month", _INT),
)
DAILY_STOCK = _struct(
    ("report_date", _DATE),
    ("stock_symbol", _STRING),
    ("exchange", _STRING),
    ("total_volume", _LONG),
    ("total_value", _DOUBLE),
    ("transaction_count", _LONG),
    ("year", _INT),
    ("month", _INT),
)
DAILY_ORDER_TYPE = _struct(
    ("report_date", _DATE),
    ("order_type", _STRING),
    ("order_count", _LONG),
    ("total_volume", _LONG),
    ("year", _INT),
    ("month", _INT),
)
DAILY_EXCHANGE = _struct(
    ("report_date", _DATE),
    ("exchange", _STRING),
    ("total_volume", _LONG),
    ("total_value", _DOUBLE),
    ("transaction_count", _LONG),
    ("year", _INT),
    ("month", _INT),
)
MESSAGE = _struct(("key", _BINARY), ("value", _BINARY))

DAY_PARTS = ("ts_year", "ts_month", "ts_day")
MONTH_PARTS = ("year", "month")


@dataclass(frozen=True)
class TableSpec:
    """Database, table name, columns and identity partition columns of one table."""

    database: str
    name: str
    schema: T.StructType
    partition_by: tuple[str, ...]


BRONZE = TableSpec("stocks", "transactions", RAW, DAY_PARTS)
SILVER = TableSpec("stocks", "transactions_cleaned", RAW, DAY_PARTS)
GOLD_MARKET = TableSpec("stocks_reporting", "daily_market_summary", DAILY_MARKET, MONTH_PARTS)
GOLD_STOCK = TableSpec("stocks_reporting", "daily_stock_summary", DAILY_STOCK, MONTH_PARTS)
GOLD_ORDER_TYPE = TableSpec(
    "stocks_reporting", "daily_order_type_summary", DAILY_ORDER_TYPE, MONTH_PARTS
)
GOLD_EXCHANGE = TableSpec("stocks_reporting", "daily_exchange_summary", DAILY_EXCHANGE, MONTH_PARTS)
TABLES = (BRONZE, SILVER, GOLD_MARKET, GOLD_STOCK, GOLD_ORDER_TYPE, GOLD_EXCHANGE)
