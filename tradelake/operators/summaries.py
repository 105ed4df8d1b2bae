"""Daily summaries, declared by their keys and measures."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradelake import schemas
from tradelake.schemas import TableSpec

GRAIN = ("stock_symbol", "exchange", "order_type")
_VOLUME, _VALUE, _COUNT = "_volume", "_value", "_count"


@dataclass(frozen=True)
class Summary:
    """One summary table: the keys it adds to the day, and the measure behind each column."""

    table: TableSpec
    keys: tuple[str, ...]
    measures: dict[str, str]


MARKET = Summary(schemas.GOLD_MARKET, (), {"total_volume": _VOLUME, "total_value": _VALUE})
STOCK = Summary(
    schemas.GOLD_STOCK,
    ("stock_symbol", "exchange"),
    {"total_volume": _VOLUME, "total_value": _VALUE, "transaction_count": _COUNT},
)
ORDER_TYPE = Summary(
    schemas.GOLD_ORDER_TYPE, ("order_type",), {"order_count": _COUNT, "total_volume": _VOLUME}
)
EXCHANGE = Summary(
    schemas.GOLD_EXCHANGE,
    ("exchange",),
    {"total_volume": _VOLUME, "total_value": _VALUE, "transaction_count": _COUNT},
)
SUMMARIES = (MARKET, STOCK, ORDER_TYPE, EXCHANGE)


def _row_measures() -> dict[str, Column]:
    return {
        _VOLUME: F.sum("quantity"),
        _VALUE: F.sum(F.col("price").cast("double") * F.col("quantity")),
        _COUNT: F.count("transaction_id"),
    }


def _shaped(grouped: DataFrame, summary: Summary) -> DataFrame:
    return grouped.select(summary.table.schema.fieldNames())


def summarise(df: DataFrame, summary: Summary) -> DataFrame:
    """One summary straight from raw or cleaned rows, every day that occurs in them."""
    measures = _row_measures()
    grouped = df.groupBy(
        F.col("ts_year").alias("year"),
        F.col("ts_month").alias("month"),
        F.to_date("ts").alias("report_date"),
        *summary.keys,
    ).agg(*(measures[m].alias(name) for name, m in summary.measures.items()))
    return _shaped(grouped, summary)


def day_totals(df: DataFrame) -> DataFrame:
    """The finest totals all four summaries can be rolled up from, in one scan."""
    return df.groupBy(
        F.col("ts_year").alias("year"),
        F.col("ts_month").alias("month"),
        F.to_date("ts").alias("report_date"),
        *GRAIN,
    ).agg(*(agg.alias(name) for name, agg in _row_measures().items()))


def roll_up(totals: DataFrame, summary: Summary) -> DataFrame:
    """A summary from `day_totals`; sums and counts are additive."""
    grouped = totals.groupBy("year", "month", "report_date", *summary.keys).agg(
        *(F.sum(m).alias(name) for name, m in summary.measures.items())
    )
    return _shaped(grouped, summary)
