"""Quality rules and the row counts of the cleaning stages."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: what a bare NaN token becomes when it is decoded into a string column.
WIRE_NAN = '"NaN"'


@dataclass(frozen=True)
class Rule:
    """A column that must be present: never NULL, never NaN, never a sentinel text."""

    column: str
    nan: bool = False
    sentinels: tuple[str, ...] = ()

    def condition(self) -> Column:
        value = F.col(self.column)
        tests = [value.isNotNull()]
        if self.nan:
            tests.append(~F.isnan(value))
        tests += [value != text for text in self.sentinels]
        return reduce(and_, tests)


TRADE_RULES = (
    Rule("price", nan=True),
    Rule("quantity", nan=True),
    Rule("order_type", sentinels=(WIRE_NAN,)),
    Rule("exchange", sentinels=(WIRE_NAN,)),
)


def passes(rules: Sequence[Rule] = TRADE_RULES) -> Column:
    return reduce(and_, (rule.condition() for rule in rules))


def clean(df: DataFrame, rules: Sequence[Rule] = TRADE_RULES) -> DataFrame:
    return df.filter(passes(rules))


def stage_counts(
    df: DataFrame, key: Sequence[str] = ("transaction_id",), rules: Sequence[Rule] = TRADE_RULES
) -> DataFrame:
    """One row: rows read, rows that pass the rules, rows left after deduplication.

    A single scan. The per-key counts are combined before the shuffle, so a hot key costs one
    row per task, and unlike accumulator metrics they stay exact when tasks are run again.
    """
    per_key = (
        df.select(*key, F.coalesce(passes(rules), F.lit(False)).alias("_ok"))
        .groupBy(*key)
        .agg(F.count(F.lit(1)).alias("_read"), F.count_if("_ok").alias("_clean"))
    )
    return per_key.agg(
        F.coalesce(F.sum("_read"), F.lit(0)).cast("long").alias("rows_read"),
        F.coalesce(F.sum("_clean"), F.lit(0)).cast("long").alias("rows_clean"),
        F.count_if(F.col("_clean") > 0).alias("rows_deduplicated"),
    )
