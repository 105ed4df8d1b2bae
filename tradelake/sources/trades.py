"""Trade records derived from the line-item table, with missing values placed by rule."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tradelake.functions.calendar import transaction_id
from tradelake.operators.quality import WIRE_NAN


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def trades(spark: SparkSession, folder: str) -> DataFrame:
    """Wire records with `ts` for the time, from the whole line-item table."""
    line = table(spark, folder, "lineitem")
    dirt = F.col("l_orderkey") % 100
    seconds = (34200 + (F.col("l_partkey") * 37 + F.col("l_suppkey")) % 23401).cast("int")
    slot = F.col("l_suppkey") % 20
    return line.select(
        transaction_id(F.col("l_orderkey") * 10 + F.col("l_linenumber"), 9).alias("transaction_id"),
        (F.col("l_shipdate") + F.expr("INTERVAL '1' SECOND") * seconds).alias("ts"),
        F.concat(F.lit("S"), F.lpad(slot.cast("string"), 2, "0")).alias("stock_symbol"),
        F.when(dirt == 1, F.lit(None))
        .when(dirt == 2, F.lit(float("nan")))
        .otherwise(F.col("l_extendedprice"))
        .alias("price"),
        F.when(dirt != 3, F.col("l_quantity").cast("int")).alias("quantity"),
        F.when(dirt == 4, F.lit(None))
        .when(dirt == 5, F.lit(WIRE_NAN))
        .otherwise(F.when(F.col("l_linestatus") == "O", "buy").otherwise("sell"))
        .alias("order_type"),
        F.when(dirt == 6, F.lit(None))
        .when(dirt == 7, F.lit(WIRE_NAN))
        .otherwise(F.when(slot < 10, "NASDAQ").otherwise("NYSE"))
        .alias("exchange"),
    )


# The first of the days that trades are folded to, and how many there are.
FIRST_DAY, FOLDED_DAYS = "1998-06-11", 40


def _on_day(rows: DataFrame, day: Column) -> DataFrame:
    time = F.make_dt_interval(F.lit(0), F.hour("ts"), F.minute("ts"), F.second("ts").cast("decimal(18,6)"))
    return rows.withColumn("ts", day.cast("timestamp_ntz") + time)


def _day_number() -> Column:
    return F.date_diff("ts", F.lit("1970-01-01").cast("date"))


def folded(rows: DataFrame) -> DataFrame:
    """The same trades on a few days, for jobs that write a file for each day."""
    first = F.lit(FIRST_DAY).cast("date")
    return _on_day(rows, F.date_add(first, F.pmod(_day_number(), F.lit(FOLDED_DAYS)).cast("int")))


def moved_to_today(rows: DataFrame) -> DataFrame:
    """The same trades yesterday, today and tomorrow, a third each, by the session's current date."""
    return _on_day(rows, F.date_add(F.current_date(), F.pmod(_day_number(), F.lit(3)).cast("int") - 1))
