"""Minute grids, nearest minutes and lookups against brute force."""

from __future__ import annotations

from datetime import time, timedelta

from helpers import at, plan
from pyspark.sql import functions as F

from tradelake.functions.calendar import transaction_id
from tradelake.functions.minutes import minute_index, nearest_minute
from tradelake.operators.align import at_minute, lookup, minute_grid


def times(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "ts timestamp_ntz")


def test_grid_has_both_ends(spark):
    grid = minute_grid(times(spark, at(20), at(20, 15), at(21), None), "ts")
    rows = grid.orderBy("minute").collect()
    assert len(rows) == 2 * 391
    assert rows[0].minute == at(20, 9, 30) and rows[390].minute == at(20, 16)
    assert [r.minute_index for r in rows[:391]] == list(range(391))


def test_half_a_minute_goes_down_and_a_microsecond_more_goes_up(spark):
    half = at(20, 10, 5, 30)
    rows = times(spark, half, half + timedelta(microseconds=1))
    found = [r[0] for r in rows.select(nearest_minute(F.col("ts"))).collect()]
    assert found == [at(20, 10, 5), at(20, 10, 6)]


def test_index_equals_brute_force(spark):
    opens = at(20, 9, 30)
    grid = [opens + timedelta(minutes=i) for i in range(391)]
    values = [opens + timedelta(seconds=s, microseconds=s * 997 % 1_000_000) for s in range(0, 23_400, 7)]
    values += [opens + timedelta(seconds=s) for s in range(0, 23_401, 30)]
    values += [at(20, 3), at(20, 23, 59, 59)]
    found = times(spark, *values).select("ts", minute_index(F.col("ts"))).collect()
    for ts, index in found:
        assert index == min(range(391), key=lambda i: abs(grid[i] - ts))


def test_other_session(spark):
    rows = times(spark, at(20, 7, 59), at(20, 8, 10, 31))
    index = minute_index(F.col("ts"), time(8), time(8, 30))
    assert [r[0] for r in rows.select(index).collect()] == [0, 11]
    assert minute_grid(rows, "ts", time(8), time(8, 30)).count() == 31


def test_minute_lookup_by_symbol(spark):
    grid = spark.createDataFrame(
        [(at(20, 10, 0), "A", 1.0), (at(20, 10, 1), "A", 2.0), (at(20, 10, 1), "B", 3.0)],
        "minute timestamp_ntz, stock_symbol string, price double",
    )
    rows = spark.createDataFrame(
        [(1, "A", at(20, 10, 0, 30)), (2, "A", at(20, 10, 0, 31)), (3, "B", at(20, 10, 1)), (4, "B", at(20, 11))],
        "id int, stock_symbol string, ts timestamp_ntz",
    )
    found = at_minute(rows, grid, "ts", ["stock_symbol"])
    assert {r.id: r.price for r in found.collect()} == {1: 1.0, 2: 2.0, 3: 3.0, 4: None}
    assert "NestedLoop" not in plan(found) and "Cartesian" not in plan(found)


def test_lookup_broadcasts_by_size_only(spark, sf):
    nation = spark.read.parquet(f"{sf}/nation.parquet").withColumnRenamed("n_nationkey", "s_nationkey")
    supplier = spark.read.parquet(f"{sf}/supplier.parquet")
    assert "BroadcastHashJoin" in plan(lookup(supplier, nation, "s_nationkey"))
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1")
    try:
        assert "Broadcast" not in plan(lookup(supplier, nation, "s_nationkey"))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_symbols(spark):
    symbols = spark.createDataFrame(
        [("AAPL", "NASDAQ", 150.0), ("KO", "NYSE", 55.0)],
        "stock_symbol string, exchange string, base_price double",
    )
    rows = spark.createDataFrame([("AAPL",), ("?",)], "stock_symbol string")
    prices = {r.stock_symbol: r.base_price for r in lookup(rows, symbols, "stock_symbol").collect()}
    assert prices == {"AAPL": 150.0, "?": None}


def test_long_ids_keep_their_digits(spark):
    ids = spark.createDataFrame([(1,), (1234567,), (123456789,)], "n long").select(transaction_id(F.col("n")))
    assert [r[0] for r in ids.collect()] == ["tx_0000001", "tx_1234567", "tx_123456789"]


def test_nearest_minute_ignores_the_session_zone(spark):
    """02:15 does not exist in New York on this day; a time without zone stays what it is."""
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        row = spark.sql("SELECT TIMESTAMP_NTZ '2025-03-09 02:15:10' AS ts")
        found = row.select(nearest_minute(F.col("ts")).cast("string").alias("m")).first().m
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert found == "2025-03-09 02:15:00"
