"""Partitioned tables by folder and by name, upserts, key index, day replacement."""

from __future__ import annotations

from datetime import date

import pytest
from helpers import at, key_times, plan, raw, record
from pyspark.errors import UnsupportedOperationException
from pyspark.sql import functions as F

from tradelake import schemas
from tradelake.operators.replace import append_rows, replace_days
from tradelake.operators.summaries import MARKET, SUMMARIES, day_totals, roll_up, summarise
from tradelake.operators.upsert import merge_into_table, upsert, upsert_into
from tradelake.session import empty
from tradelake.sources import catalog, layout
from tradelake.sources.keys import KeyIndex
from tradelake.sources.tables import CatalogTable, FolderTable

KEY = ["transaction_id"]


@pytest.fixture(params=["folder", "catalog"])
def tables(request, spark, tmp_path):
    """Makes an empty table of a spec, known by its folder or by its name."""
    if request.param == "folder":
        yield lambda spec: FolderTable.of(spark, str(tmp_path), spec)
        return
    catalog.create_tables(spark, prefix="own_", location=str(tmp_path))
    yield lambda spec: CatalogTable(spark, catalog.table_name(spec, "own_"))
    catalog.drop_databases(spark, prefix="own_")


@pytest.fixture
def silver(tables):
    return tables(schemas.SILVER)


@pytest.fixture
def market(tables):
    return tables(schemas.GOLD_MARKET)


@pytest.fixture
def shuffled(spark):
    """Joins of small tables shuffle both sides, and no shuffle partitions are put together."""
    wanted = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {name: spark.conf.get(name) for name in wanted}
    for name, value in wanted.items():
        spark.conf.set(name, value)
    yield
    for name, value in before.items():
        spark.conf.set(name, value)


def test_null_keys_never_match(spark):
    target = raw(spark, record("a", at(1)), record(None, at(2)))
    updates = raw(spark, record("a", at(9)), record("b", at(3)), record(None, at(5)))
    expected = [("a", at(9)), ("b", at(3)), (None, at(2)), (None, at(5))]
    assert key_times(upsert(target, updates, KEY)) == sorted(expected, key=repr)


def test_null_keys_are_spread_and_the_target_is_read_once(spark, silver, shuffled):
    rows = [record(None, at(1, 1, i % 60), price=float(i)) for i in range(300)]
    silver.append(raw(spark, record("a", at(1)), *rows))
    merged = upsert(silver.read(), raw(spark, record("a", at(1, 12))), KEY)
    assert merged.count() == 301
    assert plan(silver.read()).count("FileScan") == 1
    assert plan(merged).split("Initial Plan")[0].count("FileScan") == 1
    unkeyed = F.count_if(F.col("transaction_id").isNull()).alias("unkeyed")
    sizes = [r.unkeyed for r in merged.groupBy(F.spark_partition_id()).agg(unkeyed).collect()]
    assert sum(sizes) == 300 and max(sizes) < 100


def test_an_id_can_move_to_another_day(spark, silver):
    upsert_into(silver, raw(spark, record("a", at(19)), record("b", at(20))), KEY)
    upsert_into(silver, raw(spark, record("a", at(21))), KEY)
    assert key_times(silver.read()) == [("a", at(21)), ("b", at(20))]
    assert silver.partitions() == {(2025, 6, 20), (2025, 6, 21)}


def test_upsert_twice_changes_nothing(spark, silver):
    updates = raw(spark, record("a", at(19)), record("b", at(20)))
    for _ in range(2):
        upsert_into(silver, updates, KEY)
    assert key_times(silver.read()) == [("a", at(19)), ("b", at(20))]


def test_upsert_leaves_other_partitions_alone(spark, silver):
    upsert_into(silver, raw(spark, *(record(f"k{d}", at(d)) for d in range(1, 11))), KEY)
    before = set(silver.read().inputFiles())
    upsert_into(silver, raw(spark, record("k3", at(4, 12))), KEY)
    kept = before & set(silver.read().inputFiles())
    assert len(kept) == 8
    assert silver.read().count() == 10


def test_key_with_day_parts(spark, silver):
    key = [*KEY, *schemas.DAY_PARTS]
    upsert_into(silver, raw(spark, record("a", at(19))), key)
    upsert_into(silver, raw(spark, record("a", at(20))), key)
    upsert_into(silver, raw(spark, record("a", at(20, 11))), key)
    assert key_times(silver.read()) == [("a", at(19)), ("a", at(20, 11))]


def test_null_partition(spark, silver):
    silver.append(raw(spark, record("a", None), record("b", at(20))))
    silver.replace_partitions(raw(spark, record("c", at(20))), {(2025, 6, 20)})
    assert {r.transaction_id for r in silver.read().collect()} == {"a", "c"}
    assert {r.transaction_id for r in silver.read([(None, None, None)]).collect()} == {"a"}


def test_rows_may_come_from_the_table_they_replace(spark, silver):
    silver.append(raw(spark, record("a", at(19)), record("b", at(20)), record("c", at(21))))
    touched = {(2025, 6, 19), (2025, 6, 20)}
    silver.replace_partitions(silver.read(touched).filter("transaction_id = 'b'"), touched)
    assert key_times(silver.read()) == [("b", at(20)), ("c", at(21))]
    assert silver.partitions() == {(2025, 6, 20), (2025, 6, 21)}


def test_empty_table(spark, silver):
    assert silver.partitions() == set()
    assert [(f.name, f.dataType) for f in silver.read().schema] == [(f.name, f.dataType) for f in schemas.RAW]
    assert silver.read().count() == silver.read([(2025, 6, 20)]).count() == 0
    silver.append(empty(spark, schemas.RAW))
    silver.replace_partitions(empty(spark, schemas.RAW), [(2025, 6, 20)])
    assert silver.read().count() == 0


def test_session_overwrites_as_before_after_a_replacement(spark, silver):
    before = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    silver.replace_partitions(raw(spark, record("a", at(19))), ())
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode") == before


def test_upsert_opens_only_partitions_that_may_hold_an_id(spark, silver):
    upsert_into(silver, raw(spark, *(record(f"k{d}", at(d)) for d in range(1, 11)), record(None, at(2))), KEY)
    updates = raw(spark, record("k3", at(12)), record("new", at(12)), record(None, at(12)))
    index = KeyIndex(silver, KEY)
    holding = index.holding(updates)
    assert {tuple(r) for r in holding.collect()} == {(2025, 6, 3)}
    # The locating plan reads digests only, and no pairs of rows are made.
    assert holding.inputFiles() and all("/_keys/" in f for f in holding.inputFiles())
    text = plan(holding)
    assert "transaction_id" not in "".join(l for l in text.splitlines() if "/_keys" in l and "FileScan" in l)
    assert "CartesianProduct" not in text and "NestedLoop" not in text
    before = set(silver.read().inputFiles())
    assert upsert_into(silver, updates, KEY) == {(2025, 6, 3), (2025, 6, 12)}
    assert len(before & set(silver.read().inputFiles())) == 9
    assert key_times(silver.read())[-2:] == [(None, at(12)), (None, at(2))]


def test_key_index_covers_the_table_and_is_built_where_it_is_missing(spark, silver):
    silver.append(raw(spark, record("a", at(19)), record("b", at(20))))
    index = KeyIndex(silver, KEY)
    assert index.partitions(raw(spark, record("a", at(1)))) == {(2025, 6, 19)}
    # A key that moved away costs a look; a new index forgets it.
    upsert_into(silver, raw(spark, record("a", at(20))), KEY)
    upsert_into(silver, raw(spark, record("c", at(19))), KEY)
    assert index.partitions(raw(spark, record("a", at(1)))) == {(2025, 6, 19), (2025, 6, 20)}
    index.rebuild()
    assert index.partitions(raw(spark, record("a", at(1)))) == {(2025, 6, 20)}
    assert key_times(silver.read()) == [("a", at(20)), ("b", at(20)), ("c", at(19))]


def test_hot_partition_is_split_in_a_large_write(spark, monkeypatch, silver):
    monkeypatch.setattr(layout, "SMALL_WRITE_BYTES", 0)
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "65536")
    try:
        rows = spark.range(0, 60_000, 1, 8).selectExpr(
            "uuid() AS transaction_id",
            "timestamp_ntz'2025-06-20 10:00:00' + make_dt_interval(if(id % 3 = 0, 0, cast(id % 9 AS int))) AS ts",
            "'S' AS stock_symbol", "1D AS price", "1 AS quantity", "'buy' AS order_type", "'X' AS exchange",
        ).selectExpr("*", "year(ts) AS ts_year", "month(ts) AS ts_month", "day(ts) AS ts_day")
        silver.append(rows)
        hot = silver.read([(2025, 6, 20)])
        assert len(hot.inputFiles()) > 1
        assert silver.read().count() == 60_000
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")


def days_of(df):
    return sorted((r.report_date.day, r.total_volume) for r in df.collect())


def test_replace_day_twice(spark, market):
    report = summarise(raw(spark, record("a", at(20), quantity=5)), MARKET)
    for _ in range(2):
        replace_days(market, report, date(2025, 6, 20))
    assert days_of(market.read()) == [(20, 5)]


@pytest.mark.parametrize("named", [True, False])
def test_next_day_keeps_the_month(spark, market, named):
    for day in (20, 21, 20):
        report = summarise(raw(spark, record("a", at(day), quantity=day)), MARKET)
        replace_days(market, report, date(2025, 6, day) if named else None)
    assert days_of(market.read()) == [(20, 20), (21, 21)]


def test_replace_empties_a_day_without_rows(spark, market):
    both = raw(spark, record("a", at(20)), record("b", at(21)))
    replace_days(market, summarise(both, MARKET))
    replace_days(market, summarise(both.limit(0), MARKET), date(2025, 6, 20))
    assert days_of(market.read()) == [(21, 1)]


def test_append_twice(spark, market):
    report = summarise(raw(spark, record("a", at(20))), MARKET)
    for _ in range(2):
        append_rows(market, report)
    assert days_of(market.read()) == [(20, 1), (20, 1)]


def test_summary_of_missing_values(spark):
    rows = raw(
        spark,
        record("a", at(20), price=float("nan")),
        record(None, at(20), quantity=2),
        record("c", at(21), price=None, quantity=None),
    )
    totals = {r.report_date.day: r for r in summarise(rows, MARKET).collect()}
    assert totals[20].total_volume == 3 and totals[20].total_value != totals[20].total_value
    assert totals[21].total_volume is None and totals[21].total_value is None
    counts = summarise(rows, SUMMARIES[3]).collect()
    assert sorted(r.transaction_count for r in counts) == [1, 1]


def test_roll_up_equals_direct_summary(spark, sf):
    from tradelake.plans.queries import silver as cleaned

    rows = cleaned(spark, sf)
    for summary in SUMMARIES:
        direct = {tuple(map(_round, r)) for r in summarise(rows, summary).collect()}
        rolled = {tuple(map(_round, r)) for r in roll_up(day_totals(rows), summary).collect()}
        assert direct == rolled


def _round(value):
    return round(value, 2) if isinstance(value, float) else value


def test_summary_schemas(spark, sf):
    from tradelake.plans.queries import bronze

    for summary in SUMMARIES:
        made = summarise(bronze(spark, sf), summary).schema
        wanted = summary.table.schema
        assert [(f.name, f.dataType) for f in made] == [(f.name, f.dataType) for f in wanted]


def test_catalog_tables(request, spark, tmp_path):
    request.addfinalizer(lambda: catalog.drop_databases(spark, prefix="t_"))
    for _ in range(2):
        catalog.create_tables(spark, prefix="t_", location=str(tmp_path))
    rows = raw(spark, record("a", at(20)), record("b", at(21)))
    for _ in range(2):
        catalog.append_to(rows, schemas.BRONZE, "t_")
    table = spark.table("t_stocks.transactions")
    assert table.count() == 4
    shown = spark.sql("SHOW PARTITIONS t_stocks.transactions").collect()
    assert [r[0] for r in shown] == ["ts_year=2025/ts_month=6/ts_day=20", "ts_year=2025/ts_month=6/ts_day=21"]
    created = {r.tableName for r in spark.sql("SHOW TABLES IN t_stocks_reporting").collect()}
    assert created == {s.table.name for s in SUMMARIES}
    with pytest.raises(UnsupportedOperationException, match="MERGE INTO"):
        merge_into_table(rows, "t_stocks.transactions", KEY)


def test_rows_without_a_date_are_replaced_too(spark, market):
    columns = market.schema
    rows = spark.createDataFrame([(1, 2.0)], "v long, x double").select(
        *(F.lit(None).cast(f.dataType).alias(f.name) for f in columns)
    )
    for _ in range(2):
        replace_days(market, rows)
    assert market.read().count() == 1
    replace_days(market, rows, date(2025, 6, 20))
    assert market.read().count() == 1


def test_some_days_are_replaced_and_others_stay(spark, market):
    rows = summarise(raw(spark, *(record(f"k{d}", at(d)) for d in (1, 2, 3))), MARKET)
    append_rows(market, rows)
    one = summarise(raw(spark, record("n", at(2), quantity=9)), MARKET)
    replace_days(market, one, frozenset({date(2025, 6, 2), date(2025, 6, 3)}))
    found = {r.report_date.day: r.total_volume for r in market.read().collect()}
    assert found == {1: 1, 2: 9}


def test_upsert_into_all_partitions_reads_no_digests(spark, silver, monkeypatch):
    silver.append(raw(spark, record("a", at(19)), record("b", at(20))))
    looked = []
    holding = KeyIndex.holding
    monkeypatch.setattr(KeyIndex, "holding", lambda *args: looked.append(args) or holding(*args))
    # Every partition is written anyway; the index, missing so far, still gets the old keys.
    both = raw(spark, record("b", at(19)), record("c", at(20)))
    assert upsert_into(silver, both, KEY) == {(2025, 6, 19), (2025, 6, 20)}
    assert not looked
    assert key_times(silver.read()) == [("a", at(19)), ("b", at(19)), ("c", at(20))]
    assert upsert_into(silver, raw(spark, record("a", at(21))), KEY) == {(2025, 6, 19), (2025, 6, 21)}
    assert looked
    assert key_times(silver.read()) == [("a", at(21)), ("b", at(19)), ("c", at(20))]
