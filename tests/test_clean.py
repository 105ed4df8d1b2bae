"""Quality rules, stage counts, deduplication, day slices."""

from __future__ import annotations

from datetime import date

from helpers import at, key_times, plan, raw, record

from tradelake.operators.dedup import latest_per_key
from tradelake.operators.quality import Rule, clean, stage_counts
from tradelake.operators.slices import day_slice

NAN = float("nan")


def test_rules_reject_null_nan_and_sentinel(spark):
    rows = raw(
        spark,
        record("good", at(20)),
        record("null price", at(20), price=None),
        record("nan price", at(20), price=NAN),
        record("null quantity", at(20), quantity=None),
        record("null type", at(20), order_type=None),
        record("sentinel type", at(20), order_type='"NaN"'),
        record("null exchange", at(20), exchange=None),
        record("sentinel exchange", at(20), exchange='"NaN"'),
        record("plain NaN text", at(20), order_type="NaN"),
        record(None, None, symbol=None),
    )
    kept = {r.transaction_id for r in clean(rows).collect()}
    assert kept == {"good", "plain NaN text", None}


def test_rules_are_configurable(spark):
    rows = raw(spark, record("a", at(20), symbol=None), record("b", at(20), price=None))
    kept = clean(rows, [Rule("stock_symbol", sentinels=("?",))])
    assert [r.transaction_id for r in kept.collect()] == ["b"]


def test_tie_goes_to_the_lower_price(spark):
    rows = raw(spark, record("a", at(20), price=2.0), record("a", at(20), price=1.0))
    assert [r.price for r in latest_per_key(rows).collect()] == [1.0]


def test_null_keys_are_one_group(spark):
    rows = raw(spark, record(None, at(20, 1)), record(None, at(20, 2)), record("a", at(20)))
    assert key_times(latest_per_key(rows)) == sorted([("a", at(20)), (None, at(20, 2))], key=repr)


def test_composite_key_keeps_each_day(spark):
    rows = raw(spark, record("a", at(19)), record("a", at(20, 1)), record("a", at(20, 2)))
    kept = latest_per_key(rows, ["transaction_id", "ts_year", "ts_month", "ts_day"])
    assert key_times(kept) == [("a", at(19)), ("a", at(20, 2))]


def test_stage_counts(spark):
    rows = raw(
        spark,
        record("a", at(20, 1)),
        record("a", at(20, 2)),
        record("b", at(20), price=NAN),
        record(None, at(20, 1)),
        record(None, at(20, 2)),
    )
    assert tuple(stage_counts(rows).first()) == (5, 4, 2)
    assert tuple(stage_counts(rows.limit(0)).first()) == (0, 0, 0)


def test_hot_key_is_limited_before_the_shuffle(spark):
    hot = spark.range(0, 90_000, 1, 8).selectExpr(
        "if(id % 3 = 0, 'hot', concat('k', id)) AS transaction_id",
        "timestamp_ntz'2025-06-20 10:00:00' + make_dt_interval(0, 0, 0, id % 1000) AS ts",
        "id AS payload",
    )
    kept = latest_per_key(hot)
    assert kept.count() == 60_001
    text = plan(kept)
    before = text[text.rindex("Exchange") :]
    assert "WindowGroupLimit" in before and "Partial" in before


def test_day_slice(spark):
    rows = raw(spark, record("a", at(19)), record("b", at(20)), record("c", at(1, month=7)), record("d", None))
    names = lambda days: sorted(r.transaction_id for r in day_slice(rows, days).collect())
    assert names(date(2025, 6, 20)) == ["b"]
    assert names((date(2025, 6, 20), date(2025, 7, 1))) == ["b", "c"]
    assert names(None) == []
    today = spark.sql("SELECT 'now' AS transaction_id, current_timestamp() AS t").selectExpr(
        "transaction_id", "year(t) AS ts_year", "month(t) AS ts_month", "day(t) AS ts_day"
    )
    assert day_slice(today).count() == 1


def test_day_slice_prunes_partitions(spark, tmp_path):
    rows = raw(spark, *(record(f"k{d}", at(d)) for d in range(1, 29)))
    rows.write.partitionBy("ts_year", "ts_month", "ts_day").parquet(str(tmp_path / "t"))
    table = spark.read.parquet(str(tmp_path / "t"))
    for days in (date(2025, 6, 20), (date(2025, 6, 20), date(2025, 6, 20))):
        sliced = clean(day_slice(table, days))
        assert sliced.count() == 1
        scan = plan(sliced)
        assert "ts_day" in scan[scan.index("PartitionFilters") :].split("PushedFilters")[0]
        assert "IsNotNull(price)" in scan and "Not(EqualTo(order_type" in scan
        assert len(sliced.inputFiles()) == 28  # the listing; the filter drops files at run time
        metric = sliced.select("transaction_id").where("transaction_id is not null")
        assert [r.transaction_id for r in metric.collect()] == ["k20"]
