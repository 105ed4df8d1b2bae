"""Pages, messages, decoding, day files."""

from __future__ import annotations

import json
from datetime import date
from pathlib import Path

import pytest
from helpers import at, plan, record
from pyspark.sql import functions as F

from tradelake.operators import paging
from tradelake.operators.paging import (
    envelopes,
    page_listing,
    page_slice,
    page_status,
    record_json,
    with_row_index,
)
from tradelake.operators.quality import clean
from tradelake.schemas import RECORD
from tradelake.session import scratch_dir
from tradelake.sources import messages
from tradelake.sources.day_files import TIME_FORMAT, day_file, read_day_file, write_day_file
from tradelake.streaming.ingest import decode, ingest_available

DAY = date(2025, 6, 20)


def decoded(spark, *values):
    rows = spark.createDataFrame([(v,) for v in values], "value string")
    return decode(rows.selectExpr("cast(value AS binary) AS value")).collect()


def one(spark, **fields):
    known = {"transaction_id": '"a"', "timestamp": '"2025-06-20 10:00:00"', "quantity": "1"}
    body = ",".join(f'"{k}":{v}' for k, v in (known | fields).items())
    rows = decoded(spark, f"[{{{body}}}]")
    assert len(rows) == 1
    return rows[0]


@pytest.mark.parametrize("text", ["NaN", '"NaN"'])
def test_nan_price(spark, text):
    price = one(spark, price=text).price
    assert price != price


def test_missing_tokens(spark):
    assert one(spark, price="null").price is None
    assert one(spark, order_type="NaN").order_type == '"NaN"'
    assert one(spark, order_type='"NaN"').order_type == "NaN"
    assert one(spark, quantity="NaN", price="2").quantity is None
    assert one(spark, quantity="10.0", price="2")[3:5] == (2.0, None)
    bad_time = one(spark, timestamp='"xx"')
    assert bad_time.timestamp is None and bad_time.transaction_id == "a"
    assert one(spark, unknown="1").transaction_id == "a"


def test_message_shapes(spark):
    assert decoded(spark, '[{"transaction_id":"a"},{"transaction_id"', "[]", None, "") == []
    assert [r.transaction_id for r in decoded(spark, '{"transaction_id":"a"}')] == ["a"]
    assert len(decoded(spark, '[{"transaction_id":"a"},{"transaction_id":"b"}]', "oops")) == 2


def numbers(spark, rows, partitions=4):
    return spark.range(0, rows, 1, partitions).selectExpr("id", "(id * 7919) % 1000 AS k")


def test_row_index_is_the_global_order(spark):
    indexed = with_row_index(numbers(spark, 5000), ["k", "id"], partitions=7).collect()
    ordered = sorted(indexed, key=lambda r: (r.k, r.id))
    assert [r.row_index for r in ordered] == list(range(5000))


def test_equal_rows_spread_over_partitions(spark):
    """A third of the rows share one sort key and are still placed by several tasks."""
    rows = spark.range(0, 30_000, 1, 8).selectExpr("if(id % 3 = 0, 0, id) AS k")
    indexed = with_row_index(rows, ["k"], partitions=12)
    assert sorted(r.row_index for r in indexed.collect()) == list(range(30_000))
    sizes = [r["count"] for r in _staged_sizes(spark, rows)]
    assert max(sizes) < 2 * 30_000 / 12


def _staged_sizes(spark, rows):
    from pyspark.sql import functions as F

    placed = rows.withColumn("_tie", F.monotonically_increasing_id()).repartitionByRange(12, "k", "_tie")
    return placed.groupBy(F.spark_partition_id()).count().collect()


def test_more_range_partitions_for_larger_input(spark, monkeypatch):
    rows = numbers(spark, 10)
    assert paging.range_count(rows) == 8
    monkeypatch.setattr(paging, "estimated_bytes", lambda df: 100 << 40)
    assert paging.range_count(rows) == 409_600


@pytest.mark.parametrize("top_rows", [0, 1000])
def test_page_slice(spark, monkeypatch, top_rows):
    monkeypatch.setattr(paging, "TOP_ROWS", top_rows)
    rows = numbers(spark, 250)
    expected = [r.id for r in sorted(rows.collect(), key=lambda r: (r.k, r.id))]
    for offset in (0, 100, 200, 250, 400):
        page = page_slice(rows, ["k", "id"], offset).collect()
        assert sorted(r.id for r in page) == sorted(expected[offset : offset + 100])


def test_pages_of_ties_fit_together(spark):
    """Pages before and after the switch of plans share no row and leave none out."""
    rows = spark.range(0, 3000, 1, 7).select("id", F.lit(1).alias("k"))
    pages = [page_slice(rows, ["k"], offset, 500).collect() for offset in range(0, 3000, 500)]
    assert sorted(r.id for page in pages for r in page) == list(range(3000))


def test_early_page_never_merges_all_partitions_at_once(spark):
    page = page_slice(numbers(spark, 5000, 8), ["k", "id"], 300)
    assert page.count() == 100
    text = plan(page)
    assert text.count("WindowGroupLimit") >= 2


def test_page_status(spark):
    rows = numbers(spark, 250)
    status = lambda offset: tuple(page_status(rows, offset).first())
    assert status(0) == (250, "success")
    assert status(149) == (250, "success")
    assert status(150) == (250, "complete")
    assert status(900) == (250, "complete")


def test_page_listing(spark):
    listing = lambda n: [tuple(r) for r in page_listing(numbers(spark, n)).orderBy("page_offset").collect()]
    assert listing(250) == [(0, 100, "success"), (100, 100, "success"), (200, 50, "complete")]
    assert listing(200) == [(0, 100, "success"), (100, 100, "complete")]
    assert listing(0) == [(0, 0, "complete")]


def test_envelope_text(spark):
    rows = spark.createDataFrame([record(f"k{i:03d}", at(20, 10, i % 60)) for i in range(250)], RECORD)
    made = envelopes(
        rows, ["timestamp", "transaction_id"], DAY, time_format=TIME_FORMAT
    ).collect()
    by_key = {bytes(m.key).decode(): json.loads(bytes(m.value)) for m in made}
    assert {k: len(v) for k, v in by_key.items()} == {"2025_6_20_0": 100, "2025_6_20_100": 100, "2025_6_20_200": 50}
    sent = [r for k in ("2025_6_20_0", "2025_6_20_100", "2025_6_20_200") for r in by_key[k]]
    assert sent == sorted(sent, key=lambda r: (r["timestamp"], r["transaction_id"]))
    assert sent[0]["timestamp"] == "2025-06-20 10:00:00"


@pytest.mark.parametrize("order", [["ts"], ["x"], ["text"], ["x", "text"]])
def test_pages_follow_the_order(spark, order):
    """Pages cut at range bounds of any type, with NULL, NaN, ties and a repeated hour, are whole."""
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        rows = spark.range(0, 4000, 1, 4).selectExpr(
            "timestamp_seconds(1762063200 + id * 2) AS ts",
            "cast(id AS string) AS text",
            "if(id % 7 = 0, double('NaN'), if(id % 5 = 0, null, id * 1.5)) AS x",
        )
        position = {r.text: r.row_index for r in with_row_index(rows, order).collect()}
        made = envelopes(rows, order, DAY, page_size=30).collect()
        late = page_slice(rows, order, 2999, 77).collect()
        last = page_slice(rows, order, 3999, 77).collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    offsets = [int(bytes(m.key).decode().rpartition("_")[2]) for m in made]
    assert sorted(offsets) == list(range(0, 4000, 30))
    for offset, message in zip(offsets, made):
        sent = [position[r["text"]] for r in json.loads(bytes(message.value))]
        assert sent == list(range(offset, min(offset + 30, 4000)))
    assert [position[r.text] for r in late] == list(range(2999, 3076))
    assert [position[r.text] for r in last] == [3999]


def test_pages_move_the_rows_once_and_leave_no_copy(spark):
    scratch = Path(scratch_dir(spark))
    before = set(scratch.iterdir())
    rows = numbers(spark, 30_000, 8).withColumn("k", F.expr("if(id % 3 = 0, 0, id)"))
    made = envelopes(rows, ["k"], DAY)
    sizes = [r["count"] for r in made.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == 300 and max(sizes) < 2 * 300 / 8
    made.collect()
    text = plan(made).split("Initial Plan")[0]
    assert text.count("Exchange") == 1 and "Join" not in text
    page_slice(rows, ["k"], 20_000).collect()
    assert set(scratch.iterdir()) == before


def test_pages_of_no_rows(spark):
    assert envelopes(numbers(spark, 10).limit(0), ["k"], DAY).collect() == []


def test_missing_values_on_the_wire(spark):
    """Bare NaN tokens come back as what the quality rules reject; other text is untouched."""
    rows = spark.createDataFrame(
        [
            record('quo"te, null:null', at(20)),
            record("b", at(20), price=None),
            record("c", at(20), order_type=None),
            record("d", at(20), exchange=None),
            record("e", at(20), quantity=None),
            record("f", at(20), price=float("nan")),
        ],
        RECORD,
    )
    text = sorted(r[0] for r in rows.select(record_json(rows, "nan")).collect())
    assert sum("NaN" in t for t in text) == 5 and not any('"NaN"' in t for t in text)
    back = decode(envelopes(rows, ["timestamp", "transaction_id"], DAY, missing="nan"))
    got = {r.transaction_id: r for r in back.collect()}
    assert got["c"].order_type == '"NaN"' and got["d"].exchange == '"NaN"'
    assert got["b"].price != got["b"].price and got["e"].quantity is None
    assert [r.transaction_id for r in clean(back).collect()] == ['quo"te, null:null']


@pytest.mark.parametrize("fmt", ["parquet", "text"])
def test_message_files(spark, tmp_path, fmt):
    rows = spark.createDataFrame([record("a", at(20)), record("b", at(20))], RECORD)
    for _ in range(2):
        messages.write(envelopes(rows, ["transaction_id"], DAY), str(tmp_path), "t", fmt)
    back = messages.read_batch(spark, str(tmp_path), "t", fmt)
    assert sorted(r.transaction_id for r in decode(back).collect()) == ["a", "a", "b", "b"]


def test_day_file(spark, tmp_path):
    rows = [record('a "quoted", b', at(20), price=1.25), record("c", at(20), price=None, order_type=None)]
    path = write_day_file(spark.createDataFrame(rows, RECORD), str(tmp_path), DAY, TIME_FORMAT)
    assert path == day_file(str(tmp_path), DAY) == f"{tmp_path}/stock_transactions_2025_6_20.csv"
    back = read_day_file(spark, str(tmp_path), DAY)
    assert sorted(tuple(r) for r in back.collect()) == sorted(rows)
    lines = [r.value for r in spark.read.text(path).collect()]
    assert ",".join(RECORD.fieldNames()) in lines
    assert 'c,2025-06-20 10:00:00,AAPL,,1,,NASDAQ' in lines


def test_day_file_keeps_fractions(spark, tmp_path):
    rows = spark.createDataFrame([record("a", at(20).replace(microsecond=1234))], RECORD)
    write_day_file(rows, str(tmp_path), DAY)
    assert read_day_file(spark, str(tmp_path), DAY).collect() == rows.collect()


def test_counts_cover_all_batches(spark, tmp_path):
    """A query remembers few of its batches; the counts must not depend on that."""
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "2")
    try:
        one = spark.createDataFrame([record("a", at(20))], RECORD)
        for _ in range(5):
            messages.write(envelopes(one, ["transaction_id"], DAY), str(tmp_path), "t", "parquet")
        source = messages.read_stream(spark, str(tmp_path), "t", "parquet", maxFilesPerTrigger="1")
        counts = ingest_available(source, f"{tmp_path}/raw", f"{tmp_path}/checkpoint", "t")
    finally:
        spark.conf.unset("spark.sql.streaming.numRecentProgressUpdates")
    assert counts == {"messages": 5, "undecodable": 0}


def test_row_index_needs_no_single_partition(spark):
    indexed = with_row_index(numbers(spark, 1000), ["k"])
    assert "SinglePartition" not in plan(indexed)


def test_pages_of_many_ranges_need_no_window_and_no_sort_by_a_structure(spark):
    """Places are numbered in sorted partitions, and ranges are found by compiled steps."""
    rows = spark.createDataFrame([(i % 7 or None, i) for i in range(1234)], "k int, v int")
    sent = envelopes(rows, ["k"], DAY, page_size=10, partitions=9)
    text = plan(sent)
    assert "Window" not in text and "lambdafunction" not in text
    pages = {int(bytes(r.key).decode().rsplit("_", 1)[1]): json.loads(bytes(r.value)) for r in sent.collect()}
    assert sorted(pages) == list(range(0, 1234, 10))
    assert all(len(page) == 10 for offset, page in pages.items() if offset < 1230)
    got = [record for _, page in sorted(pages.items()) for record in page]
    assert [r.get("k", 0) for r in got] == sorted(i % 7 for i in range(1234))
    assert sorted(r["v"] for r in got) == list(range(1234))
