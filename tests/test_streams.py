"""Compaction of streamed batches, the ledger, the ingest that goes on, jobs by table name."""

from __future__ import annotations

from datetime import date
from threading import Thread

import pytest
from helpers import at, key_times, plan, raw, record
from pyspark.sql import functions as F

from tradelake.functions.calendar import day_name
from tradelake.operators.paging import envelopes
from tradelake.operators.quality import stage_counts
from tradelake.operators.summaries import MARKET
from tradelake.plans.daily import Lake, StageCounts, clean_days, clean_pending, ingest_day, run_pending
from tradelake.schemas import RECORD
from tradelake.sources import catalog, compaction, messages, paths
from tradelake.sources.compaction import bins_of, finished_batches, pack
from tradelake.sources.raw import batch_range, covered_names, read_raw, write_batch
from tradelake.streaming.ledger import Ledger
from tradelake.streaming.service import IngestService

DAY, NEXT = date(2025, 6, 20), date(2025, 6, 21)


@pytest.fixture
def send(spark, tmp_path):
    def send(day, *records):
        rows = spark.createDataFrame(list(records), RECORD)
        sent = envelopes(rows, ["timestamp", "transaction_id"], day, missing="nan")
        messages.write(sent, send.place, day_name(day), "parquet")

    send.place = str(tmp_path / "topics")
    return send


# -- compaction


def test_batch_names():
    assert batch_range("a-b-00000007") == ("a-b", 7, 7)
    assert batch_range("s-00000003..00000012") == ("s", 3, 12)
    assert batch_range("other") is None and batch_range("s-x") is None and batch_range("s-1..") == ("s", 1, 1)
    names = ["s-00000001", "s-00000005", "s-00000001..00000003", "s-00000000..00000003", "t-00000002"]
    assert sorted(covered_names(names)) == ["s-00000001", "s-00000001..00000003"]


def test_bins_fill_up_to_the_target_in_order():
    sizes = {f"s-{i:08d}": 40 for i in range(7)} | {"t-00000000": 1, "s-00000007": 500, "t-00000001": 1}
    made = bins_of("d", sizes, {"s": 7, "t": 0}, 100)
    assert [b.name for b in made] == ["s-00000000..00000001", "s-00000002..00000003", "s-00000004..00000005"]
    assert finished_batches({"d": sizes, "e": {"t-00000009": 1}}) == {"s": 6, "t": 8}
    assert bins_of("d", {}, {}, 100) == []


def files_read(df) -> int:
    return df.select(F.input_file_name()).distinct().count()


def _batches(spark, path, numbers, days=(20, 21)):
    for i in numbers:
        write_batch(raw(spark, *(record(f"k{i}-{d}", at(d)) for d in days)), path, f"s-{i:08d}")


def test_a_hundred_batches_become_one_file_a_day(spark, tmp_path):
    path = str(tmp_path / "raw")
    rows = raw(spark, *(record(f"k{i}", at(20), quantity=i) for i in range(100)))
    # One write in place of a hundred: the batch is a folder of its own either way.
    rows.selectExpr("*", "concat('s-', lpad(string(quantity), 8, '0')) AS ingest").write.partitionBy(
        "ts_year", "ts_month", "ts_day", "ingest"
    ).parquet(path)
    before = key_times(read_raw(spark, path))
    assert len(read_raw(spark, path).inputFiles()) == 100
    (one,) = pack(spark, path, finished={"s": 99})
    assert one.name == "s-00000000..00000099"
    assert files_read(read_raw(spark, path, DAY)) == 1 == files_read(read_raw(spark, path))
    assert key_times(read_raw(spark, path)) == before == key_times(read_raw(spark, path, DAY))
    assert pack(spark, path) == []
    assert len(paths.glob(spark, f"{path}/*/*/*/ingest=*")) == 1


def test_readers_keep_what_they_began_with(spark, tmp_path):
    path = str(tmp_path / "raw")
    _batches(spark, path, range(3))
    old = read_raw(spark, path)
    pack(spark, path)
    assert key_times(old) == key_times(read_raw(spark, path))
    # Batches that came after the packing are read beside it, and the last one is left alone.
    _batches(spark, path, [3])
    assert len(key_times(read_raw(spark, path))) == 8
    names = [b.name for b in pack(spark, path)]
    assert names == ["s-00000000..00000002"] * 2
    assert len(key_times(read_raw(spark, path))) == 8


def test_packing_can_break_off_anywhere(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "raw")
    _batches(spark, path, range(4))
    before = key_times(read_raw(spark, path))
    real, calls = paths.rename, []

    def rename(*args):
        calls.append(args)
        if len(calls) == 2:
            raise OSError("lost")
        real(*args)

    monkeypatch.setattr(compaction.paths, "rename", rename)
    with pytest.raises(OSError):
        pack(spark, path)
    monkeypatch.undo()
    assert key_times(read_raw(spark, path)) == before
    for _ in range(2):
        pack(spark, path)
        assert key_times(read_raw(spark, path)) == before == key_times(read_raw(spark, path, (DAY, NEXT)))
    assert not [n for n in paths.child_names(spark, path) if n.startswith("_packing")]


def test_rows_without_a_day_are_packed_too(spark, tmp_path):
    path = str(tmp_path / "raw")
    for i in range(3):
        write_batch(raw(spark, record(f"k{i}", None)), path, f"s-{i:08d}")
    assert len(pack(spark, path, finished={"s": 2})) == 1
    assert key_times(read_raw(spark, path)) == [(f"k{i}", None) for i in range(3)]
    assert files_read(read_raw(spark, path)) == 1


def test_packing_nothing(spark, tmp_path):
    assert pack(spark, str(tmp_path / "none")) == []


# -- ledger


def test_pending_days(spark, tmp_path):
    ledger = Ledger(spark, str(tmp_path))
    assert ledger.pending().isEmpty()
    ledger.add("s-0", [DAY, None], 5)
    ledger.add("s-1", [DAY, NEXT], 3)
    assert sorted((r.batch, r.day) for r in ledger.pending().collect() if r.day) == [
        ("s-0", DAY), ("s-1", DAY), ("s-1", NEXT)
    ]
    ledger.mark(ledger.pending().filter("batch = 's-0'"))
    assert {r.batch for r in ledger.pending().collect()} == {"s-1"}
    # A batch that is written again has one entry.
    ledger.add("s-1", [NEXT], 3)
    assert [(r.batch, r.day) for r in ledger.pending().collect()] == [("s-1", NEXT)]
    ledger.mark(ledger.pending())
    assert ledger.pending().isEmpty()


def test_late_rows_are_found_without_naming_their_day(lake, send):
    send(DAY, record("a", at(20)))
    ingest_day(lake, send.place, DAY, "parquet")
    assert run_pending(lake).days == {DAY}
    assert clean_pending(lake) == StageCounts(0, 0, 0)
    send(NEXT, record("late", at(20, 15)), record("b", at(21)))
    ingest_day(lake, send.place, NEXT, "parquet")
    assert run_pending(lake).days == {DAY, NEXT}
    assert key_times(lake.silver.read()) == [("a", at(20)), ("b", at(21)), ("late", at(20, 15))]
    assert sorted((r.report_date, r.total_volume) for r in lake.gold(MARKET).read().collect()) == [(DAY, 2), (NEXT, 1)]


def test_days_stay_pending_when_cleaning_breaks_off(lake, send, monkeypatch):
    from tradelake.plans import daily

    send(DAY, record("a", at(20)))
    ingest_day(lake, send.place, DAY, "parquet")

    def lost(*_):
        raise OSError("lost")

    monkeypatch.setattr(daily, "upsert_into", lost)
    with pytest.raises(OSError):
        clean_pending(lake)
    monkeypatch.undo()
    assert clean_pending(lake).days == {DAY}


# -- counts in the pass that writes


def test_counts_equal_those_of_a_scan(spark, lake, send):
    send(DAY, record("a", at(20), price=None), record("a", at(20, 11)), record("a", at(20, 12)), record(None, at(20)))
    ingest_day(lake, send.place, DAY, "parquet")
    counts = clean_days(lake, DAY)
    wanted = stage_counts(lake.raw(DAY)).first()
    assert counts == StageCounts(wanted.rows_read, wanted.rows_clean, wanted.rows_deduplicated) == StageCounts(4, 3, 2)


def test_cleaning_scans_the_raw_rows_once(spark, lake, send, monkeypatch):
    """Every use of the raw rows counts, the counts of the stages included."""
    send(DAY, record("a", at(20)))
    ingest_day(lake, send.place, DAY, "parquet")
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    real = Lake.raw
    monkeypatch.setattr(Lake, "raw", lambda self, days: (df := real(self, days)).mapInArrow(counted, df.schema))
    clean_days(lake, DAY)
    assert seen.value == 1


# -- an ingest that goes on


def test_service_is_fed_stopped_and_started_again(spark, lake, send):
    checkpoint = lake.checkpoint(DAY)
    send(DAY, record("a", at(20)))

    def start():
        source = messages.read_stream(spark, send.place, day_name(DAY), "parquet")
        return IngestService(source, lake.raw_path, checkpoint, day_name(DAY), every="100 milliseconds", look=0.2)

    service = start()
    running = Thread(target=service.run)
    running.start()
    service.query.processAllAvailable()
    send(DAY, record("b", at(20)))
    service.query.processAllAvailable()
    IngestService.request_stop(spark, checkpoint)
    running.join(60)
    assert not running.is_alive() and not service.query.isActive
    assert not paths.exists(spark, IngestService.stop_file(checkpoint))
    send(DAY, record("c", at(21)))
    again = start()
    again.query.processAllAvailable()
    again.finish()
    assert key_times(read_raw(spark, lake.raw_path)) == [("a", at(20)), ("b", at(20)), ("c", at(21))]
    told = IngestService.progress(spark, checkpoint).orderBy("batch").collect()
    assert [(r.batch, r.messages, r.undecodable) for r in told] == [(0, 1, 0), (1, 1, 0), (2, 1, 0)]
    assert len({r.run for r in told}) == 2


def test_service_raises_what_the_stream_raises(spark, lake, send, monkeypatch):
    from tradelake.streaming import ingest

    def lost(*_):
        raise OSError("lost")

    monkeypatch.setattr(ingest, "write_batch", lost)
    send(DAY, record("a", at(20)))
    source = messages.read_stream(spark, send.place, day_name(DAY), "parquet")
    service = IngestService(source, lake.raw_path, lake.checkpoint(DAY), day_name(DAY), every="100 milliseconds", look=0.2)
    with pytest.raises(Exception, match="lost"):
        service.run()


# -- by table name


def test_jobs_over_catalog_tables(request, spark, tmp_path, send):
    request.addfinalizer(lambda: catalog.drop_databases(spark, prefix="jobs_"))
    lake = Lake(spark, str(tmp_path / "lake"), "jobs_")
    for _ in range(2):
        lake.create(str(tmp_path / "warehouse"))
    send(DAY, record("a", at(20)), record("b", at(20), quantity=3), record("x", at(20), price=None))
    send(NEXT, record("a", at(21)), record("late", at(20, 15)))
    for _ in range(2):
        for day in (DAY, NEXT):
            ingest_day(lake, send.place, day, "parquet")
        run_pending(lake)
    assert len(key_times(lake.raw())) == 5 and len(key_times(lake.raw(DAY))) == 4
    scan = plan(lake.raw(DAY))
    assert "PartitionFilters: [" in scan and "ts_day" in scan.split("PartitionFilters")[1][:300]
    assert key_times(spark.table("jobs_stocks.transactions_cleaned")) == [("a", at(21)), ("b", at(20)), ("late", at(20, 15))]
    volumes = {r.report_date: r.total_volume for r in spark.table("jobs_stocks_reporting.daily_market_summary").collect()}
    assert volumes == {DAY: 4, NEXT: 1}
    assert not paths.exists(spark, f"{lake.root}/stocks")
