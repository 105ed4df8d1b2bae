"""Streaming ingest and the daily jobs."""

from __future__ import annotations

import subprocess
import sys
import time
from datetime import date, datetime
from pathlib import Path

import pytest
from helpers import at, key_times, raw, record

from tradelake import session
from tradelake.functions.calendar import day_name, today
from tradelake.operators.paging import envelopes
from tradelake.operators.summaries import MARKET, SUMMARIES
from tradelake.plans import queries
from tradelake.plans.daily import StageCounts, clean_days, ingest_day, report_days, run_day
from tradelake.schemas import RAW, RECORD
from tradelake.sources import messages
from tradelake.sources.raw import read_raw, write_batch

DAY = date(2025, 6, 20)
NEXT = date(2025, 6, 21)


@pytest.fixture
def send(spark, tmp_path):
    def send(day, *records):
        rows = spark.createDataFrame(list(records), RECORD)
        sent = envelopes(rows, ["timestamp", "transaction_id"], day, missing="nan")
        messages.write(sent, send.place, day_name(day), "parquet")

    send.place = str(tmp_path / "topics")
    return send


def raw_times(lake):
    return key_times(read_raw(lake.spark, lake.raw_path))


def test_restart_adds_only_new_messages(lake, send):
    send(DAY, record("a", at(20)))
    assert ingest_day(lake, send.place, DAY, "parquet") == {"messages": 1, "undecodable": 0}
    assert ingest_day(lake, send.place, DAY, "parquet") == {"messages": 0, "undecodable": 0}
    send(DAY, record("b", at(20)))
    ingest_day(lake, send.place, DAY, "parquet")
    assert raw_times(lake) == [("a", at(20)), ("b", at(20))]
    assert read_raw(lake.spark, lake.raw_path).schema == RAW


def test_each_day_has_its_own_checkpoint_in_one_table(lake, send):
    send(DAY, record("a", at(20)))
    send(NEXT, record("b", at(21)), record("late", at(20, 15)))
    for day in (DAY, NEXT):
        ingest_day(lake, send.place, day, "parquet")
    assert raw_times(lake) == [("a", at(20)), ("b", at(21)), ("late", at(20, 15))]
    assert key_times(read_raw(lake.spark, lake.raw_path, DAY)) == [("a", at(20)), ("late", at(20, 15))]


def test_a_batch_written_again_replaces_itself(spark, lake, send):
    for _ in range(2):
        write_batch(raw(spark, record("a", at(20))), lake.raw_path, "t-0")
    write_batch(raw(spark, record("b", at(20))), lake.raw_path, "t-1")
    assert raw_times(lake) == [("a", at(20)), ("b", at(20))]


def test_unreadable_messages_are_counted(spark, lake, send):
    send(DAY, record("a", at(20)))
    broken = spark.createDataFrame([("k", '[{"transaction_id"'), ("n", None)], "key string, value string")
    messages.write(broken, send.place, day_name(DAY), "parquet")
    assert ingest_day(lake, send.place, DAY, "parquet") == {"messages": 2, "undecodable": 1}
    assert raw_times(lake) == [("a", at(20))]


def test_several_batches(lake, send):
    for i in range(5):
        send(DAY, record(f"k{i}", at(20)))
    ingest_day(lake, send.place, DAY, "parquet", maxFilesPerTrigger="1")
    assert len(raw_times(lake)) == 5


def test_run_day(lake, send):
    send(DAY, record("a", at(20, 10), quantity=1), record("a", at(20, 11), quantity=2), record("x", at(20), price=None))
    for _ in range(2):
        assert run_day(lake, send.place, DAY) == StageCounts(3, 2, 1)
    assert key_times(lake.silver.read()) == [("a", at(20, 11))]
    assert [(r.report_date, r.total_volume) for r in lake.gold(MARKET).read().collect()] == [(DAY, 2)]
    for summary in SUMMARIES:
        assert lake.gold(summary).read().count() == 1


def test_second_send_and_reused_ids(lake, send):
    """A retried sender adds raw duplicates; an id used again moves to its new day."""
    for _ in range(2):
        send(DAY, record("a", at(20)), record("b", at(20)))
    run_day(lake, send.place, DAY)
    send(NEXT, record("a", at(21)))
    run_day(lake, send.place, NEXT)
    assert len(raw_times(lake)) == 5
    assert key_times(lake.silver.read()) == [("a", at(21)), ("b", at(20))]
    volumes = {r.report_date: r.total_volume for r in lake.gold(MARKET).read().collect()}
    assert volumes == {DAY: 1, NEXT: 1}


def test_replay_picks_up_late_rows(lake, send):
    send(DAY, record("a", at(20)))
    run_day(lake, send.place, DAY)
    send(NEXT, record("late", at(20, 15)))
    run_day(lake, send.place, NEXT)
    assert key_times(lake.silver.read()) == [("a", at(20))]
    run_day(lake, send.place, DAY)
    assert key_times(lake.silver.read()) == [("a", at(20)), ("late", at(20, 15))]


def test_day_without_rows_changes_nothing(lake, send):
    send(DAY, record("a", at(20)))
    run_day(lake, send.place, DAY)
    files = lake.silver.read().inputFiles()
    assert clean_days(lake, NEXT) == StageCounts(0, 0, 0)
    assert lake.silver.read().inputFiles() == files


def test_day_of_rejected_rows_only(lake, send):
    send(DAY, record("a", at(20), price=None))
    assert run_day(lake, send.place, DAY) == StageCounts(1, 0, 0)
    assert lake.gold(MARKET).read().count() == 0


def test_append_mode_adds_again(lake, send):
    send(DAY, record("a", at(20)))
    run_day(lake, send.place, DAY)
    report_days(lake, DAY, mode="append")
    assert lake.gold(MARKET).read().count() == 2


def test_report_from_raw_rows(lake, send):
    send(DAY, record("a", at(20), quantity=1), record("b", at(20), quantity=2, order_type=None))
    ingest_day(lake, send.place, DAY, "parquet")
    report_days(lake, DAY, source=read_raw(lake.spark, lake.raw_path, DAY))
    assert [r.total_volume for r in lake.gold(MARKET).read().collect()] == [3]


def test_shared_folder_is_required_on_a_cluster(spark):
    class Cluster:
        class conf:
            get = staticmethod(lambda key, default=None: default)

        class sparkContext:
            master = "yarn"

    with pytest.raises(ValueError):
        session.shared_dir(Cluster)
    configured = spark.conf.get("spark.checkpoint.dir")
    assert session.scratch_path(spark, "x").startswith(configured)


def test_scratch_of_jobs_is_removed(spark, lake, send):
    from tradelake.sources import paths

    send(DAY, record("a", at(20)))
    run_day(lake, send.place, DAY)
    left = paths.child_names(spark, session.scratch_dir(spark))
    assert not [n for n in left if n.startswith(("updates-", "day-totals-", "replace-days-"))]


def test_an_id_that_moves_leaves_its_old_day_empty(lake, send):
    send(DAY, record("a", at(20), quantity=5))
    run_day(lake, send.place, DAY)
    send(NEXT, record("a", at(21), quantity=5))
    assert run_day(lake, send.place, NEXT).days == {DAY, NEXT}
    for summary in SUMMARIES:
        assert [r.report_date for r in lake.gold(summary).read().collect()] == [NEXT]


def test_report_from_a_source_takes_only_the_days_asked_for(lake, send):
    send(DAY, record("a", at(20)), record("b", at(21)))
    ingest_day(lake, send.place, DAY, "parquet")
    report_days(lake, DAY, source=read_raw(lake.spark, lake.raw_path), mode="append")
    assert [r.report_date for r in lake.gold(MARKET).read().collect()] == [DAY]


def test_jobs_without_a_day_take_the_current_date(spark, lake, send):
    now = today(spark)
    ten = datetime(now.year, now.month, now.day, 10)
    send(now, record("a", ten), record("old", at(20)))
    assert run_day(lake, send.place) == StageCounts(1, 1, 1)
    assert key_times(lake.silver.read()) == [("a", ten)]
    report_days(lake, None)
    assert [r.report_date for r in lake.gold(MARKET).read().collect()] == [now]


def test_several_days_list_only_their_months(spark, lake):
    rows = raw(spark, record("a", at(20)), record("b", at(21)), record("c", at(1, month=8)), record("d", at(1, month=9)))
    write_batch(rows, lake.raw_path, "t-0")
    ranged = read_raw(spark, lake.raw_path, (DAY, date(2025, 8, 1)))
    assert key_times(ranged) == [("a", at(20)), ("b", at(21)), ("c", at(1, month=8))]
    assert not [f for f in ranged.inputFiles() if "ts_month=9" in f]
    some = read_raw(spark, lake.raw_path, frozenset({NEXT, date(2025, 9, 1)}))
    assert key_times(some) == [("b", at(21)), ("d", at(1, month=9))]
    assert not [f for f in some.inputFiles() if "ts_month=8" in f]
    assert read_raw(spark, lake.raw_path, (date(2026, 1, 1), date(2026, 1, 2))).count() == 0
    assert read_raw(spark, lake.raw_path, frozenset()).count() == 0


def test_a_batch_of_many_tasks_gives_one_file_a_day(spark, lake):
    rows = raw(spark, *(record(f"k{i}", at(20 + i % 2)) for i in range(80))).repartition(16)
    write_batch(rows, lake.raw_path, "t-0")
    assert len(read_raw(spark, lake.raw_path).inputFiles()) == 2


def test_scratch_goes_with_the_application(tmp_path):
    """Of copies that a returned frame still reads, none is left when the driver has ended."""
    code = (
        "from tradelake.operators.paging import page_slice, envelopes\n"
        "from tradelake.session import get_session\n"
        "from datetime import date\n"
        f"s = get_session('t', 'local[1]', spark__ui__enabled='false', spark__sql__shuffle__partitions='2', spark__checkpoint__dir='{tmp_path}')\n"
        "assert page_slice(s.range(3000), ['id'], 2000).count() == 100\n"
        "assert envelopes(s.range(300), ['id'], date(2025, 1, 1)).count() == 3\n"
    )
    root = Path(__file__).resolve().parents[1]
    subprocess.run([sys.executable, "-c", code], check=True, cwd=root, timeout=120, capture_output=True)
    for _ in range(100):  # the JVM ends a little after the driver's Python
        left = [p for p in tmp_path.iterdir() if p.name.startswith("scratch-")]
        if not left:
            break
        time.sleep(0.1)
    assert not left


@pytest.mark.parametrize("name", ["daily_run_tables", "late_days"])
def test_records_are_made_once(spark, sf, monkeypatch, name):
    """Both topics are sent from rows that were derived and written once."""

    class Sent(Exception):
        pass

    def send(lake, records, day):
        read.extend(records.inputFiles())
        raise Sent

    read = []
    monkeypatch.setattr(queries, "_send", send)
    with pytest.raises(Sent):
        queries.QUERIES[name](spark, sf)
    assert read and not any("lineitem" in file for file in read)
