"""Every operator as a query over the driver's tables."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager
from datetime import date
from threading import Thread

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradelake import schemas
from tradelake.functions.minutes import minute_index, nearest_minute, session_minute
from tradelake.operators.align import at_minute, lookup, minute_grid
from tradelake.operators.dedup import latest_per_key
from tradelake.operators.paging import envelopes, page_listing, page_slice, page_status
from tradelake.operators.quality import clean, stage_counts
from tradelake.operators.replace import append_rows, replace_days
from tradelake.operators.slices import day_slice, to_raw
from tradelake.operators.summaries import (
    EXCHANGE,
    MARKET,
    ORDER_TYPE,
    STOCK,
    SUMMARIES,
    Summary,
    day_totals,
    roll_up,
    summarise,
)
from tradelake.operators.upsert import upsert, upsert_into
from tradelake.plans.daily import Lake, clean_days, clean_pending, ingest_day, report_days
from tradelake.session import scratch_path, stage, staged
from tradelake.sources import catalog, messages
from tradelake.sources.day_files import read_day_file, write_day_file
from tradelake.sources.compaction import pack
from tradelake.sources.raw import read_raw
from tradelake.sources.trades import folded, moved_to_today, table, trades
from tradelake.sources.tables import CatalogTable, FolderTable
from tradelake.functions.calendar import day_name, day_parts
from tradelake.streaming.ingest import decode, ingest_available
from tradelake.streaming.service import IngestService

Query = Callable[[SparkSession, str], DataFrame]

KEY = ["transaction_id"]
RUN_DAY = date(2024, 1, 31)
EVENT_ORDER = ["ts", "event_id"]
MICROS = "yyyy-MM-dd HH:mm:ss.SSSSSS"
EVENT = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("ts", T.TimestampNTZType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("props", T.StringType()),
    ]
)
RAW_EVENT = T.StructType([*EVENT.fields, *schemas.RAW.fields[-3:]])


# -- trades: raw, cleaned, deduplicated, upserted


def bronze(spark: SparkSession, folder: str) -> DataFrame:
    return to_raw(trades(spark, folder), "ts")


def silver(spark: SparkSession, folder: str) -> DataFrame:
    return latest_per_key(clean(bronze(spark, folder)), KEY)


def _nan_as_flag(df: DataFrame, column: str) -> DataFrame:
    """NaN compares differently between engines: show it as NULL and a flag."""
    value = F.col(column)
    return df.withColumns(
        {column: F.nullif(value, F.lit(float("nan"))), f"{column}_nan": F.coalesce(F.isnan(value), F.lit(False))}
    )


def tx_bronze(spark: SparkSession, folder: str) -> DataFrame:
    return _nan_as_flag(bronze(spark, folder), "price")


def one_day(spark: SparkSession, folder: str) -> DataFrame:
    return _nan_as_flag(day_slice(bronze(spark, folder), date(1998, 5, 5)), "price")


def today_slice(spark: SparkSession, folder: str) -> DataFrame:
    """The current date's trades, by its parts."""
    return _nan_as_flag(day_slice(to_raw(moved_to_today(trades(spark, folder)), "ts"), None), "price")


def dq_clean(spark: SparkSession, folder: str) -> DataFrame:
    return clean(bronze(spark, folder))


def dq_stage_counts(spark: SparkSession, folder: str) -> DataFrame:
    return stage_counts(bronze(spark, folder), KEY)


def _two_batches(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    rows, cut = clean(bronze(spark, folder)), F.lit("1998-07-01").cast("timestamp_ntz")
    early, late = rows.filter(F.col("ts") < cut), rows.filter(F.col("ts") >= cut)
    return latest_per_key(early, KEY), latest_per_key(late, KEY)


def silver_upsert(spark: SparkSession, folder: str) -> DataFrame:
    early, late = _two_batches(spark, folder)
    return upsert(early, stage(late, "updates")[0], KEY)


def silver_upsert_reversed(spark: SparkSession, folder: str) -> DataFrame:
    early, late = _two_batches(spark, folder)
    return upsert(late, stage(early, "updates")[0], KEY)


def silver_table_upsert(spark: SparkSession, folder: str) -> DataFrame:
    root = scratch_path(spark, "silver-table")
    silver_table = FolderTable.of(spark, root, schemas.SILVER)
    for batch in _two_batches(spark, folder):
        with staged(batch, "updates") as updates:
            upsert_into(silver_table, updates, KEY)
    return silver_table.read()


# -- summaries


def _rounded(df: DataFrame) -> DataFrame:
    if "total_value" not in df.columns:
        return df
    return df.withColumn("total_value", F.round("total_value", 2))


def _gold(summary: Summary) -> Query:
    return lambda spark, folder: _rounded(summarise(silver(spark, folder), summary))


def _gold_bronze(summary: Summary) -> Query:
    def query(spark: SparkSession, folder: str) -> DataFrame:
        rows = _rounded(summarise(bronze(spark, folder), summary))
        return _nan_as_flag(rows, "total_value") if "total_value" in rows.columns else rows

    return query


@contextmanager
def _own_catalog(spark: SparkSession) -> Iterator[tuple[str, str]]:
    """A prefix for databases of one's own and the folder they are in; they are dropped at the end."""
    place = scratch_path(spark, "catalog")
    prefix = place.rsplit("/", 1)[1].replace("-", "_") + "_"
    try:
        yield prefix, place
    finally:
        catalog.drop_databases(spark, prefix=prefix)


def _market_table(spark: SparkSession, prefix: str, place: str) -> CatalogTable:
    catalog.create_tables(spark, [MARKET.table], prefix, location=place)
    return CatalogTable(spark, catalog.table_name(MARKET.table, prefix))


def _day_bounds(rows: DataFrame, column: str, inside: date) -> tuple[date, date]:
    """First and last day of the rows, widened to take in `inside`."""
    day = F.to_date(column)
    first, last = rows.agg(F.min(day), F.max(day)).first()
    return min(first or inside, inside), max(last or inside, inside)


def gold_append_twice(spark: SparkSession, folder: str) -> DataFrame:
    with _own_catalog(spark) as place, staged(summarise(silver(spark, folder), MARKET), "market") as rows:
        market = _market_table(spark, *place)
        for _ in range(2):
            append_rows(market, rows)
        return stage(_rounded(market.read()), "gold")[0]


def gold_replace_day(spark: SparkSession, folder: str) -> DataFrame:
    """Summaries of the raw rows first, then each half of the days replaced, the last one twice."""
    cut = date(1998, 7, 15)
    with _own_catalog(spark) as place, staged(summarise(silver(spark, folder), MARKET), "market") as rows:
        market = _market_table(spark, *place)
        append_rows(market, summarise(bronze(spark, folder), MARKET))
        first, last = _day_bounds(rows, "report_date", cut)
        replace_days(market, rows.filter(F.col("report_date") < F.lit(cut)), (first, date(1998, 7, 14)))
        for _ in range(2):
            replace_days(market, rows.filter(F.col("report_date") >= F.lit(cut)), (cut, last))
        return stage(_rounded(market.read()), "gold")[0]


def ddl_tables(spark: SparkSession, folder: str) -> DataFrame:
    """Create the six tables, fill each from the trades and count what they hold."""
    with _own_catalog(spark) as (prefix, place):
        for _ in range(2):
            catalog.create_tables(spark, prefix=prefix, location=place)
        catalog.append_to(bronze(spark, folder), schemas.BRONZE, prefix)
        raw = spark.table(catalog.table_name(schemas.BRONZE, prefix))
        catalog.append_to(latest_per_key(clean(raw), KEY), schemas.SILVER, prefix)
        cleaned = spark.table(catalog.table_name(schemas.SILVER, prefix))
        with staged(day_totals(cleaned), "day-totals") as totals:
            for summary in SUMMARIES:
                catalog.append_to(roll_up(totals, summary), summary.table, prefix)
        counts = None
        for spec in schemas.TABLES:
            filled = spark.table(catalog.table_name(spec, prefix))
            parts = F.struct(*spec.partition_by)
            count = filled.agg(
                F.lit(spec.name).alias("table_name"),
                F.count(F.lit(1)).alias("row_count"),
                F.count_distinct(parts).alias("partition_count"),
            )
            counts = count if counts is None else counts.unionByName(count)
        return stage(counts, "counts")[0]


# -- events: pages, messages, streams, files


def events(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "events").select(EVENT.fieldNames())


def _event_messages(spark: SparkSession, folder: str) -> DataFrame:
    return envelopes(events(spark, folder), EVENT_ORDER, RUN_DAY, time_format=MICROS)


def json_decode_explode(spark: SparkSession, folder: str) -> DataFrame:
    return decode(_event_messages(spark, folder), EVENT)


def _streamed(spark: SparkSession, folder: str, runs: int) -> DataFrame:
    root, topic = scratch_path(spark, "stream"), day_name(RUN_DAY)
    messages.write(_event_messages(spark, folder), f"{root}/topics", topic, "parquet")
    for _ in range(runs):
        source = messages.read_stream(spark, f"{root}/topics", topic, "parquet", maxFilesPerTrigger="4")
        ingest_available(source, f"{root}/raw", f"{root}/checkpoint", topic, record=EVENT, ts="ts")
    return read_raw(spark, f"{root}/raw", schema=RAW_EVENT)


def stream_append(spark: SparkSession, folder: str) -> DataFrame:
    return _streamed(spark, folder, 1)


def stream_restart(spark: SparkSession, folder: str) -> DataFrame:
    return _streamed(spark, folder, 2)


def stream_table(spark: SparkSession, folder: str) -> DataFrame:
    """Events by the native sink into a partitioned catalog table that was made before the stream."""
    root, topic = scratch_path(spark, "stream"), day_name(RUN_DAY)
    spec = schemas.TableSpec("streamed", "events", RAW_EVENT, schemas.DAY_PARTS)
    with _own_catalog(spark) as (prefix, place):
        catalog.create_tables(spark, [spec], prefix, location=place)
        try:
            name = catalog.table_name(spec, prefix)
            messages.write(_event_messages(spark, folder), f"{root}/topics", topic, "parquet")
            source = messages.read_stream(spark, f"{root}/topics", topic, "parquet", maxFilesPerTrigger="4")
            ingest_available(source, name, f"{root}/checkpoint", topic, record=EVENT, ts="ts", native=True)
            # The file sink doesn't tell the catalog about new partitions.
            spark.catalog.recoverPartitions(name)
            table = CatalogTable(spark, name)
            return stage(table.read(table.partitions()), "streamed")[0]
        finally:
            catalog.drop_databases(spark, [spec], prefix)


def _halves(rows: DataFrame) -> list[DataFrame]:
    """Messages in two parts, told by their keys."""
    return [rows.filter(F.pmod(F.xxhash64("key"), F.lit(2)) == n) for n in range(2)]


def stream_service(spark: SparkSession, folder: str) -> DataFrame:
    """An ingest that is started, fed twice, stopped by its file and started again."""
    root, topic = scratch_path(spark, "stream"), day_name(RUN_DAY)
    checkpoint = f"{root}/checkpoint"

    def start() -> IngestService:
        source = messages.read_stream(spark, f"{root}/topics", topic, "parquet", maxFilesPerTrigger="8")
        return IngestService(
            source, f"{root}/raw", checkpoint, topic, every="200 milliseconds", look=0.2, record=EVENT, ts="ts"
        )

    with staged(_event_messages(spark, folder), "messages") as sent:
        first, second = _halves(sent)
        messages.write(first.limit(0), f"{root}/topics", topic, "parquet")
        service = start()
        running = Thread(target=service.run)
        running.start()
        try:
            messages.write(first, f"{root}/topics", topic, "parquet")
            service.query.processAllAvailable()
        finally:
            IngestService.request_stop(spark, checkpoint)
            running.join()
        messages.write(second, f"{root}/topics", topic, "parquet")
    again = start()
    again.query.processAllAvailable()
    again.finish()
    return read_raw(spark, f"{root}/raw", schema=RAW_EVENT)


def stream_compact(spark: SparkSession, folder: str) -> DataFrame:
    """Many small batches, packed twice with more of them between."""
    root, topic = scratch_path(spark, "stream"), day_name(RUN_DAY)
    with staged(_event_messages(spark, folder), "messages") as sent:
        for part in _halves(sent):
            messages.write(part, f"{root}/topics", topic, "parquet")
            source = messages.read_stream(spark, f"{root}/topics", topic, "parquet", maxFilesPerTrigger="2")
            ingest_available(source, f"{root}/raw", f"{root}/checkpoint", topic, record=EVENT, ts="ts")
            pack(spark, f"{root}/raw", schema=RAW_EVENT)
    return read_raw(spark, f"{root}/raw", schema=RAW_EVENT)


def envelope_pages(spark: SparkSession, folder: str) -> DataFrame:
    """Pages as they come out of the messages: page number from the key, place from the array."""
    offset = F.element_at(F.split(F.col("key").cast("string"), "_"), -1).cast("long")
    records = F.from_json(F.col("value").cast("string"), T.ArrayType(EVENT))
    return (
        _event_messages(spark, folder)
        .select(F.floor(offset / 100).alias("page"), F.posexplode(records).alias("place", "event"))
        .select("page", "place", "event.*")
    )


def one_page(spark: SparkSession, folder: str) -> DataFrame:
    rows = events(spark, folder)
    status = page_status(rows, 300).select("status").scalar()
    return page_slice(rows, EVENT_ORDER, 300).withColumn("status", status)


def all_pages(spark: SparkSession, folder: str) -> DataFrame:
    return page_listing(events(spark, folder))


def csv_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    place = scratch_path(spark, "day-files")
    write_day_file(events(spark, folder), place, RUN_DAY)
    return read_day_file(spark, place, RUN_DAY, EVENT)


def wire_missing_values(spark: SparkSession, folder: str) -> DataFrame:
    """Trades sent with bare NaN tokens for whatever is missing, then decoded."""
    records = trades(spark, folder).withColumnRenamed("ts", "timestamp")
    sent = envelopes(records, ["timestamp", *KEY], RUN_DAY, missing="nan")
    return _nan_as_flag(to_raw(decode(sent)), "price")


# -- minutes and lookups


def session_grid(spark: SparkSession, folder: str) -> DataFrame:
    return minute_grid(events(spark, folder), "ts")


def nearest(spark: SparkSession, folder: str) -> DataFrame:
    ts = F.col("ts")
    return events(spark, folder).select(
        "event_id",
        nearest_minute(ts).alias("minute"),
        session_minute(ts).alias("session_minute"),
        minute_index(ts).alias("minute_index"),
    )


def minute_lookup(spark: SparkSession, folder: str) -> DataFrame:
    rows = events(spark, folder)
    return at_minute(rows.select("event_id", "ts"), minute_grid(rows, "ts"), "ts")


def dim_enrich(spark: SparkSession, folder: str) -> DataFrame:
    nation = table(spark, folder, "nation").withColumnRenamed("n_nationkey", "s_nationkey")
    return lookup(table(spark, folder, "supplier"), nation, "s_nationkey")


def symbol_lookup(spark: SparkSession, folder: str) -> DataFrame:
    """Exchange and base price per symbol, from the suppliers, added to every trade."""
    slot = F.col("s_suppkey") % 20
    symbols = (
        table(spark, folder, "supplier")
        .groupBy(F.concat(F.lit("S"), F.lpad(slot.cast("string"), 2, "0")).alias("stock_symbol"))
        .agg(
            F.max(F.when(slot < 10, "NASDAQ").otherwise("NYSE")).alias("home_exchange"),
            F.max("s_acctbal").alias("base_price"),
        )
    )
    rows = clean(bronze(spark, folder)).select("transaction_id", "ts", "stock_symbol", "price", "quantity")
    # Staged, the few symbols have a size that the planner knows.
    return lookup(rows, stage(symbols, "symbols")[0], "stock_symbol")


# -- all steps


def daily_run(spark: SparkSession, folder: str) -> DataFrame:
    """All trades as messages, streamed, cleaned, upserted and summarised over their days."""
    root = scratch_path(spark, "lake")
    lake = Lake(spark, root)
    records = trades(spark, folder).withColumnRenamed("ts", "timestamp")
    sent = envelopes(records, ["timestamp", *KEY], RUN_DAY, missing="nan")
    messages.write(sent, f"{root}/topics", day_name(RUN_DAY), "parquet")
    ingest_day(lake, f"{root}/topics", RUN_DAY)
    days = _day_bounds(records, "timestamp", RUN_DAY)
    clean_days(lake, days)
    report_days(lake, days)
    return _rounded(lake.gold(STOCK).read())


def _send(lake: Lake, records: DataFrame, day: date) -> str:
    sent = envelopes(records.withColumnRenamed("ts", "timestamp"), ["timestamp", *KEY], day, missing="nan")
    place = f"{lake.root}/topics"
    messages.write(sent, place, day_name(day), "parquet")
    return place


def _halved(rows: DataFrame, *by: str) -> DataFrame:
    """Each row with the number of its half."""
    return rows.withColumn("_half", F.pmod(F.xxhash64(*by), F.lit(2)))


def _half(halved: DataFrame, number: int) -> DataFrame:
    return halved.filter(F.col("_half") == number).drop("_half")


def daily_run_tables(spark: SparkSession, folder: str) -> DataFrame:
    """The daily jobs over catalog tables: two topics, cleaned and reported by table name."""
    with _own_catalog(spark) as (prefix, place):
        lake = Lake(spark, scratch_path(spark, "lake"), prefix)
        lake.create(place)
        with staged(_halved(folded(trades(spark, folder)), *KEY), "records") as rows:
            for number, day in enumerate((RUN_DAY, date(2024, 2, 1))):
                ingest_day(lake, _send(lake, _half(rows, number), day), day)
            days = _day_bounds(rows, "ts", RUN_DAY)
        for _ in range(2):
            clean_days(lake, days)
        report_days(lake, days)
        return stage(_rounded(lake.gold(STOCK).read()), "gold")[0]


def late_days(spark: SparkSession, folder: str) -> DataFrame:
    """Two topics with rows of the same days; after each, the days to clean come from the ledger."""
    lake = Lake(spark, scratch_path(spark, "lake"))
    with staged(_halved(folded(trades(spark, folder)), "ts", *KEY), "records") as rows:
        for number, day in enumerate((RUN_DAY, date(2024, 2, 1))):
            ingest_day(lake, _send(lake, _half(rows, number), day), day)
            clean_pending(lake)
    return lake.silver.read()


def empty_day(spark: SparkSession, folder: str) -> DataFrame:
    """What cleaning counts for a day without rows, and for one of the days that have some."""
    lake = Lake(spark, scratch_path(spark, "lake"))
    ingest_day(lake, _send(lake, folded(trades(spark, folder)), RUN_DAY), RUN_DAY)
    out = []
    for day in (date(1997, 1, 1), date(1998, 6, 20)):
        counts = clean_days(lake, day)
        out.append((day, counts.rows_read, counts.rows_clean, counts.rows_deduplicated, lake.silver.read().count()))
    columns = "day date, rows_read long, rows_clean long, rows_deduplicated long, silver_rows long"
    return spark.createDataFrame(out, columns)


QUERIES: dict[str, Query] = {
    "tx_bronze": tx_bronze,
    "day_slice": one_day,
    "today_slice": today_slice,
    "dq_clean": dq_clean,
    "dq_stage_counts": dq_stage_counts,
    "dedup_latest": silver,
    "silver_upsert": silver_upsert,
    "silver_upsert_reversed": silver_upsert_reversed,
    "silver_table_upsert": silver_table_upsert,
    "gold_market": _gold(MARKET),
    "gold_stock": _gold(STOCK),
    "gold_order_type": _gold(ORDER_TYPE),
    "gold_exchange": _gold(EXCHANGE),
    "gold_market_bronze": _gold_bronze(MARKET),
    "gold_stock_bronze": _gold_bronze(STOCK),
    "gold_order_type_bronze": _gold_bronze(ORDER_TYPE),
    "gold_exchange_bronze": _gold_bronze(EXCHANGE),
    "gold_append_twice": gold_append_twice,
    "gold_replace_day": gold_replace_day,
    "ddl_tables": ddl_tables,
    "json_decode_explode": json_decode_explode,
    "stream_append": stream_append,
    "stream_restart": stream_restart,
    "stream_table": stream_table,
    "stream_service": stream_service,
    "stream_compact": stream_compact,
    "envelope_pages": envelope_pages,
    "page_slice": one_page,
    "page_listing": all_pages,
    "csv_roundtrip": csv_roundtrip,
    "wire_missing_values": wire_missing_values,
    "minute_grid": session_grid,
    "nearest_minute": nearest,
    "minute_lookup": minute_lookup,
    "dim_enrich": dim_enrich,
    "symbol_lookup": symbol_lookup,
    "daily_run": daily_run,
    "daily_run_tables": daily_run_tables,
    "late_days": late_days,
    "empty_day": empty_day,
}
