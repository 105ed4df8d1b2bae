"""The daily jobs: ingest, clean and report, each for explicit days."""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from datetime import date

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tradelake.functions.calendar import Days, day_name, today
from tradelake.operators.dedup import latest_per_key
from tradelake.operators.quality import TRADE_RULES, Rule, clean, passes
from tradelake.operators.replace import append_rows, replace_days
from tradelake.operators.slices import day_slice
from tradelake.operators.summaries import SUMMARIES, Summary, day_totals, roll_up
from tradelake.operators.upsert import upsert_into
from tradelake.schemas import BRONZE, SILVER, TABLES, TableSpec
from tradelake.session import observed, staged
from tradelake.sources import catalog, messages
from tradelake.sources.raw import read_raw, read_raw_table
from tradelake.sources.tables import FILE_FORMATS, CatalogTable, FolderTable, PartitionedTable
from tradelake.streaming.ingest import ingest_available
from tradelake.streaming.ledger import Ledger


@dataclass(frozen=True)
class Lake:
    """Where the tables and checkpoints live.

    Tables are folders below `root`. With `prefix`, they are tables of a catalog instead, whose names begin with
    it (`"lake."`, or part of a database's name); `root` has checkpoints and the ledger. `using` is the
    format new tables get. File formats take streamed batches as partitions, others by their own sink.
    """

    spark: SparkSession
    root: str
    prefix: str | None = None
    using: str = "parquet"

    def create(self, location: str | None = None) -> None:
        """Create the catalog tables that do not exist yet."""
        raw = catalog.RAW_BY_BATCH if self.using in FILE_FORMATS else BRONZE
        specs = (raw, *TABLES[1:])
        catalog.create_tables(self.spark, specs, self.prefix, self.using, location)

    def _table(self, spec: TableSpec) -> PartitionedTable:
        if self.prefix is None:
            return FolderTable.of(self.spark, self.root, spec)
        return CatalogTable(self.spark, catalog.table_name(spec, self.prefix))

    @property
    def raw_path(self) -> str:
        """The raw table's folder, or its name in the catalog."""
        if self.prefix is not None:
            return catalog.table_name(BRONZE, self.prefix)
        return f"{self.root}/{BRONZE.database}/{BRONZE.name}"

    @property
    def raw_format(self) -> str:
        if self.prefix is None:
            return "parquet"
        return "table" if self.using in FILE_FORMATS else self.using

    def raw(self, days: Days | str = "all") -> DataFrame:
        read = read_raw if self.prefix is None else read_raw_table
        return read(self.spark, self.raw_path, days)

    @property
    def silver(self) -> PartitionedTable:
        return self._table(SILVER)

    def gold(self, summary: Summary) -> PartitionedTable:
        return self._table(summary.table)

    @property
    def ledger(self) -> Ledger:
        return Ledger(self.spark, f"{self.root}/ledger")

    def checkpoint(self, day: date) -> str:
        return f"{self.root}/checkpoints/{day_name(day)}_checkpoint"


@dataclass(frozen=True)
class StageCounts:
    rows_read: int
    rows_clean: int
    rows_deduplicated: int
    # Days whose cleaned rows changed, also those that an id moved away from.
    days: frozenset[date] = field(default=frozenset(), compare=False)


def ingest_day(
    lake: Lake, place: str, day: date | None = None, fmt: str = "parquet", **options: str
) -> dict:
    """Append what the day's topic holds and the checkpoint has not seen; today's without a day."""
    day = day or today(lake.spark)
    topic = day_name(day)
    stream = messages.read_stream(lake.spark, place, topic, fmt, **options)
    return ingest_available(
        stream, lake.raw_path, lake.checkpoint(day), topic, fmt=lake.raw_format, ledger=lake.ledger
    )


def clean_days(
    lake: Lake,
    days: Days,
    key: Sequence[str] = ("transaction_id",),
    rules: Sequence[Rule] = TRADE_RULES,
) -> StageCounts:
    """Raw rows of the days (None: today), filtered, one row per key, upserted into the cleaned table.

    Rows read and rows that pass are counted in the pass that writes the updates. Of tasks that
    are run again after an executor is lost, these two counts may have rows twice; the tables never do.
    """
    seen = Observation()
    passing = F.coalesce(passes(rules), F.lit(False))
    rows = lake.raw(days).observe(seen, F.count(F.lit(1)).alias("read"), F.count_if(passing).alias("kept"))
    with staged(latest_per_key(clean(rows, rules), key), "updates") as updates:
        read, kept = (observed(seen).get(c, 0) for c in ("read", "kept"))
        if not read:
            return StageCounts(0, 0, 0)
        deduplicated = updates.count()
        touched = upsert_into(lake.silver, updates, key) if deduplicated else set()
    changed = frozenset(date(*parts) for parts in touched if None not in parts)
    return StageCounts(read, kept, deduplicated, changed)


def clean_pending(
    lake: Lake, key: Sequence[str] = ("transaction_id",), rules: Sequence[Rule] = TRADE_RULES
) -> StageCounts:
    """Clean the days that batches brought since they were last cleaned, late rows of old days among them.

    The entries that are seen now are marked only after the upsert: if it breaks off, the days come again.
    """
    with staged(lake.ledger.pending(), "pending") as entries:
        days = frozenset(r.day for r in entries.select("day").distinct().collect() if r.day)
        counts = clean_days(lake, days, key, rules) if days else StageCounts(0, 0, 0)
        if not entries.isEmpty():
            lake.ledger.mark(entries)
    return counts


def run_pending(lake: Lake) -> StageCounts:
    """Clean what came, however late, and report every day that changed."""
    counts = clean_pending(lake)
    if counts.days:
        report_days(lake, counts.days)
    return counts


def silver_days(lake: Lake, days: Days) -> DataFrame:
    """Cleaned rows of the days, opening only their partitions."""
    silver = lake.silver
    dated = {p: date(*p) for p in silver.partitions() if None not in p}
    if isinstance(days, tuple):
        return silver.read([p for p, day in dated.items() if days[0] <= day <= days[1]])
    some = days if isinstance(days, frozenset) else {days or today(lake.spark)}
    return silver.read([p for p, day in dated.items() if day in some])


def report_days(
    lake: Lake,
    days: Days,
    source: DataFrame | None = None,
    mode: str = "replace_day",
    summaries: Sequence[Summary] = SUMMARIES,
) -> None:
    """Write the daily summaries from one shared scan of the cleaned (or another) table.

    `replace_day` can be repeated; `append` adds the day's rows again on every run. Rows of other
    days in `source`, and those without a time, are left out. None stands for the current date.
    """
    days = today(lake.spark) if days is None else days
    rows = silver_days(lake, days) if source is None else day_slice(source, days)
    with staged(day_totals(rows), "day-totals") as totals:

        def write(summary: Summary) -> None:
            table, report = lake.gold(summary), roll_up(totals, summary)
            if mode == "append":
                append_rows(table, report)
            else:
                replace_days(table, report, days)

        # Small independent jobs: submitted together, they share the cluster.
        with ThreadPoolExecutor(len(summaries)) as pool:
            list(pool.map(write, summaries))


def run_day(
    lake: Lake, place: str, day: date | None = None, fmt: str = "parquet"
) -> StageCounts:
    """All steps for one day (today without one); safe to run again.

    Days that an id moved away from are reported anew as well.
    """
    day = day or today(lake.spark)
    ingest_day(lake, place, day, fmt)
    counts = clean_days(lake, day)
    if counts.rows_read:
        report_days(lake, counts.days | {day})
    return counts
