"""Messages to raw rows, as a stream with a checkpoint."""

from __future__ import annotations

from collections import defaultdict
from threading import Event

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQueryListener, StreamingQuery

from tradelake.operators.slices import to_raw
from tradelake.schemas import DAY_PARTS, RECORD
from tradelake.session import observed
from tradelake.sources.raw import write_batch, write_batch_into
from tradelake.sources.tables import CatalogTable
from tradelake.streaming.ledger import Ledger

METRICS = "ingest"


def decode(
    messages: DataFrame, record: T.StructType = RECORD, observe: str | None = None
) -> DataFrame:
    """One row per record of each message's JSON array.

    A message that is not readable JSON gives no rows. With `observe`, a metric of that name
    counts the messages and the unreadable ones among them.
    """
    text = F.col("value").cast("string")
    parsed = messages.select(
        F.from_json(text, T.ArrayType(record)).alias("_records"), text.isNotNull().alias("_sent")
    )
    if observe:
        parsed = parsed.observe(
            observe,
            F.count_if("_sent").alias("messages"),
            F.count_if(F.col("_sent") & F.col("_records").isNull()).alias("undecodable"),
        )
    return parsed.select(F.explode("_records").alias("_record")).select("_record.*")


def start_ingest(
    messages: DataFrame,
    table: str,
    checkpoint: str,
    stream: str,
    fmt: str = "parquet",
    record: T.StructType = RECORD,
    ts: str = "timestamp",
    trigger: dict | None = None,
    ledger: Ledger | None = None,
    native: bool = False,
) -> StreamingQuery:
    """Append a message stream to the raw table, each message exactly once.

    `stream` names the topic; every topic has a checkpoint of its own and all share one table.
    Plain Parquet's own streaming sink numbers batches per table and would drop the batches of a
    second checkpoint as already written, so each batch is written to a folder named after its
    stream and number. With `fmt="table"`, `table` names a catalog table of file format that has the batch
    as its last partition column, and batches go there in the same way. With a `ledger`, each
    batch notes the days it brought.

    `native`, and any other format (`iceberg`), appends by the format's own sink to the partitioned catalog table
    called `table`, which must exist. For file formats that takes one checkpoint per table.
    """
    rows = to_raw(decode(messages, record, METRICS), ts)
    writer = rows.writeStream.outputMode("append").option("checkpointLocation", checkpoint)
    if trigger:
        writer = writer.trigger(**trigger)
    if native or fmt not in ("parquet", "table"):
        target = CatalogTable(messages.sparkSession, table)
        return writer.format(fmt).partitionBy(*target.partition_by).toTable(table)

    def write(batch: DataFrame, number: int) -> None:
        name = f"{stream}-{number:08d}"
        seen = Observation()
        days = F.collect_set(F.struct(F.make_date(*DAY_PARTS).alias("day"))).alias("days")
        put = write_batch_into if fmt == "table" else write_batch
        put(batch.observe(seen, F.count(F.lit(1)).alias("rows"), days), table, name)
        brought = observed(seen)
        if ledger and brought.get("rows"):
            ledger.add(name, sorted((d["day"] for d in brought["days"]), key=str), brought["rows"])

    return writer.foreachBatch(write).start()


def ingest_available(messages: DataFrame, table: str, checkpoint: str, stream: str, **options) -> dict:
    """Ingest everything that is there now, then stop; gives the message counts."""
    streams = messages.sparkSession.streams
    listener = _Counter()
    streams.addListener(listener)
    try:
        query = start_ingest(
            messages, table, checkpoint, stream, trigger={"availableNow": True}, **options
        )
        query.awaitTermination()
        # The end is told after all batches.
        listener.wait_for(str(query.runId))
    finally:
        streams.removeListener(listener)
    return listener.counts.get(str(query.runId), {"messages": 0, "undecodable": 0})


class _Counter(StreamingQueryListener):
    """Sums of the observed counts over all batches; a query itself remembers its last hundred."""

    def __init__(self) -> None:
        self.counts: dict[str, dict[str, int]] = {}
        self._ended: dict[str, Event] = defaultdict(Event)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        observed = event.progress.observedMetrics.get(METRICS)
        sums = self.counts.setdefault(str(event.progress.runId), {"messages": 0, "undecodable": 0})
        for name in sums:
            sums[name] += observed[name] if observed else 0

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self._ended[str(event.runId)].set()

    def wait_for(self, run: str) -> None:
        if not self._ended[run].wait(60):
            raise TimeoutError(f"no word of the end of streaming run {run}")
