"""An ingest that goes on: started, told to stop by a file, and started again where it stopped."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tradelake.sources import paths
from tradelake.streaming.ingest import METRICS, start_ingest

PROGRESS = T.StructType(
    [
        T.StructField("run", T.StringType()),
        T.StructField("batch", T.LongType()),
        T.StructField("started", T.StringType()),
        T.StructField("input_rows", T.LongType()),
        T.StructField("messages", T.LongType()),
        T.StructField("undecodable", T.LongType()),
    ]
)


class IngestService:
    """A message stream into the raw table, batch after batch at a processing-time trigger.

    `request_stop` makes a file that every process sharing the store can make; `run` ends at the end of the
    batch that is under way. Progress is kept as a table, a row for each batch that had data.
    """

    def __init__(
        self,
        messages: DataFrame,
        table: str,
        checkpoint: str,
        stream: str,
        every: str = "10 seconds",
        look: float = 1.0,
        **options,
    ):
        self.spark: SparkSession = messages.sparkSession
        self.checkpoint, self.look = checkpoint, look
        self.query: StreamingQuery = start_ingest(
            messages, table, checkpoint, stream, trigger={"processingTime": every}, **options
        )
        self._told = -1

    @staticmethod
    def stop_file(checkpoint: str) -> str:
        return f"{checkpoint}-stop"

    @staticmethod
    def progress_path(checkpoint: str) -> str:
        return f"{checkpoint}-progress"

    @classmethod
    def request_stop(cls, spark: SparkSession, checkpoint: str) -> None:
        paths.make_dir(spark, cls.stop_file(checkpoint))

    @classmethod
    def progress(cls, spark: SparkSession, checkpoint: str) -> DataFrame:
        return spark.read.schema(PROGRESS).parquet(cls.progress_path(checkpoint))

    def run(self) -> None:
        """Stay until told to stop; raises what the stream raises. The request is taken away at the end."""
        stop = self.stop_file(self.checkpoint)
        try:
            while not self.query.awaitTermination(self.look):
                self.keep_progress()
                if paths.exists(self.spark, stop):
                    self.finish()
                    return
        finally:
            paths.remove(self.spark, stop)

    def finish(self) -> None:
        """Let the batch under way end, then stop."""
        while self.query.isActive and self.query.status["isTriggerActive"]:
            time.sleep(min(self.look, 0.2))
        self.query.stop()
        self.keep_progress()

    def keep_progress(self) -> None:
        """Append the batches not yet noted. A query remembers its last hundred, so look often enough."""
        rows = []
        for p in self.query.recentProgress:
            if p["batchId"] > self._told and p["numInputRows"] > 0:
                observed = p["observedMetrics"].get(METRICS)
                counts = (observed["messages"], observed["undecodable"]) if observed else (None, None)
                rows.append((str(p["runId"]), p["batchId"], p["timestamp"], p["numInputRows"], *counts))
        if rows:
            self._told = rows[-1][1]
            noted = self.spark.createDataFrame(rows, PROGRESS).coalesce(1)
            noted.write.mode("append").parquet(self.progress_path(self.checkpoint))
