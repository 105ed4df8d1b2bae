"""How rows are gathered for a partitioned write."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

# Up to this estimated size, all of it fits one task, so one partition may hold any share of it.
SMALL_WRITE_BYTES = 1 << 30

# The planner's placeholder for rows of unknown size is eight exabytes, less for some columns.
UNKNOWN_BYTES = 1 << 60


def estimated_bytes(df: DataFrame) -> int:
    """The planner's size estimate: file sizes at the scans, never too small for our plans."""
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def by_partition(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Bring the rows of a table partition together, to write few files per partition.

    Rebalancing makes files of the advisory size and splits a hot partition over many tasks, but
    packs many tiny partitions into one task. A small write is spread over a fixed number of
    tasks instead, as opening its many files is then the longer part of the work.
    """
    if estimated_bytes(df) <= SMALL_WRITE_BYTES:
        tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        return df.repartition(tasks, *columns)
    return df.hint("rebalance", *columns)
