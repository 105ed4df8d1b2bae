"""Packing of a raw table's finished batches into files of a set size.

Neighbouring batches of a stream and a day fill a bin up to the size; a bin is written aside and then
renamed, in one step, to a folder named after its range of batches. From then on readers leave the batches it
covers out. They go with the next packing, when no reader that began before still has them. A
packing that breaks off leaves either nothing that readers see or whole bins, and can be run again.
"""

from __future__ import annotations

from collections.abc import Mapping
from typing import NamedTuple

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradelake.schemas import DAY_PARTS, RAW
from tradelake.sources import paths
from tradelake.sources.raw import BATCH, RANGE, batch_range, covered, covered_names, leaf_of_row

TARGET_BYTES = 128 << 20
_ASIDE = "_packing"


class Bin(NamedTuple):
    """Batches of one stream and day that become one folder."""

    day: str
    stream: str
    batches: tuple[str, ...]

    @property
    def name(self) -> str:
        ranges = [batch_range(b) for b in self.batches]
        return f"{self.stream}-{ranges[0][1]:08d}{RANGE}{ranges[-1][2]:08d}"


def bins_of(
    day: str, sizes: Mapping[str, int], finished: Mapping[str, int], target: int = TARGET_BYTES
) -> list[Bin]:
    """Neighbouring finished batches, in order, as long as a bin's bytes stay within the target."""
    gone = set(covered_names(list(sizes)))
    streams: dict[str, list[tuple[int, str]]] = {}
    for name in sizes:
        known = batch_range(name)
        if known and name not in gone and known[2] <= finished.get(known[0], -1):
            streams.setdefault(known[0], []).append((known[1], name))
    out = []
    for stream, numbered in sorted(streams.items()):
        filled, size = [], 0
        for _, name in sorted(numbered):
            if filled and size + sizes[name] > target:
                out.append(Bin(day, stream, tuple(filled)))
                filled, size = [], 0
            filled.append(name)
            size += sizes[name]
        out.append(Bin(day, stream, tuple(filled)))
    return [b for b in out if len(b.batches) > 1]


def finished_batches(days: Mapping[str, Mapping[str, int]]) -> dict[str, int]:
    """The last batch of each stream that is surely whole: a batch begins when the one before it has ended."""
    last: dict[str, int] = {}
    for sizes in days.values():
        for name in sizes:
            if known := batch_range(name):
                last[known[0]] = max(last.get(known[0], -1), known[2])
    return {stream: number - 1 for stream, number in last.items()}


def pack(
    spark: SparkSession,
    path: str,
    target: int = TARGET_BYTES,
    schema: T.StructType = RAW,
    finished: Mapping[str, int] | None = None,
) -> list[Bin]:
    """Pack the raw table at `path`; gives the bins made.

    `finished` has the last whole batch number of each stream (as its checkpoint knows it); by default
    the last one that any day shows is left alone, as it may still be written.
    """
    for left in covered(spark, path, [path]):
        paths.remove(spark, left)
    for name in paths.child_names(spark, path):
        if name.startswith(_ASIDE):
            paths.remove(spark, f"{path}/{name}")

    folders = paths.glob(spark, f"{path}/{'/'.join(['*'] * len(DAY_PARTS))}/{BATCH}=*")
    days: dict[str, dict[str, int]] = {}
    for folder in folders:
        day, _, leaf = folder.rpartition("/")
        days.setdefault(day, {})[leaf.partition("=")[2]] = paths.size(spark, folder)
    done = finished_batches(days) if finished is None else finished
    bins = [b for day, sizes in sorted(days.items()) for b in bins_of(day, sizes, done, target)]
    if not bins:
        return []

    names = [(f"{b.day.removeprefix(path)}/{BATCH}={n}".strip("/"), b.name) for b in bins for n in b.batches]
    full = T.StructType([*schema.fields, T.StructField(BATCH, T.StringType())])
    members = [f"{b.day}/{BATCH}={n}" for b in bins for n in b.batches]
    rows = spark.read.schema(full).option("basePath", path).parquet(*members)
    packed = spark.createDataFrame(names, "leaf string, bin string")
    aside = f"{path}/{_ASIDE}"
    (
        rows.join(packed, leaf_of_row() == F.col("leaf"))
        .withColumn(BATCH, F.col("bin"))
        .select(full.fieldNames())
        .hint("rebalance", *DAY_PARTS, BATCH)
        .write.partitionBy(*DAY_PARTS, BATCH)
        .parquet(aside)
    )
    for b in bins:
        below = f"{b.day.removeprefix(path)}/{BATCH}={b.name}".lstrip("/")
        paths.rename(spark, f"{aside}/{below}", f"{path}/{below}")
    paths.remove(spark, aside)
    return bins
