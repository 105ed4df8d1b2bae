"""Keyed upsert: matched rows are replaced, the others inserted."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradelake.sources.keys import KeyIndex
from tradelake.sources.tables import CatalogTable, Partition, PartitionedTable


def upsert(target: DataFrame, updates: DataFrame, key: Sequence[str]) -> DataFrame:
    """`target` without the rows whose key is in `updates`, plus `updates`.

    `updates` must have one row per key, and is read twice: stage it if it is costly. `target` is read
    once. A NULL key matches nothing, so its rows only pass through the join; where that shuffles, a
    digest of the whole row and its partition spreads them, however many there are.
    """
    has_null = reduce(or_, (F.col(c).isNull() for c in key))
    # A constant for the other rows would be folded out of the join's keys.
    spread, digest = F.xxhash64(F.spark_partition_id(), *target.columns), F.xxhash64(*key)
    spreading = target.withColumn("_spread", F.when(has_null, spread).otherwise(digest))
    keys = updates.select(*key, digest.alias("_spread"))
    unmatched = spreading.join(keys, ["_spread", *key], "left_anti").select(target.columns)
    return unmatched.unionByName(updates.select(target.columns))


def upsert_into(
    table: PartitionedTable, updates: DataFrame, key: Sequence[str]
) -> set[Partition]:
    """Upsert into a table; gives the partitions that change, no other is opened or rewritten.

    `updates` is used several times and should be a staged table. A key that does not include the
    partition columns can sit in any partition: the table's key index finds which ones. Such a table is
    written by upserts only; after any other write, rebuild its index. Where the catalog has row-level
    operations, the table's own MERGE does the same in one commit.
    """
    touched = table.distinct_partitions(updates)
    index = None if set(table.partition_by) <= set(key) else KeyIndex(table, key)
    if index:
        touched |= index.partitions(updates, touched)
        index.add(updates)
    if isinstance(table, CatalogTable) and table.row_level:
        merge_into_table(updates, table.name, key)
    else:
        table.replace_partitions(upsert(table.read(touched), updates, key), touched)
    return touched


def merge_into_table(updates: DataFrame, table: str, key: Sequence[str]) -> None:
    """The same upsert as a native MERGE, for catalogs with row-level operations."""
    matches = reduce(and_, (F.col(f"{table}.{c}") == F.col(f"u.{c}") for c in key))
    merge = updates.alias("u").mergeInto(table, matches)
    merge.whenMatched().updateAll().whenNotMatched().insertAll().merge()
