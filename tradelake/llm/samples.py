"""Bounded samples of labelled rows, and the fold that is held out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FOLDS = 5


def held_out(id_column: Column) -> Column:
    """Whether a row's label must not be learned from: crc32 of its id as text, modulo 5, is 0."""
    return F.coalesce(F.crc32(id_column.cast("string")) % FOLDS == 0, F.lit(False))


def labelled_ids(labels: DataFrame, id_column: str, label_column: str, per_class: int) -> DataFrame:
    """(`id`, `label`): up to `per_class` ids of each class outside the held-out fold, by hash order.

    An id with both labels, a null label or a null id is left out.
    """
    rows = (
        labels.select(F.col(f"`{id_column}`").alias("id"), F.col(f"`{label_column}`").alias("label"))
        .filter("id is not null and label in (0, 1)")
        .filter(~held_out(F.col("id")))
        .groupBy("id")
        .agg(F.min("label").alias("label"), F.max("label").alias("_high"))
        .filter("label = _high")
        .drop("_high")
    )
    order = [F.xxhash64("id"), F.col("id")]
    parts = [rows.filter(F.col("label") == k).orderBy(*order).limit(per_class) for k in (0, 1)]
    return parts[0].union(parts[1])
