"""Global row positions, pages, and pages encoded as messages."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import date
from functools import reduce
from itertools import accumulate
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradelake.functions.calendar import message_key
from tradelake.session import stage
from tradelake.sources import paths
from tradelake.sources.day_files import MICROS
from tradelake.sources.layout import UNKNOWN_BYTES, estimated_bytes

# Fixed value: records per message.
PAGE_SIZE = 100

# Up to this many leading rows, a page is cut from a top-k; beyond it, from row positions. The
# planner applies a row-number limit before the shuffle only up to this size.
TOP_ROWS = 1_000

# Groups that the leading rows of all input partitions are first merged in.
_TOP_GROUPS = 256

# Bytes of input per range partition.
_RANGE_BYTES = 256 << 20

_POSITION_MASK = (1 << 33) - 1


def range_count(df: DataFrame) -> int:
    """Partitions for a global order: the session's shuffle setting, more for a large input."""
    configured = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    size = estimated_bytes(df)
    if size >= UNKNOWN_BYTES:
        return configured
    return max(configured, size // _RANGE_BYTES)


def _tied(df: DataFrame) -> DataFrame:
    """With the scan position, which breaks ties, so that equal rows, however many, spread over several ranges."""
    return df.withColumn("_tie", F.monotonically_increasing_id())


def _placed(tied: DataFrame, order_by: Sequence[str], count: int) -> tuple[DataFrame, str, list[int]]:
    """The rows in order, written once with their range and their place in it; each range's first position."""
    keys = [*order_by, "_tie"]
    placed, path = stage(
        tied.repartitionByRange(count, *keys)
        .sortWithinPartitions(*keys)
        .withColumn("_part", F.spark_partition_id())
        .withColumn("_place", F.monotonically_increasing_id().bitwiseAND(F.lit(_POSITION_MASK))),
        "row-index",
    )
    # One row per range, so small whatever the table's size.
    sizes = dict(placed.groupBy("_part").count().collect())
    return placed, path, list(accumulate((sizes.get(part, 0) for part in range(count)), initial=0))


def _positioned(placed: DataFrame, starts: Sequence[int], name: str) -> DataFrame:
    firsts = placed.sparkSession.createDataFrame(list(enumerate(starts[:-1])), "_part int, _first long")
    return (
        placed.join(F.broadcast(firsts), "_part")
        .withColumn(name, F.col("_first") + F.col("_place"))
        .drop("_part", "_first", "_place")
    )


def with_row_index(
    df: DataFrame, order_by: Sequence[str], name: str = "row_index", partitions: int | None = None
) -> DataFrame:
    """Add the 0-based position of each row in the given order, without gathering the rows.

    The rows are range partitioned and written once with their place inside the partition; a
    partition's first position is the sum of the sizes before it. The scan position breaks ties; it
    is stable for a table scan; stage other inputs first.
    """
    placed, _, starts = _placed(_tied(df), order_by, partitions or range_count(df))
    return _positioned(placed.drop("_tie"), starts, name)


def _keyed(df: DataFrame, order_by: Sequence[str]) -> DataFrame:
    """With each row's place in the order as one value: the order columns, then the scan position."""
    return _tied(df).withColumn("_key", F.struct(*order_by, "_tie"))


def _bounds(
    df: DataFrame, order_by: Sequence[str], wanted: Callable[[Column, int], Column]
) -> tuple[Column, int, int]:
    """Order keys of the rows at the wanted positions, as one sorted array; their number; the row count.

    `wanted` gets a position and the row count. Only the order columns are shuffled, and their copy
    is removed before this returns.
    """
    spark = df.sparkSession
    # As columns of their own they sort faster than as one value.
    keys = _tied(df).select(*order_by, "_tie")
    placed, path, starts = _placed(keys, order_by, range_count(keys))
    key = F.struct(*order_by, "_tie")
    try:
        found = (
            _positioned(placed, starts, "_position")
            .filter(wanted(F.col("_position"), starts[-1]))
            .select(key.alias("_key"))
        )
        # By Arrow, as times of a repeated hour do not survive as Python's.
        row = found.agg(F.sort_array(F.collect_list("_key")).alias("bounds")).toArrow()
    finally:
        paths.remove(spark, path)
    schema = T.StructType([T.StructField("bounds", T.ArrayType(keys.select(key).schema[0].dataType))])
    return spark.createDataFrame(row, schema).scalar(), len(row["bounds"][0]), starts[-1]


def _with_range(keyed: DataFrame, bounds: Column, count: int) -> DataFrame:
    """With `_range`, how many of the sorted bounds are not past the key, by binary search.

    A projection for each step, as these are compiled and a function over an array is not.
    """
    ranged, at = keyed.withColumn("_range", F.lit(0)), F.col("_range")
    for step in (1 << bit for bit in reversed(range(count.bit_length()))):
        # Past the last bound there is NULL, which is never reached.
        reached = F.get(bounds, at + step - 1) <= F.col("_key")
        ranged = ranged.withColumn("_range", F.when(reached, at + step).otherwise(at))
    return ranged


def page_slice(
    df: DataFrame, order_by: Sequence[str], offset: int, limit: int = PAGE_SIZE
) -> DataFrame:
    """`limit` rows from `offset` on, in order; nothing when the offset is past the end.

    Early and late pages are cut by different plans from one order, in which the scan position
    breaks ties, so that pages fit together wherever they begin. The scan position is stable for a
    table scan; stage other inputs first.
    For an early page, each group of input partitions keeps its leading rows, so the last merge
    sees a fixed number of rows and not some of every input partition. For a late one, the order
    columns alone are sorted to find the keys of its ends, and a scan filters by them.
    """
    end = offset + limit
    if end <= TOP_ROWS:
        leading = Window.partitionBy("_group").orderBy(*order_by, "_tie")
        leaders = (
            _tied(df)
            .withColumn("_group", F.spark_partition_id() % _TOP_GROUPS)
            .withColumn("_rank", F.row_number().over(leading))
            .filter(F.col("_rank") <= end)
            .drop("_group", "_rank")
        )
        return leaders.orderBy(*order_by, "_tie").offset(offset).limit(limit).drop("_tie")
    bounds, found, _ = _bounds(df, order_by, lambda position, _: position.isin(offset, end))
    if not found:
        return df.limit(0)
    keyed = _keyed(df, order_by).withColumn("_bounds", bounds)
    inside = F.col("_key") >= F.get("_bounds", F.lit(0))
    if found == 2:
        inside = inside & (F.col("_key") < F.get("_bounds", F.lit(1)))
    return keyed.filter(inside).orderBy(*order_by, "_tie").drop("_tie", "_key", "_bounds")


def page_status(df: DataFrame, offset: int, limit: int = PAGE_SIZE) -> DataFrame:
    """One row: the total row count and whether this page is the last (`complete`)."""
    done = F.lit(offset + limit) >= F.col("total_rows")
    return df.agg(F.count(F.lit(1)).alias("total_rows")).withColumn(
        "status", F.when(done, "complete").otherwise("success")
    )


def page_listing(df: DataFrame, page_size: int = PAGE_SIZE) -> DataFrame:
    """Every page a reader gets: its offset, its row count and its status."""
    total = df.count()
    # A reader of an empty table still asks for one page.
    offset = F.col("id")
    return df.sparkSession.range(0, max(total, 1), page_size).select(
        offset.alias("page_offset"),
        F.least(F.lit(page_size).cast("long"), F.lit(total) - offset).alias("page_rows"),
        F.when(offset + page_size >= total, "complete").otherwise("success").alias("status"),
    )


def record_json(
    df: DataFrame, missing: str = "omit", time_format: str = MICROS
) -> Column:
    """All columns of `df` as one JSON object.

    `missing` says how NULL and NaN are written: `omit` leaves NULLs out, `nan` writes both as
    the bare token NaN, as senders do that know only floating-point missing values.
    """
    options = {"timestampNTZFormat": time_format, "timestampFormat": time_format}
    whole = F.to_json(F.struct(*df.columns), options)
    if missing == "omit":
        return whole
    absent, fields = [], []
    for field in df.schema:
        value = F.col(field.name)
        gone = value.isNull()
        if field.dataType.typeName() in ("double", "float"):
            gone = gone | F.isnan(value)
        # A one-field object, without its braces.
        pair = F.to_json(F.struct(value), options)
        inner = F.substring(pair, F.lit(2), F.length(pair) - 2)
        fields.append(F.when(gone, F.lit(f'"{field.name}":NaN')).otherwise(inner))
        absent.append(gone)
    by_field = F.concat(F.lit("{"), F.concat_ws(",", *fields), F.lit("}"))
    return F.when(reduce(or_, absent), by_field).otherwise(whole)


def envelopes(
    df: DataFrame,
    order_by: Sequence[str],
    day: date,
    page_size: int = PAGE_SIZE,
    missing: str = "omit",
    time_format: str = MICROS,
    partitions: int | None = None,
) -> DataFrame:
    """Messages `(key, value)`: a page of records as a JSON array, keyed by day and offset.

    The order columns alone are sorted first, to find keys that cut the order into ranges of whole
    pages. The rows then move once, to their range, and no page has rows in two of them; nothing is
    left in the shared folder. The scan position breaks ties: stage an input that is no table scan.
    """
    count = partitions or range_count(df)

    def per_range(total: int) -> int:
        return max(1, -(-total // (count * page_size))) * page_size

    bounds, found, total = _bounds(
        df, order_by, lambda position, rows: (position > 0) & (position % per_range(rows) == 0)
    )
    pages = per_range(total) // page_size
    # A range is a partition of its own, so a row's place is its number there.
    place = F.monotonically_increasing_id().bitwiseAND(F.lit(_POSITION_MASK))
    ranged = (
        _with_range(_keyed(df, order_by), bounds, found)
        .drop("_key")
        .repartitionById(found + 1, "_range")
        .sortWithinPartitions(*order_by, "_tie")
    )
    return (
        ranged.select("_range", place.alias("_place"), record_json(df, missing, time_format).alias("_json"))
        .withColumn("_page", F.floor(F.col("_place") / page_size))
        .groupBy("_range", "_page")
        .agg(F.sort_array(F.collect_list(F.struct("_place", "_json"))).alias("_rows"))
        .withColumn("_page", F.col("_range").cast("long") * pages + F.col("_page"))
        .select(
            message_key(day, F.col("_page") * page_size).cast("binary").alias("key"),
            F.concat(F.lit("["), F.concat_ws(",", F.col("_rows._json")), F.lit("]"))
            .cast("binary")
            .alias("value"),
        )
    )
