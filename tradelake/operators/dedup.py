"""Latest row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tradelake.schemas import DAY_PARTS


def latest_per_key(
    df: DataFrame, key: Sequence[str] = ("transaction_id",), ts: str = "ts"
) -> DataFrame:
    """Keep the row with the latest `ts` of each key; NULL keys form one group.

    Rows that tie on `ts` are ordered by their remaining columns (the date parts follow from
    `ts`), so the choice does not depend on how rows were distributed. The planner applies the `= 1` limit before the shuffle as well
    as after it: a hot key sends one row per task. A digest of the key leads the sort, as keys often share the
    first bytes, which a sort compares by.
    """
    rest = [c for c in df.columns if c not in (*key, ts, *DAY_PARTS)]
    order = [F.col(ts).desc_nulls_last(), *(F.col(c).asc_nulls_last() for c in rest)]
    newest = Window.partitionBy("_digest", *key).orderBy(*order)
    return (
        df.withColumn("_digest", F.xxhash64(*key))
        .withColumn("_rank", F.row_number().over(newest))
        .filter(F.col("_rank") == 1)
        .drop("_digest", "_rank")
    )
