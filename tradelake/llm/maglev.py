"""Placement of keys on shards through a permutation-filled lookup table.

Every shard has a preference order of the table's slots, an arithmetic progression modulo the
prime size. Shards take turns claiming their best free slot until none is free, so shares
differ by one slot at most (in proportion to weights), and losing a shard moves few other keys.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from hashlib import blake2b

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Prime, and over a hundred slots for each of up to 655 shards. The table has as many rows.
TABLE_SIZE = 65_537


def _number(name: str, salt: str, size: int) -> int:
    return int.from_bytes(blake2b(f"{salt}:{name}".encode(), digest_size=8).digest(), "big") % size


def lookup_table(
    shards: Sequence[str] | Mapping[str, int], size: int = TABLE_SIZE
) -> list[str]:
    """The shard of every slot. A mapping gives weights: turns per round, at least 1 each."""
    weights = dict(shards) if isinstance(shards, Mapping) else dict.fromkeys(shards, 1)
    names = sorted(weights)
    if not names or len(names) > size or min(weights.values()) < 1:
        raise ValueError("there must be 1 to `size` shards, of weight 1 or more")
    if any(size % d == 0 for d in range(2, int(size**0.5) + 1)) or size < 2:
        raise ValueError("the table size must be prime")
    at = [_number(name, "offset", size) for name in names]
    skip = [_number(name, "skip", size - 1) + 1 for name in names]
    table: list[str | None] = [None] * size
    free = size
    while True:
        for i, name in enumerate(names):
            for _ in range(weights[name]):
                while table[at[i]] is not None:
                    at[i] = (at[i] + skip[i]) % size
                table[at[i]] = name
                free -= 1
                if not free:
                    return table


def place(
    rows: DataFrame,
    shards: Sequence[str] | Mapping[str, int],
    key_columns: Sequence[str] = ("doc_id",),
    size: int = TABLE_SIZE,
    slot: str = "slot",
    shard: str = "shard",
) -> DataFrame:
    """Add the slot and the shard of every row's key; existing columns of these names give way.

    The table of `size` rows is broadcast: its size depends on nothing in the data. Equal keys go to
    one shard; a null key column counts as a value of its own. An empty table stays empty.
    """
    spark = rows.sparkSession
    table = spark.createDataFrame(
        list(enumerate(lookup_table(shards, size))), "_slot int, _shard string"
    )
    keys = [F.col(f"`{c}`") for c in key_columns]
    # A hash leaves null keys out, so each column also says whether it is null.
    code = F.xxhash64(*keys, *(k.isNull() for k in keys))
    kept = [F.col(f"`{c}`") for c in rows.columns if c not in (slot, shard)]
    placed = rows.select(*kept, F.pmod(code, F.lit(size)).cast("int").alias("_place"))
    placed = placed.join(F.broadcast(table), placed["_place"] == table["_slot"])
    names = [F.col(f"`{c}`") for c in rows.columns if c not in (slot, shard)]
    return placed.select(*names, F.col("_slot").alias(slot), F.col("_shard").alias(shard))
