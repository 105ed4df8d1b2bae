"""Nearest neighbours by cross-polytope hashing.

A vector, scaled to length one, is turned by fast pseudo-rotations (random signs and a Hadamard transform,
three times) and falls to the nearest signed axis. Each table has turns of its own. A search probes
the buckets of each table from the axis nearest to the query's on, and ranks what lies in them by the exact distance.
How many buckets it probes is fitted: a bounded sample of queries is searched in full, in one pass
over the vectors, and the probes are as many as find the asked share of their neighbours.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from tradelake.llm.scratch import Scratch

NEIGHBOURS = 10
TABLES = 4
# Share of the sample's neighbours that the probes must find.
RECALL = 0.96
# Queries that the probes are fitted on.
SAMPLE = 256
# Distinct vectors that one block of a bucket has, about.
BLOCK_VECTORS = 4096
_TURNS = 3
# Differences beyond this, or below its inverse, are scaled before they are squared.
_LARGE = 2.0**400


class Index(NamedTuple):
    """How vectors fall into buckets; all of it follows from the vectors' length and the number of axes used."""

    size: int
    padded: int
    tables: int
    hashes: int
    signs: np.ndarray

    @property
    def axes(self) -> int:
        return 2 * self.padded

    @property
    def buckets(self) -> int:
        return self.axes**self.hashes


def make_index(size: int, tables: int, hashes: int, seed: int = 0) -> Index:
    padded = 1 << max(size - 1, 1).bit_length()
    random = np.random.default_rng([seed, size, tables, hashes])
    signs = random.choice([-1.0, 1.0], (tables, hashes, _TURNS, padded))
    return Index(size, padded, tables, hashes, signs)


def _hadamard(rows: np.ndarray) -> np.ndarray:
    size, half = rows.shape[1], 1
    while half < size:
        pairs = rows.reshape(len(rows), -1, 2, half)
        rows = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], axis=2)
        rows = rows.reshape(len(rows), size)
        half *= 2
    return rows / np.sqrt(size)


def turned(vectors: np.ndarray, index: Index, table: int) -> np.ndarray:
    """(rows, hashes, axes): how near each vector of length one is to each signed axis."""
    # By the largest component first, so that squares neither overflow nor vanish.
    unit = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    unit = np.pad(unit, ((0, 0), (0, index.padded - index.size)))
    out = []
    for signs in index.signs[table]:
        rows = unit
        for s in signs:
            rows = _hadamard(rows * s)
        out.append(np.concatenate([rows, -rows], axis=1))
    return np.stack(out, axis=1)


def own_buckets(vectors: np.ndarray, index: Index, table: int) -> np.ndarray:
    nearest = turned(vectors, index, table).argmax(axis=2)
    return (nearest * index.axes ** np.arange(index.hashes)).sum(axis=1)


def closeness(vectors: np.ndarray, index: Index, table: int) -> np.ndarray:
    """(rows, buckets): the sum of how near a vector is to the axes of each bucket."""
    near = turned(vectors, index, table)
    total = near[:, 0]
    for j in range(1, index.hashes):
        total = (near[:, j, :, None] + total[:, None, :]).reshape(len(near), -1)
    return total


def distances(block: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Of all columns of `block`; squares are summed in the components' order, however many columns there are.

    Columns whose squares would overflow or vanish are scaled by a power of two first.
    """
    apart = block - query[:, None]
    most = np.abs(apart).max(axis=0, initial=0)
    odd = (most > _LARGE) | (most < 1 / _LARGE) & (most > 0)
    scale = np.ones(len(most))
    if odd.any():
        scale[odd] = np.exp2(np.floor(np.log2(most[odd])))
        apart = apart / scale
    return np.sqrt(np.add.accumulate(apart**2, axis=0)[-1]) * scale


def _matrix(column: pa.Array, size: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, size)


# -- buckets


def _place(batches: Iterator[pa.RecordBatch], index: Index) -> Iterator[pa.RecordBatch]:
    """Each distinct vector in its bucket of each table."""
    for batch in batches:
        if not batch.num_rows:
            continue
        vectors = _matrix(batch.column("vector"), index.size)
        for t in range(index.tables):
            rows = batch.num_rows
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(rows, t, np.int32)),
                    pa.array(own_buckets(vectors, index, t).astype(np.int64)),
                    batch.column("vector"),
                    batch.column("members"),
                ],
                ["t", "bucket", "vector", "members"],
            )


def _probe(batches: Iterator[pa.RecordBatch], index: Index, probes: int) -> Iterator[pa.RecordBatch]:
    """The buckets that each query looks into, in each table."""
    step = max(1, (1 << 22) // index.buckets)
    for whole in batches:
        for first in range(0, whole.num_rows, step):
            batch = whole.slice(first, step)
            rows = batch.num_rows
            vectors = _matrix(batch.column("vector"), index.size)
            for t in range(index.tables):
                near = closeness(vectors, index, t)
                at = np.argpartition(-near, probes - 1, axis=1)[:, :probes] if probes < near.shape[1] else None
                if at is None:
                    at = np.broadcast_to(np.arange(near.shape[1]), near.shape)
                take = pa.array(np.repeat(np.arange(rows), at.shape[1]))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(at.size, t, np.int32)),
                        pa.array(at.ravel().astype(np.int64)),
                        batch.column("query").take(take),
                        batch.column("vector").take(take),
                    ],
                    ["t", "bucket", "query", "vector"],
                )


def _rank(batches: Iterator[pa.RecordBatch], size: int, keep: int) -> Iterator[pa.RecordBatch]:
    """The nearest vectors of a block to each query that probes it; a block's vectors come before its queries."""
    current, block, members = None, [], []
    ready: np.ndarray | None = None
    for batch in batches:
        places = list(zip(*(batch.column(c).to_pylist() for c in ("t", "bucket", "part"))))
        queries = batch.column("query").to_pylist()
        vectors = _matrix(batch.column("vector"), size)
        own = batch.column("members").to_pylist()
        found: list[tuple[int, dict, float]] = []
        for i, place in enumerate(places):
            if place != current:
                current, block, members, ready = place, [], [], None
            if queries[i] is None:
                block.append(vectors[i])
                members.append(own[i])
                ready = None
            elif block:
                ready = np.stack(block, axis=1) if ready is None else ready
                apart = distances(ready, vectors[i])
                near = np.arange(len(apart))
                if len(near) > keep:
                    # All that tie with the last one stay; ids decide among them later.
                    last = np.partition(apart, keep - 1)[keep - 1]
                    near = np.flatnonzero(apart <= last)
                some = [(float(apart[j]), m["vec_id"], m["row"]) for j in near.tolist() for m in members[j]]
                some.sort()
                found += [(queries[i], *s) for s in some[:keep]]
        if found:
            query, score, vec, row = zip(*found)
            yield pa.RecordBatch.from_arrays(
                [pa.array(query, pa.int64()), pa.array(row, pa.int64()), pa.array(vec, pa.int64()), pa.array(score)],
                ["query", "row", "vec_id", "score"],
            )


# -- fitting


def _full_search(batches: Iterator[pa.RecordBatch], sample, size: int, keep: int) -> Iterator[pa.RecordBatch]:
    """The nearest vectors of a task to each query of the sample."""
    queries: np.ndarray = sample.value
    held, apart = np.zeros((0, size)), np.zeros((len(queries), 0))
    for batch in batches:
        if not batch.num_rows:
            continue
        vectors = _matrix(batch.column("vector"), size)
        new = np.stack([distances(vectors.T, q) for q in queries])
        held, apart = np.concatenate([held, vectors]), np.concatenate([apart, new], axis=1)
        if apart.shape[1] > keep:
            used = np.unique(np.argpartition(apart, keep - 1, axis=1)[:, :keep])
            held, apart = held[used], apart[:, used]
    offsets = pa.array(np.arange(len(held) + 1, dtype=np.int32) * size)
    yield pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(offsets, pa.array(held.ravel()))], ["vector"])


def fit_probes(
    queries: DataFrame, vectors: DataFrame, index: Index, recall: float, sample: int, neighbours: int
) -> int:
    """The least number of buckets per table by which a sample's neighbours are found.

    `vectors` has each distinct vector once. The sample is a bounded one; the search of it covers all vectors.
    """
    spark = queries.sparkSession
    picked = queries.orderBy(F.xxhash64("query"), "query").limit(sample).select("vector").collect()
    if not picked:
        return 1
    rows = np.array([r.vector for r in picked], np.float64)
    shared = spark.sparkContext.broadcast(rows)
    keep = neighbours + 1
    # Each task sends what any query of the sample may need, a bounded number of vectors; fewer and fewer
    # tasks go on with them, so that the driver gets what a few have.
    nearest = partial(_full_search, sample=shared, size=index.size, keep=keep)
    near = vectors.select(F.col("vector").cast("array<double>").alias("vector"))
    near = near.mapInArrow(nearest, "vector array<double>")
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    while tasks > 4:
        tasks = -(-tasks // 8)
        near = near.repartition(tasks).mapInArrow(nearest, "vector array<double>")
    held = np.array([r.vector for r in near.collect()], np.float64).reshape(-1, index.size)
    shared.unpersist()
    apart = np.stack([distances(held.T, q) for q in rows])
    apart[apart == 0] = np.inf
    best = np.argsort(apart, axis=1)[:, : min(neighbours, apart.shape[1])]
    known = np.isfinite(np.take_along_axis(apart, best, axis=1))
    if not known.any():
        return 1
    ranks = []
    for t in range(index.tables):
        near_axes = closeness(rows, index, t)
        at = own_buckets(held, index, t)[best]
        value = np.take_along_axis(near_axes, at, axis=1)
        above = [(near_axes[i][None, :] > value[i][:, None]).sum(axis=1) for i in range(len(rows))]
        ranks.append(np.stack(above))
    least = np.sort(np.min(ranks, axis=0)[known])
    return int(least[max(0, int(np.ceil(recall * len(least))) - 1)]) + 1


# -- the operator


def nearest_neighbours(
    rows: DataFrame,
    is_query,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    neighbours: int = NEIGHBOURS,
    tables: int = TABLES,
    recall: float = RECALL,
    sample: int = SAMPLE,
    hashes: int | None = None,
) -> DataFrame:
    """For each row with `is_query`, the nearest rows other than itself by Euclidean distance, as far as found.

    Returns `query_id`, `rank` from 1, `vec_id` and `score`: the distance of the
    vectors as they are, in double precision; ties go to the smaller id. A query gets `neighbours` rows, or all
    others if there are fewer: where the probed buckets have too few, it looks into all of them.

    Equal vectors are one in the index, with as many members as any answer can have. A bucket with many vectors
    is dealt to blocks, each ranked by itself. `hashes` axes make a bucket; by default as many, up to two, as
    leave about `BLOCK_VECTORS` vectors in one.

    Vectors that are null, zero, or hold null or non-finite components take no part, nor rows without
    id, nor vectors of another length than most have. Rows that repeat an id are different rows; an equal row is
    a neighbour at distance 0. An empty table gives no rows. Other columns don't matter.
    """
    spark = rows.sparkSession
    scratch = Scratch(spark, "neighbours")
    given = F.col(f"`{vector_column}`")
    infinite = F.lit(float("inf"))
    fine = F.forall(given, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != infinite))
    usable = (
        rows.filter(F.col(f"`{id_column}`").isNotNull() & given.isNotNull())
        .filter(fine & F.exists(given, lambda x: x != 0))
        .select(
            F.monotonically_increasing_id().alias("row"),
            F.col(f"`{id_column}`").cast("long").alias("vec_id"),
            given.alias("vector"),
            F.coalesce(is_query, F.lit(False)).alias("asks"),
        )
    )
    usable = scratch.keep(usable, "rows")
    sizes = usable.groupBy(F.size("vector").alias("size")).count().orderBy(F.desc("count"), "size").first()
    answer = "query_id long, rank int, vec_id long, score double"
    if sizes is None:
        return spark.createDataFrame([], answer)
    usable = usable.filter(F.size("vector") == sizes["size"])
    # Of equal vectors no answer has more than the first ones by id, and its own.
    nth = F.row_number().over(Window.partitionBy("vector").orderBy("vec_id", "row"))
    distinct = scratch.keep(
        usable.select("row", "vec_id", "vector")
        .withColumn("nth", nth)
        .filter(F.col("nth") <= neighbours + 1)
        .groupBy("vector")
        .agg(F.collect_list(F.struct("vec_id", "row")).alias("members")),
        "vectors",
    )
    count = distinct.count()
    if hashes is None:
        hashes = 1 if count <= BLOCK_VECTORS * 2 * make_index(sizes["size"], 1, 1).padded else 2
    index = make_index(sizes["size"], tables, hashes)
    queries = scratch.keep(
        usable.filter("asks").select(F.col("row").alias("query"), F.col("vec_id").alias("query_id"), "vector"),
        "queries",
    )
    probes = fit_probes(queries, distinct, index, recall, sample, neighbours)

    kind = usable.schema["vector"].dataType.simpleString()
    member = "members array<struct<vec_id:long,row:long>>"
    placed = scratch.keep(
        distinct.mapInArrow(partial(_place, index=index), f"t int, bucket long, vector {kind}, {member}"), "placed"
    )
    parts = placed.groupBy("t", "bucket").agg(F.ceil(F.count("*") / BLOCK_VECTORS).cast("int").alias("parts"))
    parts = scratch.keep(parts, "parts")

    def search(asked: DataFrame, probes: int) -> DataFrame:
        probed = asked.select("query", "vector").mapInArrow(
            partial(_probe, index=index, probes=min(probes, index.buckets)),
            f"t int, bucket long, query long, vector {kind}",
        )
        # A part of a bucket has its vectors, and all queries that probe the bucket.
        left = placed.join(parts, ["t", "bucket"]).select(
            "t",
            "bucket",
            F.pmod(F.xxhash64("vector"), F.col("parts")).cast("int").alias("part"),
            F.lit(None).cast("long").alias("query"),
            "vector",
            "members",
        )
        right = probed.join(parts, ["t", "bucket"]).select(
            "t",
            "bucket",
            F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"),
            "query",
            "vector",
            F.lit(None).cast(placed.schema["members"].dataType).alias("members"),
        )
        tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
        ranked = (
            left.union(right)
            .repartition(tasks, "t", "bucket", "part")
            .sortWithinPartitions("t", "bucket", "part", F.col("query").asc_nulls_first())
            .mapInArrow(
                # One more, as a query finds itself.
                partial(_rank, size=index.size, keep=neighbours + 1),
                "query long, row long, vec_id long, score double",
            )
        )
        best = ranked.filter("row != query").distinct()
        nearest = Window.partitionBy("query").orderBy("score", "vec_id", "row")
        return best.withColumn("rank", F.row_number().over(nearest)).filter(F.col("rank") <= neighbours)

    found = scratch.keep(search(queries, probes), "found")
    full = found.groupBy("query").agg(F.count("*").alias("n")).filter(F.col("n") >= neighbours).select("query")
    short = queries.join(full, "query", "left_anti")
    if probes < index.buckets and count > 1 and not short.isEmpty():
        again = scratch.keep(search(short, index.buckets), "found")
        found = found.join(short.select("query"), "query", "left_anti").unionByName(again)
    names = queries.select("query", "query_id")
    return found.join(names, "query").select("query_id", "rank", "vec_id", "score")
