"""Near-duplicate documents by SuperMinHash signatures, banding, verification and union-find.

SuperMinHash lets every shingle visit the signature's slots in an order of its own, with rank plus
a random fraction as its value in each; a slot keeps its least value. As one shingle's ranks
are all different, slots of a signature depend on each other in a way that lowers the variance, and
the visits of a text stop at the first rank by which all slots are taken. Here all
shingles of a slice of texts advance rank by rank together. The orders are affine
permutations of a prime number of slots.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradelake.llm import textbytes as tb
from tradelake.llm.components import components, join_components
from tradelake.llm.scratch import Scratch

# 42 bands of 6 independent slots miss a pair of similarity 0.8 three times in a million.
SLOTS = 257
BANDS = 42
BAND_ROWS = 6
# The slots of each band in turn, dealt out: a shingle visits slots at even steps, and in plain order
# one that is not shared could meet every band of a tiny set.
DEALT = np.argsort(tb.mix(np.arange(SLOTS, dtype=np.uint64)), kind="stable")[: BANDS * BAND_ROWS]

# One bit of each of 252 slots, packed; the share of equal bits is (1 + similarity) / 2.
_SKETCH = 4
_SKETCH_BITS = BANDS * BAND_ROWS
# Pairs whose sketch says less than this below the threshold are not verified (over 5 deviations).
_SKETCH_MARGIN = 0.2

# Node numbers (8 bytes each, some 64 MB as a hash table) that are sent to all tasks.
BROADCAST_NODES = 1 << 21

_FREE = np.uint64(np.iinfo(np.uint64).max)


def shingles(
    data: np.ndarray, offsets: np.ndarray, size: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Shingle hashes in row order, and the begin of each row's part; a text of fewer words is one."""
    low = tb.lower_ascii(data)
    begin, end = tb.blank_words(low, offsets)
    words = tb.hash_spans(low, begin, end)
    row = tb.rows_of(begin, offsets)
    rows = len(offsets) - 1
    count = np.bincount(row, minlength=rows)
    first = np.cumsum(count) - count
    full = max(len(words) - size + 1, 0)
    values = words[:full]
    for j in range(1, size):
        values = tb.chain(values, words[j : full + j])
    inside = row[:full] == row[size - 1 : full + size - 1]
    values, owner = values[inside], row[:full][inside]
    short = []
    for n in range(1, size):
        few = np.flatnonzero(count == n)
        whole = words[first[few]]
        for j in range(1, n):
            whole = tb.chain(whole, words[first[few] + j])
        short.append((whole, few))
    if any(len(few) for _, few in short):
        values = np.concatenate([values, *(v for v, _ in short)])
        owner = np.concatenate([owner, *(few for _, few in short)])
        order = np.argsort(owner, kind="stable")
        values, owner = values[order], owner[order]
    return values, owner, np.searchsorted(owner, np.arange(rows + 1))


def super_minhash(values: np.ndarray, owner: np.ndarray, rows: int, slots: int) -> np.ndarray:
    """(rows, slots) signatures: rank in the upper half, fraction in the lower; free if no shingle."""
    table = np.full(rows * slots, _FREE, np.uint64)
    stride = (1 + tb.mix(values ^ np.uint64(0xA5A5A5A5)) % np.uint64(slots - 1)).astype(np.int64)
    slot = (tb.mix(values ^ np.uint64(0x5A5A5A5A)) % np.uint64(slots)).astype(np.int64)
    seed, base = values, owner * slots
    open_rows = np.unique(owner)
    for rank in range(slots):
        seed = seed + np.uint64(0x9E3779B97F4A7C15)
        value = (tb.mix(seed) >> np.uint64(32)) | (np.uint64(rank) << np.uint64(32))
        np.minimum.at(table, base + slot, value)
        waiting = (table.reshape(rows, slots)[open_rows] == _FREE).any(axis=1)
        if not waiting.all():
            open_rows = open_rows[waiting]
            if not len(open_rows):
                break
            is_open = np.zeros(rows, bool)
            is_open[open_rows] = True
            stay = is_open[base // slots]
            seed, base, slot, stride = seed[stay], base[stay], slot[stay], stride[stay]
        slot = slot + stride
        slot[slot >= slots] -= slots
    return table.reshape(rows, slots)


def _sets(data: np.ndarray, offsets: np.ndarray, size: int) -> list[np.ndarray]:
    """Distinct shingle hashes of each text, in order."""
    values, _, at = shingles(data, offsets, size)
    return [np.unique(values[at[i] : at[i + 1]]) for i in range(len(at) - 1)]


def _digest(items: np.ndarray) -> bytes | None:
    from hashlib import blake2b

    return blake2b(items.tobytes(), digest_size=16).digest() if len(items) else None


def _sign(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first, last, data, offsets in tb.text_slices(batch.column("text")):
            sets = _sets(data, offsets, size)
            rows, count = len(sets), np.array([len(s) for s in sets])
            flat = np.concatenate(sets)
            table = super_minhash(flat, np.repeat(np.arange(rows), count), rows, SLOTS)
            table = table[:, DEALT]
            grouped = table.reshape(rows, BANDS, BAND_ROWS)
            bands = np.broadcast_to(np.arange(BANDS, dtype=np.uint64), (rows, BANDS))
            for j in range(BAND_ROWS):
                bands = tb.chain(bands, grouped[:, :, j])
            bits = np.zeros((rows, 64 * _SKETCH), np.uint8)
            bits[:, :_SKETCH_BITS] = (tb.mix(table) & np.uint64(1)).astype(np.uint8)
            sketch = np.packbits(bits, axis=1).view(np.int64)
            filled = count > 0
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("row").slice(first, rows),
                    batch.column("id").slice(first, rows),
                    pa.array(count.astype(np.int64)),
                    pa.array([_digest(s) for s in sets], pa.binary()),
                    *(pa.array(np.ascontiguousarray(sketch[:, j])) for j in range(_SKETCH)),
                    tb.ragged(tb.signed(bands[filled].ravel()), filled * BANDS, pa.int64()),
                ],
                ["row", "id", "n", "digest", *(f"s{j}" for j in range(_SKETCH)), "bands"],
            )


def _list_sets(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first, last, data, offsets in tb.text_slices(batch.column("text")):
            sets = _sets(data, offsets, size)
            count = np.array([len(s) for s in sets])
            flat = tb.ragged(tb.signed(np.concatenate(sets)), count, pa.int64())
            ids = batch.column("id").slice(first, last - first)
            yield pa.RecordBatch.from_arrays([ids, flat], ["node", "items"])


class _Matcher:
    """Turns candidate pairs into links confirmed on the full shingle sets."""

    def __init__(self, rows: DataFrame, nodes: DataFrame, size: int, percent: int, scratch: Scratch):
        self.rows, self.nodes = rows, nodes
        self.size, self.percent, self.scratch = size, percent, scratch
        self.tested: list[DataFrame] = []

    def links(self, pairs: DataFrame) -> DataFrame:
        """Confirmed pairs among `pairs` (`a`, `b`); pairs of an earlier call are not tried again."""
        near = self._plausible(pairs.distinct())
        for old in self.tested:
            near = near.join(old, ["a", "b"], "left_anti")
        near = self.scratch.keep(near, "plausible")
        self.tested.append(near)
        ends, ends_path = self.scratch.table(
            near.select(F.explode(F.array("a", "b")).alias("node")).distinct(), "ends"
        )
        sets, path = self.scratch.table(self.sets(ends), "sets")
        self.scratch.drop(ends_path)
        left = sets.select(F.col("node").alias("a"), F.col("items").alias("x"))
        right = sets.select(F.col("node").alias("b"), F.col("items").alias("y"))
        shared = F.size(F.array_intersect("x", "y"))
        links = (
            near.join(right, "b")
            .join(left, "a")
            .select("a", "b", shared.alias("shared"), (F.size("x") + F.size("y")).alias("total"))
            .filter(100 * F.col("shared") >= self.percent * (F.col("total") - F.col("shared")))
            .select("a", "b")
            .distinct()
        )
        links = self.scratch.keep(links, "links")
        self.scratch.drop(path)
        return links

    def sets(self, nodes: DataFrame) -> DataFrame:
        """The full shingle set (`items`) of each of some distinct nodes (`node`).

        As long as the nodes' numbers are few enough, they go to the texts; else both are shuffled.
        """
        kind = self.rows.schema["id"].dataType.simpleString()
        if nodes.count() <= BROADCAST_NODES:
            nodes = F.broadcast(nodes)
        texts = self.rows.join(nodes, self.rows["id"] == nodes["node"]).drop("node")
        return texts.mapInArrow(
            partial(_list_sets, size=self.size), f"node {kind}, items array<long>"
        ).filter(F.size("items") > 0)

    def _plausible(self, pairs: DataFrame) -> DataFrame:
        """Pairs whose set sizes allow the similarity and whose sketches don't rule it out."""
        names = ["n", *(f"s{j}" for j in range(_SKETCH))]
        for end in ("a", "b"):
            side = self.nodes.select(
                F.col("node").alias(end), *(F.col(n).alias(f"{end}_{n}") for n in names)
            )
            pairs = pairs.join(side, end)
        apart = sum(
            F.bit_count(F.col(f"a_s{j}").bitwiseXOR(F.col(f"b_s{j}"))) for j in range(_SKETCH)
        )
        least = self.percent / 100 - _SKETCH_MARGIN
        low, high = F.least("a_n", "b_n"), F.greatest("a_n", "b_n")
        return (
            pairs.filter(100 * low >= self.percent * high)
            .filter(apart <= _SKETCH_BITS * (1 - least) / 2)
            .select("a", "b")
            .distinct()
        )


def near_duplicates(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    shingle: int = 5,
    percent: int = 80,
) -> DataFrame:
    """Group documents linked by a Jaccard similarity of `percent` or more.

    Shingles are `shingle` consecutive words (ASCII white space apart, A-Z lower-cased); a text
    of fewer words is one shingle. Returns a row per input row: `id`, `n_shingles` (distinct),
    `component_id` (the least id that links lead to) and `kept` (id = component_id).

    Equal sets are one node, whatever the number of copies. In each bucket of a band all nodes
    are compared with its least one; then, in buckets that still hold several
    components, one of each component is compared with one of them. What still is apart is
    joined by its rarest shingles, which finds all similar pairs there without pairing whole
    buckets. Nodes of one component are never paired again, so a large group costs a pair or two
    per member.

    Null, empty and blank texts have no shingles, link with nothing and are kept. Rows with a
    null id link like all others and take their group's component, but lead only a group in which
    no row has an id: its component is null, and one of its rows is kept. Rows that repeat an id
    each get a result by their own texts. An empty table gives no rows.
    """
    _, groups, drop_rows = _group(docs, id_column, text_column, shingle, percent)
    drop_rows()
    return groups.select("id", "n_shingles", "component_id", "kept")


def leading_rows(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    shingle: int = 5,
    percent: int = 80,
) -> DataFrame:
    """The rows of `docs` that lead their group, one of each: a row with its least id, if any has one.

    Rows without shingles all stay. Rows are told apart as such, whatever their ids.
    """
    rows, groups, _ = _group(docs, id_column, text_column, shingle, percent)
    stay = rows.join(groups.filter("leads").select("row"), "row", "left_semi")
    return stay.select(
        [F.col("text" if c == text_column else f"own.`{c}`").alias(c) for c in docs.columns]
    )


def _group(
    docs: DataFrame, id_column: str, text_column: str, shingle: int, percent: int
) -> tuple[DataFrame, DataFrame, Callable[[], None]]:
    """All rows with a number each (`row`, `id`, `text`, `own`), the group of each number, and how to remove the rows."""
    scratch = Scratch(docs.sparkSession, "near-dup")
    # What only the search for links reads goes as soon as the groups are known.
    work = Scratch(docs.sparkSession, "near-dup-links")
    others = [F.col(f"`{c}`") for c in docs.columns if c != text_column]
    # Written once, so that a row's number stays; the least of equal sets' is their node.
    rows, rows_path = scratch.table(
        docs.select(
            F.monotonically_increasing_id().alias("row"),
            F.col(f"`{id_column}`").alias("id"),
            F.col(f"`{text_column}`").alias("text"),
            F.struct(*others).alias("own"),
        ),
        "rows",
    )
    texts = rows.withColumn("text", F.coalesce(F.col("text").cast("string"), F.lit("")))
    kind = rows.schema["id"].dataType.simpleString()
    sketch = ", ".join(f"s{j} long" for j in range(_SKETCH))
    signed = scratch.keep(
        texts.select("row", "id", "text").mapInArrow(
            partial(_sign, size=shingle),
            f"row long, id {kind}, n long, digest binary, {sketch}, bands array<long>",
        ),
        "signed",
    )
    lead = F.struct(F.col("id").isNull().alias("unknown"), "id", "row")
    classes = scratch.keep(
        signed.filter("digest is not null")
        .groupBy("digest")
        .agg(F.min("row").alias("node"), F.min(lead).alias("lead")),
        "classes",
    )
    nodes = work.keep(
        signed.drop("id", "digest")
        .withColumnRenamed("row", "node")
        .join(classes.select("node"), "node", "left_semi"),
        "nodes",
    )

    banded = nodes.select("node", F.explode("bands").alias("bucket"))
    shared = work.keep(
        banded.groupBy("bucket")
        .agg(F.min("node").alias("hub"), F.max("node").alias("top"))
        .filter("hub < top")
        .drop("top"),
        "buckets",
    )
    busy = work.keep(banded.join(shared, "bucket"), "busy")

    matcher = _Matcher(texts.select(F.col("row").alias("id"), "text"), nodes, shingle, percent, work)
    labels = components(matcher.links(_pair("hub", "node", busy)), work)
    for pairs in (_leaders, _across):
        mixed = work.keep(_open(busy.select("bucket", "node"), labels), "open")
        if mixed.isEmpty():
            break
        labels = join_components(labels, matcher.links(pairs(mixed, matcher)), work)

    labels = scratch.keep(labels, "labels")
    work.drop()

    # A group goes by its least id, and by a row number only while groups are formed.
    placed = classes.join(labels, "node", "left").withColumn(
        "component", F.coalesce("component", "node")
    )
    leads = placed.groupBy("component").agg(F.min("lead").alias("lead"))
    names = placed.select("digest", "component").join(leads, "component").select("digest", "lead")
    found = signed.select("row", "id", "n", "digest").join(names, "digest", "left")
    alone = F.col("lead").isNull()
    leader = alone | (F.col("row") == F.col("lead.row"))
    same = F.coalesce(F.col("id") == F.col("lead.id"), F.lit(False))
    groups = found.select(
        "row",
        "id",
        F.col("n").alias("n_shingles"),
        F.when(alone, F.col("id")).otherwise(F.col("lead.id")).alias("component_id"),
        F.coalesce(leader | same, F.lit(False)).alias("kept"),
        leader.alias("leads"),
    )
    return rows, groups, partial(scratch.drop, rows_path)


def _pair(x: str, y: str, rows: DataFrame) -> DataFrame:
    pairs = rows.filter(F.col(x) != F.col(y))
    return pairs.select(F.least(x, y).alias("a"), F.greatest(x, y).alias("b"))


def _open(busy: DataFrame, labels: DataFrame) -> DataFrame:
    """Members of the buckets that hold nodes of more than one component."""
    placed = busy.join(labels, "node", "left").withColumn(
        "component", F.coalesce("component", "node")
    )
    several = (
        placed.groupBy("bucket")
        .agg(F.min("component").alias("low"), F.max("component").alias("high"))
        .filter("low < high")
        .select("bucket")
    )
    return placed.join(several, "bucket")


def _leaders(mixed: DataFrame, matcher: _Matcher) -> DataFrame:
    """One node of each component in a bucket, with that of one component."""
    leads = mixed.groupBy("bucket", "component").agg(F.max("node").alias("node"))
    hubs = leads.groupBy("bucket").agg(F.max("node").alias("hub"))
    return _pair("hub", "node", leads.join(hubs, "bucket"))


def _across(mixed: DataFrame, matcher: _Matcher) -> DataFrame:
    """Pairs of different components that may be similar enough, by their rarest shingles.

    Two sets as similar as asked share one of the rarest items of each, in a common order of all
    items; how many of the rarest follows from the size. Where the first shared item stands in
    both bounds what they can share in all, so that common items bring few pairs.
    """
    percent, keep = matcher.percent, matcher.scratch.keep
    place = keep(mixed.select("node", "component").distinct(), "place")
    sets = keep(matcher.sets(place.select("node")), "open-sets")
    flat = sets.select("node", F.size("items").alias("n"), F.explode("items").alias("item"))
    several = flat.groupBy("item").agg(F.count("*").alias("used")).filter("used > 1")
    ordered = F.sort_array(F.collect_list(F.struct(F.coalesce("used", F.lit(1)), "item")))
    rarest = F.expr(f"n - cast((n * {percent} + 99) div 100 as int) + 1")
    heads = (
        flat.join(several, "item", "left")
        .groupBy("node", "n")
        .agg(ordered.alias("items"))
        .select("node", "n", F.posexplode(F.slice("items", F.lit(1), rarest)).alias("at", "one"))
        .filter("one.col1 > 1")
        .select("node", "n", "at", "one.item")
    )
    heads = keep(heads.join(place, "node"), "heads")
    other = heads.select("item", *(F.col(c).alias(f"o_{c}") for c in ("node", "n", "at", "component")))
    most = F.least(F.col("n") - F.col("at"), F.col("o_n") - F.col("o_at"))
    both = heads.join(other, "item").filter(
        (F.col("component") < F.col("o_component"))
        & (most * (100 + percent) >= percent * (F.col("n") + F.col("o_n")))
    )
    return _pair("o_node", "node", both)
