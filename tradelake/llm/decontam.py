"""Benchmark decontamination with a distributed positional inverted index.

The index is dealt by document, as search engines do it: a segment covers some megabytes of texts
and has, for each term, its postings (document, word position) in order. Queries go to every
segment; nothing is shuffled. A query is a window of consecutive words of a benchmark item. Its
terms' lists are taken from the shortest to the longest, shifted by the term's offset in the
window and intersected, so that most windows end at their rarest term.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradelake.llm import textbytes as tb
from tradelake.llm.scratch import Scratch

WINDOW = 10
SLOP = 20
SEGMENT_BYTES = 2 << 20
# Text bytes of the benchmark items that are searched for, and broadcast, at once.
BLOCK_BYTES = 32 << 20

_WORD = np.zeros(256, bool)
_WORD[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
_ROW = 32


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each word, and the row it is in; A-Z count as a-z, other ASCII marks split."""
    low = tb.lower_ascii(data)
    begin, end = tb.spans_of(_WORD[low], offsets)
    hashes = tb.hash_spans(low, begin, end)
    return hashes, tb.rows_of(begin, offsets)


# -- the index

_SEGMENT_FIELDS = ("words", "terms", "begins", "postings")


def _segments(batches: Iterator[pa.RecordBatch], vocabulary) -> Iterator[pa.RecordBatch]:
    """A row for each segment: its documents, their word counts, terms and postings."""
    only = None if vocabulary is None else vocabulary.value
    for batch in batches:
        for first, last, data, offsets in tb.text_slices(batch.column("text"), SEGMENT_BYTES):
            rows = last - first
            hashes, row = words(data, offsets)
            count = np.bincount(row, minlength=rows)
            position = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
            if only is not None:
                at = np.searchsorted(only, hashes)
                known = only[np.minimum(at, len(only) - 1)] == hashes if len(only) else at < 0
                hashes, row, position = hashes[known], row[known], position[known]
            order = np.argsort(hashes, kind="stable")
            postings = (row[order] << _ROW) | position[order]
            terms, begins = np.unique(hashes[order], return_index=True)
            begins = np.append(begins, len(order))
            # Differences of a term's postings are small and pack well.
            steps = np.diff(postings, prepend=0)
            values = (count.astype("<i4"), terms, begins.astype("<i8"), steps.astype("<i8"))
            ids = batch.column("id").slice(first, rows)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.ListArray.from_arrays(pa.array([0, rows], pa.int32()), ids),
                    *(pa.array([v.tobytes()], pa.binary()) for v in values),
                ],
                ["ids", *_SEGMENT_FIELDS],
            )


class Segment:
    """One opened segment."""

    def __init__(self, row: dict):
        self.words = np.frombuffer(row["words"], "<i4").astype(np.int64)
        self.terms = np.frombuffer(row["terms"], np.uint64)
        self.begins = np.frombuffer(row["begins"], "<i8")
        self._postings = np.cumsum(np.frombuffer(row["postings"], "<i8"))

    def places(self, terms: np.ndarray) -> np.ndarray:
        """Index of each term, -1 for those without postings."""
        if not len(self.terms):
            return np.full(terms.shape, -1)
        at = np.minimum(np.searchsorted(self.terms, terms), len(self.terms) - 1)
        return np.where(self.terms[at] == terms, at, -1)

    def postings(self, place: int) -> np.ndarray:
        """(document << 32 | position) of a term, in order."""
        return self._postings[self.begins[place] : self.begins[place + 1]]

    def phrase(self, places: list[int]) -> np.ndarray:
        """Where the terms follow each other: postings of the first one."""
        order = self._rarest_first(places)
        starts = self.postings(places[order[0]]) - order[0]
        for i in order[1:]:
            if not len(starts):
                break
            starts = starts[_among(starts + i, self.postings(places[i]))]
        return starts

    def near(self, places: list[int], slop: int) -> np.ndarray:
        """Postings of the rarest term that have every other one at most `slop` words away."""
        order = self._rarest_first(places)
        starts = self.postings(places[order[0]])
        for i in order[1:]:
            if not len(starts):
                break
            other = self.postings(places[i])
            at = np.searchsorted(other, starts - slop)
            found = other[np.minimum(at, len(other) - 1)]
            # A document is far more than `slop` from the next one in this numbering.
            starts = starts[(at < len(other)) & (np.abs(found - starts) <= slop)]
        return starts

    def _rarest_first(self, places: list[int]) -> list[int]:
        sizes = [self.begins[p + 1] - self.begins[p] for p in places]
        return sorted(range(len(places)), key=sizes.__getitem__)


def _among(values: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    at = np.minimum(np.searchsorted(ordered, values), len(ordered) - 1)
    return ordered[at] == values


# -- queries


class Windows(NamedTuple):
    """Windows of benchmark items: `terms` (unused ones 0), their number, and the item of each."""

    terms: np.ndarray
    sizes: np.ndarray
    items: np.ndarray
    names: list[str]


def windows_of(items: list[tuple[str, str]], size: int) -> Windows:
    data, offsets = tb.column_bytes(pa.array([text for _, text in items], pa.string()))
    terms, sizes, owners = [np.zeros((0, size), np.uint64)], [], []
    hashes, row = words(data[: offsets[-1]], offsets)
    at = np.searchsorted(row, np.arange(len(items) + 1))
    for i in range(len(items)):
        own = hashes[at[i] : at[i + 1]]
        if not len(own):
            continue
        if len(own) < size:
            own = np.pad(own, (0, size - len(own)))
        part = np.lib.stride_tricks.sliding_window_view(own, size)
        terms.append(part)
        sizes += [min(size, at[i + 1] - at[i])] * len(part)
        owners += [i] * len(part)
    return Windows(
        np.concatenate(terms), np.array(sizes, np.int64), np.array(owners, np.int64), [n for n, _ in items]
    )


def _search(segment: Segment, windows: Windows, slop: int):
    """(row, begin, end, item) of all phrase matches, and (row, item) of all proximity matches."""
    places = segment.places(windows.terms)
    used = np.arange(windows.terms.shape[1]) < windows.sizes[:, None]
    complete = np.flatnonzero(((places >= 0) | ~used).all(axis=1))
    exact, close = [], []
    for w in complete.tolist():
        own = places[w, : windows.sizes[w]].tolist()
        starts = segment.phrase(own)
        if len(starts):
            exact.append((starts, windows.sizes[w], windows.items[w]))
        near = segment.near(own, slop)
        if len(near):
            close.append((np.unique(near >> _ROW), windows.items[w]))
    mask = (1 << _ROW) - 1
    hits = [(s >> _ROW, s & mask, (s & mask) + n, np.full(len(s), i)) for s, n, i in exact]
    near = [(r, np.full(len(r), i)) for r, i in close]
    none = np.zeros(0, np.int64)
    return (
        [np.concatenate(c) for c in zip(*hits)] or [none] * 4,
        [np.concatenate(c) for c in zip(*near)] or [none] * 2,
    )


def _match(batches: Iterator[pa.RecordBatch], windows, slop: int) -> Iterator[pa.RecordBatch]:
    """Per document of each segment: counts, matched items and spans of words."""
    own: Windows = windows.value
    for batch in batches:
        for i in range(batch.num_rows):
            segment = Segment({f: batch.column(f)[i].as_py() for f in _SEGMENT_FIELDS})
            rows = len(segment.words)
            (row, begin, end, item), (near_row, near_item) = _search(segment, own, slop)
            # Word spans of all documents on one axis, then the union per document.
            base = np.concatenate([[0], np.cumsum(segment.words)])
            edges = np.zeros(base[-1] + 1, np.int64)
            np.add.at(edges, base[row] + begin, 1)
            np.add.at(edges, base[row] + end, -1)
            covered = np.concatenate([[False], np.cumsum(edges)[:-1] > 0, [False]]).astype(np.int8)
            # A run of hit words may not go on into the next document.
            starts, ends = _runs(covered[1:-1].astype(bool), base)
            owner = np.searchsorted(base, starts, "right") - 1
            spans = tb.ragged(np.arange(len(starts)), np.bincount(owner, minlength=rows), pa.int32())
            pairs = pa.StructArray.from_arrays(
                [pa.array((starts - base[owner]).astype(np.int32)), pa.array((ends - base[owner]).astype(np.int32))],
                ["begin", "end"],
            )
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("ids")[i].values,
                    pa.array(segment.words),
                    pa.ListArray.from_arrays(spans.offsets, pairs),
                    _names(row, item, rows, own.names),
                    _names(near_row, near_item, rows, own.names),
                ],
                ["id", "n_words", "spans", "items", "near_items"],
            )


def _runs(inside: np.ndarray, base: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(inside):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return tb.spans_of(inside, base)


def _names(row: np.ndarray, item: np.ndarray, rows: int, names: list[str]) -> pa.Array:
    out: list[list[str]] = [[] for _ in range(rows)]
    for r, i in np.unique(np.stack([row, item]), axis=1).T.tolist():
        out[r].append(names[i])
    return pa.array([sorted(set(x)) for x in out], pa.list_(pa.string()))


def build_index(
    docs: DataFrame,
    scratch: Scratch,
    id_column: str = "doc_id",
    text_column: str = "text",
    vocabulary: np.ndarray | None = None,
) -> DataFrame:
    """Write the index of all documents; with a sorted `vocabulary`, of its terms only."""
    text = F.coalesce(F.col(f"`{text_column}`").cast("string"), F.lit(""))
    rows = docs.select(F.col(f"`{id_column}`").alias("id"), text.alias("text"))
    spark = docs.sparkSession
    shared = None if vocabulary is None else spark.sparkContext.broadcast(vocabulary)
    schema = T.StructType(
        [T.StructField("ids", T.ArrayType(rows.schema["id"].dataType))]
        + [T.StructField(f, T.BinaryType()) for f in _SEGMENT_FIELDS]
    )
    return scratch.keep(rows.mapInArrow(partial(_segments, vocabulary=shared), schema), "index")


def find_contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    item_column: str = "item_id",
    item_text_column: str = "text",
    window: int = WINDOW,
    slop: int = SLOP,
) -> DataFrame:
    """Passages that documents share with benchmark items.

    A window is `window` consecutive words of an item; an item of fewer words, but not none, is one.
    Returns a row per document: `id`, `n_words`, `n_hit` (words inside any occurrence of a window),
    `spans` (begin and end of the runs of hit words), `items` (ids, as strings in order, of the items
    with windows that occur) and `near_items` (those with a window whose words all occur, in
    any order, at most `slop` words from its rarest one).

    Benchmark items are searched for in blocks of `BLOCK_BYTES` of text, so that what is broadcast is
    bounded; if there is but one block, the index holds its terms only, as no others can match.
    Null and empty texts have no words and no hits; items without words or id match nothing. Repeated
    documents each get a row, repeated items count once. Empty tables give no rows, or no hits.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "decontam")
    items = benchmark.select(
        F.col(f"`{item_column}`").cast("string").alias("item"),
        F.coalesce(F.col(f"`{item_text_column}`").cast("string"), F.lit("")).alias("text"),
    ).filter("item is not null")
    total = items.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    blocks = max(1, -(-total * 5 // (4 * BLOCK_BYTES)))
    block = F.pmod(F.xxhash64("item"), F.lit(blocks))

    def load(number: int) -> Windows:
        """One block of items; their hashes deal them evenly, so its size is about the bound."""
        rows = items.filter(block == number).orderBy("item", "text").collect()
        return windows_of([(r.item, r.text) for r in rows], window)

    only = load(0) if blocks == 1 else None
    vocabulary = None
    if only:
        used = np.arange(window) < only.sizes[:, None]
        vocabulary = np.unique(only.terms[used])
    index = build_index(docs, scratch, id_column, text_column, vocabulary)
    if blocks > 1:
        index = scratch.keep(index.withColumn("segment", F.monotonically_increasing_id()), "index")

    kind = docs.schema[id_column].dataType.simpleString()
    span = "array<struct<begin:int,end:int>>"
    schema = f"id {kind}, n_words long, spans {span}, items array<string>, near_items array<string>"
    parts = []
    for number in range(blocks):
        shared = spark.sparkContext.broadcast(only or load(number))
        found = index.mapInArrow(partial(_match, windows=shared, slop=slop), schema)
        if blocks > 1:
            # Rows of a segment come in the order of its documents, the same in every block.
            found = index.mapInArrow(
                partial(_numbered, windows=shared, slop=slop), f"segment long, place int, {schema}"
            )
            found = scratch.keep(found, "found")
            shared.unpersist()
        parts.append(found)
    found = parts[0]
    if blocks > 1:
        for part in parts[1:]:
            found = found.union(part)
        flat = lambda c: F.flatten(F.collect_list(c))
        found = found.groupBy("segment", "place").agg(
            F.first("id").alias("id"),
            F.first("n_words").alias("n_words"),
            flat("spans").alias("spans"),
            F.array_sort(F.array_distinct(flat("items"))).alias("items"),
            F.array_sort(F.array_distinct(flat("near_items"))).alias("near_items"),
        )
        found = found.withColumn("spans", _union_of_spans(F.col("spans")))
    size = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + (s["end"] - s["begin"]))
    return found.select("id", "n_words", size.alias("n_hit"), "spans", "items", "near_items")


def _numbered(batches: Iterator[pa.RecordBatch], windows, slop: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(batch.num_rows):
            (found,) = _match([batch.slice(i, 1)], windows, slop)
            place = pa.array(np.arange(found.num_rows, dtype=np.int32))
            segment = pa.array(np.full(found.num_rows, batch.column("segment")[i].as_py()))
            yield pa.RecordBatch.from_arrays(
                [segment, place, *found.columns], ["segment", "place", *found.schema.names]
            )


def _union_of_spans(spans):
    """Merge overlapping or touching spans of one document."""
    ordered = F.array_sort(spans)

    def add(done, span):
        last = F.element_at(done, -1)
        joined = F.struct(last["begin"].alias("begin"), F.greatest(last["end"], span["end"]).alias("end"))
        return F.when(
            (F.size(done) > 0) & (F.try_element_at(done, F.lit(-1))["end"] >= span["begin"]),
            F.concat(F.slice(done, 1, F.size(done) - 1), F.array(joined)),
        ).otherwise(F.concat(done, F.array(span)))

    empty = F.array().cast("array<struct<begin:int,end:int>>")
    return F.aggregate(ordered, empty, add)
