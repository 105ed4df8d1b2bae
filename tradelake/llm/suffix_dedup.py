"""Removal of long repeated byte strings with a logarithmic family of suffix indexes.

A full suffix array has an entry per byte. Here each text gets a sparse one: of every window of
`length` bytes, the `PREFIX`-byte string with the smallest hash is sampled, at the same offset
wherever the window occurs, so two equal windows always share a sampled suffix. Consecutive windows
with one sample form one entry. A suffix is filed under the fingerprint of its prefix (scans
look for equal prefixes only, so any order of prefixes will do) and carries the fingerprint of
the bytes that its windows span.

A new batch becomes a run sorted by prefix. It is merge-scanned against itself and every level
for prefixes that occur twice, then joins the family as a level; two levels of one size
merge to a level of the next. Thus each row is rewritten once per doubling.

A prefix whose occurrences all have equal surroundings proves all its windows repeated. Where
surroundings differ, one occurrence of each goes on to exact comparison window by window.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradelake.llm import textbytes as tb
from tradelake.llm.scratch import Scratch

LENGTH = 400
PREFIX = 240
BATCHES = 4

_WORD = re.compile(rb"[^\x20\x09-\x0D]+")
_SPAN = "array<struct<begin:int,end:int>>"


# -- sparse suffixes of texts


def _sliding_smallest(values: np.ndarray, width: int) -> np.ndarray:
    """Smallest of each `width` neighbours, from running minima within blocks of that width."""
    blocks = -(-len(values) // width)
    padded = np.full(blocks * width, np.iinfo(np.uint64).max, np.uint64)
    padded[: len(values)] = values
    padded = padded.reshape(blocks, width)
    ahead = np.minimum.accumulate(padded, axis=1).ravel()
    back = np.minimum.accumulate(padded[:, ::-1], axis=1)[:, ::-1].ravel()
    count = len(values) - width + 1
    return np.minimum(back[:count], ahead[width - 1 : width - 1 + count])


def sampled_suffixes(data: np.ndarray, offsets: np.ndarray, length: int, prefix: int):
    """(row, first window's begin, number of windows, prefix and context hash) of each sample."""
    if len(data) < length:
        return (np.zeros(0, np.int64),) * 3 + (np.zeros(0, np.uint64),) * 2
    sums = tb.prefix_hashes(data)
    at = np.arange(len(data) - prefix + 1)
    hashes = tb.mix(tb.span_hashes(sums, at, at + prefix))
    # The upper half orders the prefixes, the lower half says where; of equals the leftmost.
    ranked = (hashes & np.uint64(0xFFFFFFFF00000000)) | at.astype(np.uint64)
    smallest = _sliding_smallest(ranked, length - prefix + 1)
    sample = (smallest & np.uint64(0xFFFFFFFF)).astype(np.int64)
    window = np.arange(len(smallest))
    row = tb.rows_of(window, offsets)
    valid = window + length <= offsets[row + 1]
    first = valid.copy()
    first[1:] &= ~valid[:-1] | (sample[1:] != sample[:-1]) | (row[1:] != row[:-1])
    begin = np.flatnonzero(first)
    if not len(begin):
        return (np.zeros(0, np.int64),) * 3 + (np.zeros(0, np.uint64),) * 2
    count = np.add.reduceat(valid.astype(np.int64), begin)
    at = sample[begin]
    shape = (count.astype(np.uint64) << np.uint64(32)) | (at - begin).astype(np.uint64)
    context = tb.chain(tb.span_hashes(sums, begin, begin + count - 1 + length), shape)
    row = row[begin]
    return row, begin - offsets[row], count, hashes[at], context


def _sample(
    batches: Iterator[pa.RecordBatch], length: int, prefix: int
) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first, last, data, offsets in tb.text_slices(batch.column("text")):
            row, begin, count, key, context = sampled_suffixes(data, offsets, length, prefix)
            taken = pa.array(row + first)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id").take(taken),
                    batch.column("tag").take(taken),
                    pa.array(begin.astype(np.int32)),
                    pa.array(count.astype(np.int32)),
                    pa.array(tb.signed(key)),
                    pa.array(tb.signed(context)),
                ],
                ["id", "tag", "begin", "windows", "key", "context"],
            )


# -- the index family


class IndexFamily:
    """Levels of sorted runs; a run has, by prefix, its count and the range of its contexts."""

    def __init__(self, scratch: Scratch):
        self.scratch = scratch
        self.levels: list[tuple[int, DataFrame, str]] = []

    def add(self, entries: DataFrame) -> DataFrame:
        """Prefixes of `entries` that occur twice in it and the family so far, then add it.

        Returns `key` and `mixed`, whether the contexts of the prefix differ.
        """
        self._compact()
        run = entries.groupBy("key").agg(
            F.count("*").alias("n"), F.min("context").alias("low"), F.max("context").alias("high")
        )
        run, path = self.scratch.table(run.sortWithinPartitions("key"), "level")
        scanned = run.withColumn("fresh", F.lit(True))
        for _, level, _ in self.levels:
            scanned = scanned.union(level.withColumn("fresh", F.lit(False)))
        self.levels.append((0, run, path))
        return (
            _summed(scanned, F.max("fresh").alias("fresh"))
            .filter(F.col("fresh") & (F.col("n") > 1))
            .select("key", (F.col("low") != F.col("high")).alias("mixed"))
        )

    def _compact(self) -> None:
        """Merge the two youngest levels as long as they are of one size class."""
        while len(self.levels) > 1 and self.levels[-1][0] == self.levels[-2][0]:
            rank, young, young_path = self.levels.pop()
            _, old, old_path = self.levels.pop()
            merged = _summed(old.union(young)).sortWithinPartitions("key")
            merged, path = self.scratch.table(merged, "level")
            self.levels.append((rank + 1, merged, path))
            self.scratch.drop(young_path)
            self.scratch.drop(old_path)

    def drop(self) -> None:
        for _, _, path in self.levels:
            self.scratch.drop(path)
        self.levels = []


def _summed(rows: DataFrame, *more) -> DataFrame:
    return rows.groupBy("key").agg(
        F.sum("n").alias("n"), F.min("low").alias("low"), F.max("high").alias("high"), *more
    )


# -- exact comparison of windows


def _window_hashes(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """A row for each window of the picked contexts of each text."""
    for batch in batches:
        texts = batch.column("text")
        picks = batch.column("picks")
        lists, flat = picks.offsets.to_numpy(), picks.flatten()
        lists = lists - lists[0]
        fields = {f: flat.field(f).to_numpy(zero_copy_only=False) for f in ("begin", "windows", "key", "target")}
        for first, last, data, offsets in tb.text_slices(texts):
            part = slice(lists[first], lists[last])
            count = fields["windows"][part].astype(np.int64)
            if not count.sum():
                continue
            sums = tb.prefix_hashes(data)
            row = np.repeat(np.arange(last - first), np.diff(lists[first : last + 1]))
            begin = fields["begin"][part].astype(np.int64)
            step = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
            start = np.repeat(begin, count) + step
            at = start + np.repeat(offsets[row], count)
            key = np.repeat(fields["key"][part].view(np.uint64), count)
            window = tb.chain(tb.span_hashes(sums, at, at + length), key)
            taken = pa.array(np.repeat(row, count) + first)
            out = pa.RecordBatch.from_arrays(
                [
                    batch.column("id").take(taken),
                    batch.column("tag").take(taken),
                    pa.array(start.astype(np.int32)),
                    pa.array(np.repeat(fields["target"][part], count)),
                    pa.array(tb.signed(window)),
                ],
                ["id", "tag", "begin", "target", "window"],
            )
            for i in range(0, out.num_rows, 1 << 16):
                yield out.slice(i, 1 << 16)


# -- cutting


def merged_spans(begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Union of spans as maximal runs, in order."""
    order = np.argsort(begin, kind="stable")
    begin, reach = begin[order], np.maximum.accumulate(end[order])
    fresh = np.ones(len(begin), bool)
    fresh[1:] = begin[1:] > reach[:-1]
    at = np.flatnonzero(fresh)
    return begin[at], reach[np.append(at[1:], len(begin)) - 1] if len(at) else reach


def _cut_one(raw: bytes, begin: np.ndarray, end: np.ndarray, whole_chars: bool, least_words: int):
    begin, end = merged_spans(begin.astype(np.int64), end.astype(np.int64))
    if least_words:
        # Words that a run holds a part of count.
        runs = zip(begin.tolist(), end.tolist())
        long = [e - b >= LENGTH or len(_WORD.findall(raw, b, e)) >= least_words for b, e in runs]
        begin, end = begin[long], end[long]
    if whole_chars:
        inner = lambda i: i < len(raw) and raw[i] & 0xC0 == 0x80
        for i in range(len(begin)):
            while begin[i] < end[i] and inner(begin[i]):
                begin[i] += 1
            while end[i] > begin[i] and inner(end[i]):
                end[i] -= 1
    at, kept = 0, []
    for b, e in zip(begin.tolist(), end.tolist()):
        kept.append(raw[at:b])
        at = e
    kept.append(raw[at:])
    return b"".join(kept), begin, end


def _cut(batches: Iterator[pa.RecordBatch], whole_chars: bool, least_words: int) -> Iterator[pa.RecordBatch]:
    kind = pa.list_(pa.struct([("begin", pa.int32()), ("end", pa.int32())]))
    for batch in batches:
        data, offsets = tb.column_bytes(batch.column("text"))
        lists = batch.column("spans").offsets.to_numpy()
        flat = batch.column("spans").flatten()
        lists = lists - lists[0]
        begin, end = (flat.field(f).to_numpy(zero_copy_only=False) for f in ("begin", "end"))
        for low, high in tb.slices(offsets, 16 << 20):
            kept, spans = [], []
            for i in range(low, high):
                part = slice(lists[i], lists[i + 1])
                raw = data[offsets[i] : offsets[i + 1]].tobytes()
                b, e = begin[part], end[part]
                if len(b):
                    raw, b, e = _cut_one(raw, b, e, whole_chars, least_words)
                kept.append(raw)
                spans.append([{"begin": x, "end": y} for x, y in zip(b.tolist(), e.tolist())])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("row").slice(low, high - low),
                    pa.array(np.diff(offsets[low : high + 1])),
                    pa.array(kept, pa.binary()),
                    pa.array(spans, kind),
                ],
                ["row", "n_bytes", "kept", "spans"],
            )


# -- the operator


def repeated_spans(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    length: int = LENGTH,
    prefix: int = PREFIX,
    batches: int = BATCHES,
    scratch: Scratch | None = None,
) -> DataFrame:
    """Byte spans of each text that are covered by a `length`-byte string occurring elsewhere.

    Returns `id`, `tag` (the hash of id and text, so that rows sharing an id stay apart) and
    `spans`, unmerged; texts without such a string have no row.
    """
    spark = docs.sparkSession
    scratch = scratch or Scratch(spark, "suffix-dedup")
    rows = _rows(docs, id_column, text_column)
    kind = rows.schema["id"].dataType.simpleString()

    sampled = rows.filter(F.octet_length("text") >= length).mapInArrow(
        partial(_sample, length=length, prefix=prefix),
        f"id {kind}, tag long, begin int, windows int, key long, context long",
    )
    entries, entries_path = scratch.table(
        sampled.withColumn("batch", F.pmod("tag", F.lit(batches)).cast("int")), "entries", "batch"
    )

    family, hits = IndexFamily(scratch), []
    for number in range(batches):
        found = family.add(entries.filter(F.col("batch") == number).select("key", "context"))
        hits.append(scratch.keep(found, "hits"))
    family.drop()
    union = hits[0]
    for found in hits[1:]:
        union = union.union(found)
    repeated = scratch.keep(union.groupBy("key").agg(F.max("mixed").alias("mixed")), "repeated")

    end = (F.col("begin") + F.col("windows") + F.lit(length - 1)).alias("end")
    found = entries.drop("batch").join(repeated, "key")
    found, found_path = scratch.table(found, "found", "mixed")
    scratch.drop(entries_path)
    plain = found.filter(~F.col("mixed")).select("id", "tag", "begin", end)

    mixed = found.filter("mixed")
    place = F.struct("tag", "id", "begin", "windows")
    contexts = scratch.keep(
        mixed.groupBy("key", "context").agg(F.count("*").alias("n"), F.min(place).alias("place")),
        "contexts",
    )
    twice = contexts.filter("n > 1").select("key", "context")
    same = mixed.join(twice, ["key", "context"]).select("id", "tag", "begin", end)

    picks = (
        contexts.select("key", "n", "place.*")
        .groupBy("tag", "id")
        .agg(
            F.collect_list(
                F.struct("begin", "windows", "key", (F.col("n") == 1).alias("target"))
            ).alias("picks")
        )
    )
    windows = _with_text(rows, picks, "inner").mapInArrow(
        partial(_window_hashes, length=length),
        f"id {kind}, tag long, begin int, target boolean, window long",
    )
    windows, windows_path = scratch.table(windows, "windows")
    again = scratch.keep(
        windows.groupBy("window").agg(F.count("*").alias("n")).filter("n > 1").select("window"),
        "again",
    )
    single = (
        windows.filter("target")
        .join(again, "window")
        .select("id", "tag", "begin", (F.col("begin") + F.lit(length)).alias("end"))
    )
    spans = plain.union(same).union(single)
    # Rows that repeat an id and a text find the same spans: as a set, they are bounded by one text.
    spans = spans.groupBy("tag", "id").agg(F.collect_set(F.struct("begin", "end")).alias("spans"))
    spans = scratch.keep(spans, "spans")
    scratch.drop(found_path)
    scratch.drop(windows_path)
    return spans


def remove_repeats(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    length: int = LENGTH,
    prefix: int = PREFIX,
    batches: int = BATCHES,
    whole_chars: bool = False,
    least_words: int = 0,
) -> DataFrame:
    """Cut out of every text the bytes that repeat elsewhere in strings of `length` bytes.

    Returns a row per input row: `row` (all its columns but the text), `n_bytes`, `kept` (the
    remaining bytes), `spans` (begin and end of the maximal removed runs). Strings are judged on the
    input, never cross texts, and may repeat within a text or overlap. With `whole_chars`, a
    character cut in two is kept whole, so that `kept` stays valid UTF-8. With `least_words`, runs of fewer
    words stay, unless they have `LENGTH` bytes.

    A null text is empty; empty texts and those shorter than `length` keep everything. Repeated
    rows count as occurrences of each other, so a text of `length` bytes or more that has an
    exact copy loses all of its bytes, in both. A null id is a value like any other. An empty
    table gives no rows.
    """
    scratch = Scratch(docs.sparkSession, "suffix-dedup")
    spans = repeated_spans(docs, id_column, text_column, length, prefix, batches, scratch)
    others = [c for c in docs.columns if c != text_column]
    rows = _rows(docs, id_column, text_column, F.struct(*[F.col(f"`{c}`") for c in others]))
    joined = _with_text(rows, spans, "left").select(
        "row", "text", F.coalesce("spans", F.array().cast(_SPAN)).alias("spans")
    )
    schema = T.StructType(
        [
            rows.schema["row"],
            T.StructField("n_bytes", T.LongType()),
            T.StructField("kept", T.BinaryType()),
            T.StructField("spans", T.ArrayType(T.StructType([T.StructField("begin", T.IntegerType()), T.StructField("end", T.IntegerType())]))),
        ]
    )
    return joined.mapInArrow(partial(_cut, whole_chars=whole_chars, least_words=least_words), schema)


def _rows(docs: DataFrame, id_column: str, text_column: str, row=None) -> DataFrame:
    text = F.coalesce(F.col(f"`{text_column}`").cast("string"), F.lit(""))
    ident = F.col(f"`{id_column}`")
    columns = [ident.alias("id"), F.xxhash64(ident, text).alias("tag"), text.alias("text")]
    return docs.select(*columns, *([row.alias("row")] if row is not None else []))


def _with_text(rows: DataFrame, other: DataFrame, how: str) -> DataFrame:
    other = other.withColumnRenamed("tag", "_tag").withColumnRenamed("id", "_id")
    same = (rows["tag"] == other["_tag"]) & rows["id"].eqNullSafe(other["_id"])
    return rows.join(other, same, how).drop("_tag", "_id")
