"""Phrases whose words come together more often than apart, counted in weighted acyclic automata.

Each task turns the ordered n-grams of its texts into count automata, one for each prefix range; a
range's automata are united and their weights summed, which gives exact counts over all texts. An
n-gram is counted only if both (n - 1)-grams in it are frequent, by a filter of fixed size: it lets a few
others through, whose counts then show it. The counts of a phrase's parts are looked up
by walking the automata of the ranges that the parts lie in.

Words are known by 64-bit labels of language and word; labels of two words would be told
by the vocabulary, and all would be hashed anew.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import partial
from hashlib import blake2b
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tradelake.llm import textbytes as tb
from tradelake.llm.count_automata import CountAutomaton, summed
from tradelake.llm.scratch import Scratch

LEAST = 30
LONGEST = 4
TOP = 2000
# Percent of a phrase's occurrences that a longer one must hold to replace it.
WITHIN = 80
SCALE = 2_000_000

# Words that a task counts at once, and words of all texts per prefix range.
BUFFER_WORDS = 1 << 20
RANGE_WORDS = 1 << 23
# Bits of the filter that is broadcast: 16 MB whatever the corpus.
FILTER_BITS = 27
_CHUNK_BITS = 21

# The bytes that end a piece, and those that separate words within one.
_ENDS = np.zeros(256, bool)
_ENDS[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
_BLANK = np.zeros(256, bool)
_BLANK[[0x20, 0x09]] = True


# -- words of texts


def _next_cut(data: np.ndarray, offsets: np.ndarray, begin: int, limit: int) -> int:
    """Up to about `limit` bytes on: between texts, or after a mark that ends a piece."""
    at = begin + limit
    if at >= offsets[-1]:
        return int(offsets[-1])
    text = int(offsets[np.searchsorted(offsets, at, "right") - 1])
    marks = np.flatnonzero(_ENDS[data[begin:at]])
    cut = max(text, begin + int(marks[-1]) + 1 if len(marks) else begin)
    if cut > begin:
        return cut
    # One piece longer than the limit is taken whole.
    while True:
        text = int(offsets[np.searchsorted(offsets, at, "right")])
        marks = np.flatnonzero(_ENDS[data[at : min(at + limit, text)]])
        if len(marks):
            return at + int(marks[0]) + 1
        if text <= at + limit:
            return text
        at += limit


class Words(NamedTuple):
    """Labels of words in order; `joined`: whether a word and the next are of one piece."""

    labels: np.ndarray
    joined: np.ndarray
    rows: np.ndarray
    data: np.ndarray
    begin: np.ndarray
    end: np.ndarray


def _language_hashes(column: pa.Array, seed: int) -> np.ndarray:
    known = column.dictionary_encode()
    names = known.dictionary.to_pylist()
    hashes = [blake2b(n.encode(), digest_size=8, salt=seed.to_bytes(8, "little")).digest() for n in names]
    table = np.frombuffer(b"".join(hashes), np.uint64)
    return table[known.indices.to_numpy(zero_copy_only=False)] if len(names) else np.zeros(0, np.uint64)


def words_of(batch: pa.RecordBatch, seed: int, limit: int = tb.SLICE_BYTES) -> Iterator[Words]:
    data, offsets = tb.column_bytes(batch.column("text"))
    languages = _language_hashes(batch.column("lang"), seed)
    first, last = int(offsets[0]), int(offsets[0])
    while last < offsets[-1]:
        first, last = last, _next_cut(data, offsets, last, limit)
        low = tb.lower_ascii(data[first:last])
        edges = np.clip(offsets, first, last) - first
        ends = _ENDS[low]
        begin, end = tb.spans_of(~(ends | _BLANK[low]), edges)
        rows = tb.rows_of(begin, edges)
        marks = np.cumsum(ends, dtype=np.int32)[begin] if len(low) else np.zeros(0, np.int32)
        joined = np.zeros(len(begin), bool)
        joined[:-1] = (marks[1:] == marks[:-1]) & (rows[1:] == rows[:-1])
        labels = tb.chain(languages[rows], tb.hash_spans(low, begin, end))
        yield Words(labels, joined, rows, low, begin, end)


def _count_words(batches: Iterator[pa.RecordBatch], seed: int) -> Iterator[pa.RecordBatch]:
    """Each task's words with their counts, once or a few times each."""
    schema = pa.schema([("label", pa.int64()), ("lang", pa.string()), ("word", pa.binary()), ("f", pa.int64())])
    waiting: list[pa.Table] = []
    size = 0

    def flush() -> Iterator[pa.RecordBatch]:
        if waiting:
            table = pa.concat_tables(waiting)
            labels = table.column("label").to_numpy()
            _, at, group = np.unique(labels, return_index=True, return_inverse=True)
            sums = np.zeros(len(at), np.int64)
            np.add.at(sums, group, table.column("f").to_numpy())
            table = table.take(pa.array(at)).set_column(3, "f", pa.array(sums))
            yield from table.cast(schema).to_batches(max_chunksize=1 << 16)

    for batch in batches:
        for words in words_of(batch, seed):
            labels, at, count = np.unique(words.labels, return_index=True, return_counts=True)
            spans = zip(words.begin[at].tolist(), words.end[at].tolist())
            raw = words.data.tobytes()
            texts = pa.array([raw[b:e] for b, e in spans], pa.binary())
            langs = batch.column("lang").take(pa.array(words.rows[at]))
            columns = [pa.array(tb.signed(labels)), langs, texts, pa.array(count.astype(np.int64))]
            waiting.append(pa.Table.from_arrays(columns, schema=schema))
            size += len(labels)
        if size >= BUFFER_WORDS:
            yield from flush()
            waiting, size = [], 0
    yield from flush()


# -- the filter of frequent n-grams


def _bits(grams: np.ndarray, bits: int) -> np.ndarray:
    """The two places of each n-gram in the filter."""
    shift = np.uint64(64 - bits)
    other = tb.mix(grams ^ np.uint64(0x5A5A5A5A5A5A5A5A))
    return np.stack([tb.mix(grams) >> shift, other >> shift]).astype(np.int64)


class FrequentFilter:
    """Answers yes for every frequent n-gram, and for few others."""

    def __init__(self, packed: list[tuple[int, bytes]], bits: int):
        self.bits = bits
        self.packed = packed

    def open(self) -> FrequentFilter:
        self.table = np.zeros(1 << (self.bits - 3), np.uint8)
        chunk = 1 << (min(_CHUNK_BITS, self.bits) - 3)
        for number, raw in self.packed:
            part = np.frombuffer(zlib.decompress(raw), np.uint8)
            self.table[number * chunk : (number + 1) * chunk] = part
        return self

    def test(self, grams: np.ndarray) -> np.ndarray:
        one, two = ((self.table[p >> 3] << (p & 7).astype(np.uint8)) for p in _bits(grams, self.bits))
        return (one & two & 0x80) > 0


def _places(batches: Iterator[pa.RecordBatch], bits: int, grams_of) -> Iterator[pa.RecordBatch]:
    """What a task's n-grams set, as places within chunks of the filter."""
    chunk = min(_CHUNK_BITS, bits)
    for batch in batches:
        for grams in grams_of(batch):
            places = np.unique(_bits(grams, bits))
            number = places >> chunk
            for n in np.unique(number).tolist():
                own = (places[number == n] & ((1 << chunk) - 1)).astype("<u4")
                yield pa.RecordBatch.from_arrays(
                    [pa.array([n], pa.int32()), pa.array([own.tobytes()], pa.binary())], ["chunk", "places"]
                )


def _chunks(batches: Iterator[pa.RecordBatch], bits: int) -> Iterator[pa.RecordBatch]:
    """The chunks that a task was dealt, packed; there are a fixed number of them in all."""
    chunk, tables = min(_CHUNK_BITS, bits), {}
    for batch in batches:
        for n, raw in zip(batch.column("chunk").to_pylist(), batch.column("places").to_pylist()):
            table = tables.setdefault(n, np.zeros(1 << chunk, np.uint8))
            table[np.frombuffer(raw, "<u4")] = 1
    for n, table in tables.items():
        packed = zlib.compress(np.packbits(table).tobytes(), 1)
        yield pa.RecordBatch.from_arrays(
            [pa.array([n], pa.int32()), pa.array([packed], pa.binary())], ["chunk", "packed"]
        )


def _filter(rows: DataFrame, grams_of, bits: int):
    """Broadcast the filter of the n-grams in `rows`; its size is fixed by `bits`."""
    chunks = 1 << max(bits - _CHUNK_BITS, 0)
    placed = rows.mapInArrow(partial(_places, bits=bits, grams_of=grams_of), "chunk int, places binary")
    packed = placed.repartitionById(chunks, "chunk").mapInArrow(
        partial(_chunks, bits=bits), "chunk int, packed binary"
    )
    found = FrequentFilter([(r.chunk, bytes(r.packed)) for r in packed.collect()], bits)
    return rows.sparkSession.sparkContext.broadcast(found)


def _labels_of(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
    if batch.num_rows:
        yield batch.column("label").to_numpy(zero_copy_only=False).view(np.uint64)


def _grams_of(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
    for raw in batch.column("automaton").to_pylist():
        columns, _ = CountAutomaton.from_bytes(raw).paths()
        if len(columns[0]):
            yield _gram(columns)


def _gram(columns: list[np.ndarray]) -> np.ndarray:
    gram = columns[0]
    for c in columns[1:]:
        gram = tb.chain(gram, c)
    return gram


# -- counting n-grams


class Ranges(NamedTuple):
    """Prefix ranges: by the first word, or by the first two where the first is very common."""

    count: int
    common: np.ndarray

    def of(self, columns: list[np.ndarray]) -> np.ndarray:
        base = columns[0]
        if len(columns) > 1 and len(self.common):
            at = np.minimum(np.searchsorted(self.common, base), len(self.common) - 1)
            base = np.where(self.common[at] == base, tb.chain(base, columns[1]), base)
        return (tb.mix(base) % np.uint64(self.count)).astype(np.int32)


_AUTOMATA = "range int, length int, automaton binary"


def _automata(columns: list[np.ndarray], weights: np.ndarray, ranges: Ranges) -> Iterator[pa.RecordBatch]:
    """Ordered n-grams as one automaton for each prefix range."""
    dealt = ranges.of(columns)
    order = np.argsort(dealt, kind="stable")
    edges = np.flatnonzero(np.diff(dealt[order])) + 1
    for own in np.split(order, edges):
        if len(own):
            one = CountAutomaton.build([c[own] for c in columns], weights[own])
            values = ([int(dealt[own[0]])], [len(columns)], [one.to_bytes()])
            kinds = (pa.int32(), pa.int32(), pa.binary())
            yield pa.RecordBatch.from_arrays(
                [pa.array(v, k) for v, k in zip(values, kinds)], ["range", "length", "automaton"]
            )


def _count_ngrams(
    batches: Iterator[pa.RecordBatch], length: int, seed: int, frequent, ranges: Ranges
) -> Iterator[pa.RecordBatch]:
    """A task's n-grams whose parts may be frequent, as automata."""
    known: FrequentFilter = frequent.value.open()
    waiting: list[list[np.ndarray]] = []
    size = 0

    def flush() -> Iterator[pa.RecordBatch]:
        if waiting:
            columns = [np.concatenate(c) for c in zip(*waiting)]
            yield from _automata(*summed(columns, np.ones(len(columns[0]), np.int64)), ranges)

    for batch in batches:
        for words in words_of(batch, seed):
            at = _candidates(words, length, known)
            waiting.append([words.labels[at + j] for j in range(length)])
            size += len(at)
            if size >= BUFFER_WORDS:
                yield from flush()
                waiting, size = [], 0
    if size:
        yield from flush()


def _candidates(words: Words, length: int, known: FrequentFilter) -> np.ndarray:
    """Where n-grams begin both (n - 1)-grams of which pass the filter."""
    full = max(len(words.labels) - length + 1, 0)
    inside = np.ones(full, bool)
    for j in range(length - 1):
        inside &= words.joined[j : full + j]
    parts = max(len(words.labels) - length + 2, 0)
    grams = _gram([words.labels[j : parts + j] for j in range(length - 1)])
    passes = known.test(grams)
    return np.flatnonzero(inside & passes[:full] & passes[1 : full + 1])


def _unite(batches: Iterator[pa.RecordBatch], least: int) -> Iterator[pa.RecordBatch]:
    """The frequent n-grams of one prefix range with their counts over all texts."""
    length, number = 0, None

    def each() -> Iterator[CountAutomaton]:
        nonlocal length, number
        for batch in batches:
            for n, k, raw in zip(*(batch.column(c).to_pylist() for c in ("range", "length", "automaton"))):
                if number is not None and n != number:
                    raise ValueError("a task has two prefix ranges")
                number, length = n, k
                yield CountAutomaton.from_bytes(raw)

    columns, weights = CountAutomaton.union(each())
    often = weights >= least
    if often.any():
        one = CountAutomaton.build([c[often] for c in columns], weights[often])
        values = ([number], [length], [one.to_bytes()])
        kinds = (pa.int32(), pa.int32(), pa.binary())
        yield pa.RecordBatch.from_arrays(
            [pa.array(v, k) for v, k in zip(values, kinds)], ["range", "length", "automaton"]
        )


def _word_automata(batches: Iterator[pa.RecordBatch], ranges: Ranges) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            labels = batch.column("label").to_numpy(zero_copy_only=False).view(np.uint64)
            counts = batch.column("f").to_numpy(zero_copy_only=False)
            yield from _automata(*summed([labels], counts), ranges)


# -- the counts of parts

_ASKED = "range int, kind int, length int, automaton binary, path array<long>, phrase array<long>, a long, cut int, rest boolean"


def _held(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Automata in the form of the table that the questions are in."""
    schema = _asked_schema()
    for batch in batches:
        n = batch.num_rows
        columns = {
            "range": batch.column("range"),
            "kind": pa.array(np.zeros(n, np.int32)),
            "length": batch.column("length"),
            "automaton": batch.column("automaton"),
        }
        arrays = [columns.get(f.name, pa.nulls(n, f.type)) for f in schema]
        yield pa.RecordBatch.from_arrays([a.cast(f.type) for a, f in zip(arrays, schema)], schema=schema)


def _asked_schema() -> pa.Schema:
    labels = pa.list_(pa.int64())
    return pa.schema(
        [("range", pa.int32()), ("kind", pa.int32()), ("length", pa.int32()), ("automaton", pa.binary())]
        + [("path", labels), ("phrase", labels), ("a", pa.int64()), ("cut", pa.int32()), ("rest", pa.bool_())]
    )


def _questions(batches: Iterator[pa.RecordBatch], ranges: Ranges) -> Iterator[pa.RecordBatch]:
    """For each cut of each phrase, its two parts, sent to the ranges that hold them."""
    schema = _asked_schema()
    for batch in batches:
        for raw in batch.column("automaton").to_pylist():
            columns, weights = CountAutomaton.from_bytes(raw).paths()
            phrase = np.stack(columns, axis=1)
            for cut in range(1, len(columns)):
                for rest, part in ((False, columns[:cut]), (True, columns[cut:])):
                    n = len(weights)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(ranges.of(part)),
                            pa.array(np.ones(n, np.int32)),
                            pa.array(np.full(n, len(part), np.int32)),
                            pa.nulls(n, pa.binary()),
                            _lists(np.stack(part, axis=1)),
                            _lists(phrase),
                            pa.array(weights),
                            pa.array(np.full(n, cut, np.int32)),
                            pa.array(np.full(n, rest)),
                        ],
                        schema=schema,
                    )


def _lists(table: np.ndarray) -> pa.Array:
    rows, width = table.shape
    offsets = np.arange(rows + 1, dtype=np.int32) * width
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.ascontiguousarray(table).view(np.int64).ravel()))


def _answers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Walk the automata of a range, which come first, with all the parts asked for."""
    held: dict[int, list[CountAutomaton]] = {}
    for batch in batches:
        kinds = batch.column("kind").to_numpy()
        for i in np.flatnonzero(kinds == 0).tolist():
            one = CountAutomaton.from_bytes(batch.column("automaton")[i].as_py())
            held.setdefault(batch.column("length")[i].as_py(), []).append(one)
        lengths = batch.column("length").to_numpy()
        for length in range(1, LONGEST):
            own = np.flatnonzero((kinds == 1) & (lengths == length))
            if not len(own):
                continue
            asked = batch.take(pa.array(own))
            paths = asked.column("path").flatten().to_numpy().view(np.uint64).reshape(-1, length)
            counts = sum(a.look_up([paths[:, j] for j in range(length)]) for a in held.get(length, []))
            counts = np.broadcast_to(np.asarray(counts, np.int64), len(own))
            yield pa.RecordBatch.from_arrays(
                [*(asked.column(c) for c in ("phrase", "a", "cut", "rest")), pa.array(np.ascontiguousarray(counts))],
                ["phrase", "a", "cut", "rest", "f"],
            )


# -- the operator


def _vocabulary(texts: DataFrame, scratch: Scratch) -> tuple[DataFrame, int]:
    """(`label`, `lang`, `word`, `f`) of all words, and the seed by which no two share a label."""
    for seed in range(8):
        counted = texts.mapInArrow(
            partial(_count_words, seed=seed), "label long, lang string, word binary, f long"
        )
        one = F.struct("lang", "word")
        grouped = counted.groupBy("label").agg(
            F.sum("f").alias("f"), F.min(one).alias("one"), (F.min(one) != F.max(one)).alias("mixed")
        )
        words, path = scratch.table(grouped.select("label", "one.lang", "one.word", "f", "mixed"), "words")
        if words.filter("mixed").isEmpty():
            return words.drop("mixed"), seed
        scratch.drop(path)
    raise RuntimeError("labels of words collide under every seed")


def count_phrases(
    docs: DataFrame,
    scratch: Scratch,
    text_column: str = "text",
    lang_column: str = "lang",
    least: int = LEAST,
    longest: int = LONGEST,
    filter_bits: int = FILTER_BITS,
) -> tuple[DataFrame, list[DataFrame], Ranges]:
    """All words with counts, and per length from 1 the automata of the n-grams with `least` or more."""
    spark = docs.sparkSession
    texts = docs.select(
        F.coalesce(F.col(f"`{text_column}`").cast("string"), F.lit("")).alias("text"),
        F.coalesce(F.col(f"`{lang_column}`").cast("string"), F.lit("und")).alias("lang"),
    )
    words, seed = _vocabulary(texts, scratch)
    total = words.agg(F.sum("f")).first()[0] or 0
    count = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // RANGE_WORDS))
    # No more such words than ranges, as their counts add up to the total.
    common = words.filter(F.col("f") * count >= max(total, 1)).select("label").collect()
    ranges = Ranges(count, np.sort(np.array([r.label for r in common], np.int64).view(np.uint64)))
    often = words.filter(F.col("f") >= least)
    levels = [scratch.keep(often.mapInArrow(partial(_word_automata, ranges=ranges), _AUTOMATA), "words")]
    frequent = _filter(often, _labels_of, filter_bits)
    for length in range(2, longest + 1):
        counted = texts.mapInArrow(
            partial(_count_ngrams, length=length, seed=seed, frequent=frequent, ranges=ranges), _AUTOMATA
        )
        united = counted.repartitionById(count, "range").mapInArrow(partial(_unite, least=least), _AUTOMATA)
        levels.append(scratch.keep(united, "ngrams"))
        frequent.unpersist()
        if length < longest:
            frequent = _filter(levels[-1], _grams_of, filter_bits)
    return words, levels, ranges


def mine_phrases(
    docs: DataFrame,
    text_column: str = "text",
    lang_column: str = "lang",
    least: int = LEAST,
    within: int = WITHIN,
    top: int = TOP,
) -> DataFrame:
    """The best phrases of two to four words of each language.

    Words are what stands between spaces and tabs in the pieces of a text between marks and line
    ends, A-Z lower-cased. f is the number of all occurrences of words in a row within
    pieces. A phrase of f >= `least` (a) has, for each cut in two parts, the score
    floor(2000000 * a / (f(first) + f(rest))); its least score counts, at the shortest first part among
    equal ones. Phrases of which a longer one has `within` percent of the occurrences are left out.

    Returns the first `top` of each language by score and a, both from the highest, and phrase (UTF-8 byte order): `lang`,
    `rank` from 1, `phrase`, `a`, `l`, `r` (the parts' f), `n` (all words of the language), `score`.

    Null and empty texts have no words, a null language is `und`, like one of that name. Repeated
    documents count each time. A text may have any length and is cut between pieces;
    a single piece is held whole. Other columns don't matter. An empty table gives no rows.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "collocations")
    words, levels, ranges = count_phrases(docs, scratch, text_column, lang_column, least)
    held, asked = levels[0], levels[1]
    for level in levels[1:]:
        held = held.union(level)
    for level in levels[2:]:
        asked = asked.union(level)
    table = held.mapInArrow(_held, _ASKED).union(asked.mapInArrow(partial(_questions, ranges=ranges), _ASKED))
    # The automata of a range come first, then the parts to look up in them.
    found = (
        table.repartitionById(ranges.count, "range")
        .sortWithinPartitions("range", "kind")
        .mapInArrow(_answers, "phrase array<long>, a long, cut int, rest boolean, f long")
    )
    cuts = found.groupBy("phrase", "a", "cut").agg(
        F.max(F.when(~F.col("rest"), F.col("f"))).alias("l"), F.max(F.when(F.col("rest"), F.col("f"))).alias("r")
    )
    best = F.min(F.struct(_score("a", "l", "r").alias("score"), "cut", "l", "r")).alias("best")
    phrases = scratch.keep(cuts.groupBy("phrase").agg(F.max("a").alias("a"), best), "phrases")

    inner = phrases.select(
        F.explode(_inner_phrases(F.col("phrase"))).alias("phrase"), F.col("a").alias("longer")
    )
    covered = inner.groupBy("phrase").agg(F.max("longer").alias("longer"))
    kept = (
        phrases.join(covered, "phrase", "left")
        .filter(F.col("longer").isNull() | (100 * F.col("longer") < within * F.col("a")))
        .select("phrase", "a", "best.score", "best.l", "best.r", F.col("phrase")[0].alias("label"))
    )
    names = words.filter(F.col("f") >= least).select("label", "lang", F.col("word").cast("string").alias("word"))
    placed = kept.join(names.select("label", "lang"), "label").drop("label")
    # The phrase itself only breaks ties, so only what may come among the first gets its words.
    order = [F.col("score").desc(), F.col("a").desc()]
    near = Window.partitionBy("lang").orderBy(*order)
    leading = scratch.keep(placed.withColumn("place", F.rank().over(near)).filter(F.col("place") <= top), "leading")
    spelled = (
        leading.select("phrase", F.posexplode("phrase").alias("at", "label"))
        .join(names.select("label", "word"), "label")
        .groupBy("phrase")
        .agg(F.sort_array(F.collect_list(F.struct("at", "word"))).alias("words"))
        .select("phrase", F.array_join("words.word", " ").alias("spelled"))
    )
    totals = words.groupBy("lang").agg(F.sum("f").alias("n"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(*order, "spelled"))
    return (
        leading.join(spelled, "phrase")
        .withColumn("rank", rank.cast("long"))
        .filter(F.col("rank") <= top)
        .join(totals, "lang")
        .select("lang", "rank", F.col("spelled").alias("phrase"), "a", "l", "r", "n", "score")
    )


def _score(a: str, left: str, right: str) -> Column:
    """Exact: the product has up to 27 digits."""
    wide = "decimal(20,0)"
    product = f"cast({a} as {wide}) * cast({SCALE} as {wide})"
    return F.expr(f"cast(({product}) div (cast({left} as {wide}) + cast({right} as {wide})) as long)")


def _inner_phrases(phrase: Column) -> Column:
    """All shorter runs of two words or more in a phrase."""
    size = F.size(phrase)
    lengths = F.when(size > 2, F.sequence(F.lit(2), size - 1)).otherwise(F.array().cast("array<int>"))
    runs = F.transform(
        lengths, lambda n: F.transform(F.sequence(F.lit(1), size - n + 1), lambda i: F.slice(phrase, i, n))
    )
    return F.flatten(runs)
