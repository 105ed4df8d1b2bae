"""Document quality by co-training two classifiers on different views of a page.

One view is the text's content (shares of kinds of characters, repeated words and lines, hashed
words), the other the page's metadata (source, language, length). Starting from labelled documents,
each round every view's classifier labels the unlabelled documents it is most sure of, in the whole
corpus, and the other view learns from them. At the end each view is calibrated, on labelled
documents that it has not learned from, and a last regression combines the calibrated views.

Views of the unlabelled documents are written once. A Newton step on them is one pass: tasks add up
gradient and curvature of both views, Spark sums those by slot, and the driver gets as many numbers as
the two views have coefficients and pairs of them, whatever the corpus. Sums are of fixed point, so
their order does not matter.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import partial
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradelake.llm import logistic, samples
from tradelake.llm import textbytes as tb
from tradelake.llm.near_dup import shingles
from tradelake.llm.scratch import Scratch

# Bound of the training sample: labelled documents of a class. Unlabelled ones have none.
PER_CLASS = 2000

# Exchanges of pseudo-labels, and Newton steps on them at most; a shorter move ends the steps.
ROUNDS = 3
STEPS = 4
SMALL_MOVE = 0.02
# A pseudo-label is given from this confidence on. It counts as this share of a label at most; all of
# them together count as this share of the labels.
CONFIDENCE = 0.95
PSEUDO_WEIGHT = 0.3
PSEUDO_SHARE = 0.5
# Units of the fixed-point sums.
UNIT = 2.0**20

WORD_BUCKETS = 128
SOURCE_BUCKETS = 64
LANG_BUCKETS = 16


def _table(characters: bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[[*characters]] = True
    return out


_KINDS = (
    _table(bytes(range(65, 91))),
    _table(b"0123456789"),
    _table(b".,;:!?'\"-()"),
    _table(b"#*$%&|<>{}[]=_~^@\\/"),
    _table(b"\n"),
)


def _per_row(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    sums = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=sums[1:])
    return sums[offsets[1:]] - sums[offsets[:-1]]


def _distinct_share(values: np.ndarray, owner: np.ndarray, rows: int) -> np.ndarray:
    at = np.searchsorted(owner, np.arange(rows + 1))
    return np.array(
        [len(np.unique(values[a:b])) / (b - a) if b > a else 1.0 for a, b in zip(at[:-1], at[1:])]
    )


def content_features(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    rows = len(offsets) - 1
    size = np.maximum(np.diff(offsets), 1)
    begin, end = tb.blank_words(data, offsets)
    row = tb.rows_of(begin, offsets)
    count = np.bincount(row, minlength=rows)
    some = np.maximum(count, 1)
    low = tb.lower_ascii(data)
    words = tb.mix(tb.span_hashes(tb.prefix_hashes(low), begin, end))
    lines_begin, lines_end = tb.spans_of(data != 10, offsets)
    lines = tb.mix(tb.span_hashes(tb.prefix_hashes(data), lines_begin, lines_end))
    five, owner, _ = shingles(data, offsets, 5)
    columns = [
        *(_per_row(kind[data], offsets) / size for kind in _KINDS),
        np.log1p(count) / 10,
        np.bincount(row, end - begin, rows) / some / 10,
        _distinct_share(words, row, rows),
        _distinct_share(lines, tb.rows_of(lines_begin, offsets), rows),
        _distinct_share(five, owner, rows),
    ]
    bucket = (words % np.uint64(WORD_BUCKETS)).astype(np.int64)
    hashed = np.bincount(row * WORD_BUCKETS + bucket, minlength=rows * WORD_BUCKETS)
    hashed = hashed.reshape(rows, WORD_BUCKETS) / some[:, None]
    return np.column_stack([*columns, np.sqrt(hashed)])


def _one_hot(column: pa.Array, buckets: int) -> np.ndarray:
    data, offsets = tb.column_bytes(column)
    data, offsets = data[offsets[0] : offsets[-1]], offsets - offsets[0]
    sums = tb.prefix_hashes(data)
    code = tb.mix(tb.span_hashes(sums, offsets[:-1], offsets[1:])) % np.uint64(buckets)
    return np.eye(buckets)[code.astype(np.int64)]


def metadata_features(lang: pa.Array, source: pa.Array, size: pa.Array) -> np.ndarray:
    size = size.fill_null(0).to_numpy(zero_copy_only=False).astype(np.float64)
    size = np.log1p(np.maximum(size, 0)) / 10
    return np.column_stack(
        [_one_hot(lang, LANG_BUCKETS), _one_hot(source, SOURCE_BUCKETS), size, size**2]
    )


class Model(NamedTuple):
    views: tuple[np.ndarray, np.ndarray]
    calibration: tuple[np.ndarray, np.ndarray]
    combined: np.ndarray

    def view_logits(self, features: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
        return np.column_stack(
            [
                logistic.logits(logistic.logits(x, beta)[:, None], own)
                for x, beta, own in zip(features, self.views, self.calibration)
            ]
        )

    def score(self, features: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        own = self.view_logits(features)
        return logistic.sigmoid(logistic.logits(own, self.combined)), logistic.sigmoid(own)


class Told(NamedTuple):
    """Sure rows of one view: their number, and gradient and curvature of the view's fit to them."""

    count: float
    gradient: np.ndarray
    curve: np.ndarray


def told_sums(
    features: tuple[np.ndarray, np.ndarray],
    views: list[np.ndarray],
    teachers: list[np.ndarray],
    confidence: float,
) -> list[Told]:
    """What each view learns at its coefficients `views` from the rows that the other's teacher is sure of."""
    out = []
    for v in range(2):
        p = logistic.sigmoid(logistic.logits(features[1 - v], teachers[1 - v]))
        sure = (p >= confidence) | (p <= 1 - confidence)
        x = logistic.with_intercept(features[v][sure])
        out.append(Told(float(sure.sum()), *logistic.curvature(x, np.round(p[sure]), np.ones(len(x)), views[v])))
    return out


def train(
    labelled: tuple[np.ndarray, np.ndarray],
    labels: np.ndarray,
    calibrate: np.ndarray,
    exchange: Callable[[list[np.ndarray], list[np.ndarray]], list[Told]],
) -> Model:
    """`calibrate` marks labelled rows that are kept for calibration and the combination.

    `exchange(views, teachers)` gives `told_sums` over all unlabelled rows.
    """
    learn = ~calibrate
    known = [logistic.with_intercept(x[learn]) for x in labelled]
    views = [logistic.fit(x[learn], labels[learn]) for x in labelled]
    for _ in range(ROUNDS):
        # Each view tells the other one what it is sure of.
        teachers = list(views)
        for _ in range(STEPS):
            longest = 0.0
            for v, told in enumerate(exchange(views, teachers)):
                gradient, curve = logistic.curvature(known[v], labels[learn], np.ones(len(known[v])), views[v])
                weight = min(PSEUDO_WEIGHT, PSEUDO_SHARE * len(known[v]) / max(told.count, 1.0))
                views[v], move = logistic.newton_step(
                    views[v], gradient + weight * told.gradient, curve + weight * told.curve, 1.0
                )
                longest = max(longest, move)
            if longest < SMALL_MOVE:
                break
    own = [logistic.logits(labelled[v][calibrate], views[v])[:, None] for v in range(2)]
    calibration = tuple(logistic.fit(x, labels[calibrate], ridge=0.01) for x in own)
    model = Model(tuple(views), calibration, np.array([1.0, 1.0, 0.0]))
    both = model.view_logits(tuple(x[calibrate] for x in labelled))
    return model._replace(combined=logistic.fit(both, labels[calibrate], ridge=0.01))


# -- on tables


def _views(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, tuple]]:
    for batch in batches:
        for first, last, data, offsets in tb.text_slices(batch.column("text")):
            part = batch.slice(first, last - first)
            meta = metadata_features(*(part.column(c) for c in ("lang", "source", "size")))
            yield part, (content_features(data, offsets), meta)


def _lists(x: np.ndarray) -> pa.Array:
    ends = np.arange(len(x) + 1, dtype=np.int32) * x.shape[1]
    return pa.ListArray.from_arrays(ends, pa.array(x.astype(np.float32).ravel()))


def _matrix(lists: pa.Array) -> np.ndarray:
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(len(lists), -1).astype(np.float64)


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part, views in _views(batches):
        lists = [_lists(x) for x in views]
        yield pa.RecordBatch.from_arrays(
            [part.column("id"), part.column("label"), *lists], ["id", "label", "content", "metadata"]
        )


def _told_slots(batches: Iterator[pa.RecordBatch], state) -> Iterator[pa.RecordBatch]:
    """One task's `told_sums`, as (`slot`, `value`) rows in fixed point."""
    total = None
    for batch in batches:
        if batch.num_rows:
            features = tuple(_matrix(batch.column(c)) for c in ("content", "metadata"))
            flat = np.concatenate([_flat(t) for t in told_sums(features, *state.value)])
            total = flat if total is None else total + flat
    if total is not None:
        value = np.rint(total * UNIT).astype(np.int64)
        slot = np.flatnonzero(value)
        yield pa.RecordBatch.from_arrays(
            [pa.array(slot.astype(np.int32)), pa.array(value[slot])], ["slot", "value"]
        )


def _flat(told: Told) -> np.ndarray:
    return np.concatenate([[told.count], told.gradient, told.curve[np.triu_indices(len(told.gradient))]])


def _unflat(values: np.ndarray, width: int) -> Told:
    upper = np.zeros((width, width))
    upper[np.triu_indices(width)] = values[1 + width :]
    return Told(float(values[0]), values[1 : 1 + width], upper + np.triu(upper, 1).T)


def _exchange(
    views: list[np.ndarray], teachers: list[np.ndarray], free: DataFrame, confidence: float
) -> list[Told]:
    """`told_sums` over the table of unlabelled documents' features."""
    shared = free.sparkSession.sparkContext.broadcast((views, teachers, confidence))
    slots = (
        free.mapInArrow(partial(_told_slots, state=shared), "slot int, value long")
        .groupBy("slot")
        .agg(F.sum("value").alias("value"))
        .toPandas()
    )
    widths = [len(b) for b in views]
    sizes = [1 + n + n * (n + 1) // 2 for n in widths]
    values = np.zeros(sum(sizes))
    values[slots["slot"].to_numpy(np.int64)] = slots["value"].to_numpy(np.float64) / UNIT
    shared.destroy()
    return [_unflat(part, n) for part, n in zip(np.split(values, [sizes[0]]), widths)]


def _score(batches: Iterator[pa.RecordBatch], model) -> Iterator[pa.RecordBatch]:
    own: Model = model.value
    for part, views in _views(batches):
        score, single = own.score(views)
        columns = [pa.array(x) for x in (score, *single.T.copy())]
        yield pa.RecordBatch.from_arrays(
            [part.column("id"), *columns], ["id", "score", "content_score", "metadata_score"]
        )


def _rows(docs: DataFrame, id_column: str, text_column: str, metadata: tuple[str, str, str]) -> DataFrame:
    lang, source, size = (F.col(f"`{c}`") for c in metadata)
    return docs.select(
        F.col(f"`{id_column}`").alias("id"),
        F.coalesce(F.col(f"`{text_column}`").cast("string"), F.lit("")).alias("text"),
        lang.cast("string").alias("lang"),
        source.cast("string").alias("source"),
        size.cast("long").alias("size"),
    )


METADATA = ("lang", "source", "n_chars")


def fit_on(
    docs: DataFrame,
    labels: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    metadata: tuple[str, str, str] = METADATA,
    label_column: str = "quality",
    per_class: int = PER_CLASS,
    confidence: float = CONFIDENCE,
) -> Model:
    """Train on `per_class` labelled rows of each class and on all rows whose id has no label.

    Rows without an id are unlabelled. Of labelled rows that share an id, one counts; repeated
    unlabelled rows all do. Ids that are in `labels`, the held-out ones too, are not told labels. Where
    labels of a class are missing, the model scores a half.
    """
    scratch = Scratch(docs.sparkSession, "co-training")
    picked = samples.labelled_ids(labels, id_column, label_column, per_class)
    known = labels.select(F.col(f"`{id_column}`").alias("id")).distinct()
    rows = _rows(docs, id_column, text_column, metadata)
    kind = rows.schema["id"].dataType.simpleString()
    schema = f"id {kind}, label int, content array<float>, metadata array<float>"
    # At most 2 * per_class ids, whatever the tables' size.
    chosen = rows.join(F.broadcast(picked.select("id", F.col("label").cast("int"))), "id")
    found = chosen.mapInArrow(_features, schema)
    found = found.dropDuplicates(["id"]).toPandas().sort_values("id", ignore_index=True)
    y = found["label"].to_numpy(np.float64)
    calibrate = np.arange(len(y)) % 4 == 0
    if len(set(y[calibrate])) < 2 or len(set(y[~calibrate])) < 2:
        flat = tuple(np.zeros(n) for n in _widths())
        return Model(flat, (np.zeros(2), np.zeros(2)), np.zeros(3))
    labelled = tuple(np.array(found[c].tolist(), np.float64) for c in ("content", "metadata"))
    # Features are smaller than texts, so the join moves those where the labels are too many to send.
    everyone = rows.withColumn("label", F.lit(None).cast("int")).mapInArrow(_features, schema)
    unlabelled = everyone.join(known, "id", "left_anti").select("content", "metadata")
    free, path = scratch.table(unlabelled, "unlabelled")
    model = train(labelled, y, calibrate, partial(_exchange, free=free, confidence=confidence))
    scratch.drop(path)
    return model


def _widths() -> tuple[int, int]:
    """Coefficients of each view, the intercept included."""
    none = pa.array([""], pa.string())
    content = content_features(np.zeros(0, np.uint8), np.zeros(2, np.int64))
    return content.shape[1] + 1, metadata_features(none, none, pa.array([0])).shape[1] + 1


def score_quality(
    docs: DataFrame,
    model: Model,
    id_column: str = "doc_id",
    text_column: str = "text",
    metadata: tuple[str, str, str] = METADATA,
) -> DataFrame:
    """`id`, `score` (0 to 1, higher: quality 1 likelier) and both views' calibrated scores of every row.

    A null text is empty, null metadata count as empty or 0; a score depends on the row's own text and
    metadata only, so repeated rows score the same. An empty table gives no rows. Where labels of a class
    are missing, every score is a half.
    """
    rows = _rows(docs, id_column, text_column, metadata)
    kind = rows.schema["id"].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return rows.mapInArrow(
        partial(_score, model=shared),
        f"id {kind}, score double, content_score double, metadata_score double",
    )
