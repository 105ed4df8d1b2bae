"""Toxic spans and document scores from a linear-chain conditional random field.

Tokens are labelled from labelled documents: a word that documents marked toxic hold far more often
than others is an offending token there. On these tokens a chain with two states is fitted, with weights
for the word, its first and its last bytes, and for moves between the states. Forward and
backward messages, kept as log-odds, give each token's marginal probability. A document's
score is a calibrated function of its marginals; runs of likely tokens are its spans.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradelake.llm import logistic, samples
from tradelake.llm import textbytes as tb
from tradelake.llm.near_dup import shingles

# Bounds of the training sample: documents of a class, and bytes of a document that may be in it.
PER_CLASS = 1500
TRAIN_BYTES = 20_000

# Hash buckets of each kind of feature, bytes of the features of a word's begin and end.
BUCKETS = 1 << 18
HEADS = (4, 5, 6)
TAIL = 4
# A feature offends from this log-odds ratio and this likelihood-ratio statistic on; so large a
# statistic arises by chance once in ten million features.
SURE = 28.0
LEAST_ODDS = 2.5
# Tokens after which a chain starts anew; it does so at each sentence end too.
CHAIN = 128
EPOCHS = 15
RATE = 0.5
RIDGE = 1e-4

_WORD = np.zeros(256, bool)
_WORD[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
_STOP = np.zeros(256, bool)
_STOP[[*b".!?\n"]] = True


class Tokens(NamedTuple):
    row: np.ndarray
    begin: np.ndarray
    end: np.ndarray
    word: np.ndarray
    features: np.ndarray  # (kinds, tokens)
    chain: np.ndarray


class Model(NamedTuple):
    weights: np.ndarray  # (kinds, BUCKETS)
    bias: float
    moves: np.ndarray  # log weights (from, to)
    calibration: np.ndarray


def tokens(data: np.ndarray, offsets: np.ndarray) -> Tokens:
    low = tb.lower_ascii(data)
    begin, end = tb.spans_of(_WORD[low], offsets)
    sums = tb.prefix_hashes(low)
    word = tb.mix(tb.span_hashes(sums, begin, end))
    heads = [
        tb.mix(tb.span_hashes(sums, begin, np.minimum(begin + size, end)) + np.uint64(size))
        for size in HEADS
    ]
    tail = tb.mix(tb.span_hashes(sums, np.maximum(end - TAIL, begin), end))
    features = (np.stack([word, *heads, tail]) & np.uint64(BUCKETS - 1)).astype(np.int64)
    row = tb.rows_of(begin, offsets)
    # A sentence ends between two words if a stop lies between them.
    stops = np.zeros(len(low) + 1, np.int64)
    np.cumsum(_STOP[low], out=stops[1:])
    fresh = np.ones(len(begin), bool)
    fresh[1:] = (row[1:] != row[:-1]) | (stops[begin[1:]] > stops[end[:-1]])
    since = np.arange(len(begin)) - np.maximum.accumulate(np.where(fresh, np.arange(len(begin)), 0))
    fresh |= since % CHAIN == 0
    return Tokens(row, begin, end, word, features, np.flatnonzero(fresh))


class _Grid:
    """Chains side by side, longest first, so that step t works on a leading part of them."""

    def __init__(self, chain: np.ndarray, total: int):
        length = np.diff(np.append(chain, total))
        order = np.argsort(-length, kind="stable")
        self.first, self.length = chain[order], length[order]
        steps = int(self.length[0]) if len(chain) else 0
        self.active = np.searchsorted(-self.length, -np.arange(steps), "left")


def _forward(move: np.ndarray, scores: np.ndarray, grid: _Grid) -> np.ndarray:
    """Log-odds of state 1 given the tokens so far."""
    a = np.exp(move)
    out = np.empty(len(scores))
    message = np.zeros(len(grid.first))
    for t, n in enumerate(grid.active):
        at = grid.first[:n] + t
        if t:
            e = np.exp(np.clip(message[:n], -30, 30))
            came = np.log((a[0, 1] + a[1, 1] * e) / (a[0, 0] + a[1, 0] * e))
        else:
            came = 0.0
        message[:n] = scores[at] + came
        out[at] = message[:n]
    return out


def _backward(move: np.ndarray, scores: np.ndarray, grid: _Grid) -> np.ndarray:
    """Log-odds of state 1 from the tokens that follow."""
    a = np.exp(move)
    out = np.zeros(len(scores))
    message = np.zeros(len(grid.first))
    for t in range(len(grid.active) - 1, -1, -1):
        n = grid.active[t]
        at = grid.first[:n] + t
        # Chains that end here have no message yet.
        out[at] = message[:n]
        e = np.exp(np.clip(message[:n] + scores[at], -30, 30))
        message[:n] = np.log((a[1, 0] + a[1, 1] * e) / (a[0, 0] + a[0, 1] * e))
    return out


def _scores(model_weights: np.ndarray, bias: float, features: np.ndarray) -> np.ndarray:
    out = np.full(features.shape[1], bias)
    for kind in range(len(features)):
        out += model_weights[kind][features[kind]]
    return out


def marginals(model: Model, toks: Tokens) -> np.ndarray:
    if not len(toks.word):
        return np.zeros(0)
    grid = _Grid(toks.chain, len(toks.word))
    scores = _scores(model.weights, model.bias, toks.features)
    return logistic.sigmoid(
        _forward(model.moves, scores, grid) + _backward(model.moves, scores, grid)
    )


# -- learning


def token_labels(toks: Tokens, toxic: np.ndarray) -> np.ndarray:
    """Tokens of toxic documents with a feature that is surely far more frequent among those.

    The log-odds ratio of a feature's document frequencies has to be large, and no chance find.
    """
    n_yes, n_no = max(int((toxic == 1).sum()), 1), max(int((toxic == 0).sum()), 1)
    labels = np.zeros(len(toks.word), bool)
    # Ends of words are left out: they are shared by words of all kinds.
    for feature in toks.features[:-1]:
        seen = np.unique(toks.row * BUCKETS + feature)
        marked = toxic[seen // BUCKETS] == 1
        yes = np.bincount(seen[marked] % BUCKETS, minlength=BUCKETS)
        no = np.bincount(seen[~marked] % BUCKETS, minlength=BUCKETS)
        odds = np.log((yes + 0.5) / (n_yes - yes + 0.5)) - np.log((no + 0.5) / (n_no - no + 0.5))
        # Likelihood ratio against equal frequencies in both classes.
        seen_in = yes + no
        even = np.maximum(seen_in, 1) / (n_yes + n_no)
        ratio = yes * np.log(np.maximum(yes, 1) / (even * n_yes))
        ratio += no * np.log(np.maximum(no, 1) / (even * n_no))
        labels |= ((2 * ratio > SURE) & (odds > LEAST_ODDS))[feature]
    return (labels & (toxic[toks.row] == 1)).astype(np.float64)


def unlike_rows(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Rows without those that look like copies of earlier ones: chance words of a text that was
    copied would else pass for words of its class."""
    values, owner, _ = shingles(data, offsets, 5)
    rows = np.unique(owner)
    for order in range(3):
        least = np.full(len(offsets) - 1, np.iinfo(np.uint64).max, np.uint64)
        np.minimum.at(least, owner, tb.mix(values + np.uint64(order)))
        rows = rows[np.sort(np.unique(least[rows], return_index=True)[1])]
    return rows


def train(data: np.ndarray, offsets: np.ndarray, toxic: np.ndarray) -> Model:
    """Fit the chain by gradient steps on the likelihood of the token labels, then calibrate."""
    rows = unlike_rows(data, offsets)
    parts = [data[offsets[i] : offsets[i + 1]] for i in rows]
    data = np.concatenate(parts) if parts else data[:0]
    offsets = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int64)
    toxic = toxic[rows]
    toks = tokens(data, offsets)
    labels = token_labels(toks, toxic)
    kinds, total = toks.features.shape
    weights, bias = np.zeros((kinds, BUCKETS)), -3.0
    moves, grid = np.zeros((2, 2)), _Grid(toks.chain, total)
    squares, move_squares, bias_square = np.full((kinds, BUCKETS), 1e-8), np.full((2, 2), 1e-8), 1e-8
    follows = np.ones(total, bool)
    follows[toks.chain] = False
    to = np.flatnonzero(follows)
    before = to - 1
    counts = np.zeros((2, 2))
    np.add.at(counts, (labels[before].astype(int), labels[to].astype(int)), 1)
    for _ in range(EPOCHS if total else 0):
        scores = _scores(weights, bias, toks.features)
        forward, backward = _forward(moves, scores, grid), _backward(moves, scores, grid)
        error = labels - logistic.sigmoid(forward + backward)
        # Marginals of neighbours: forward of the first, both scores of the second.
        after = scores[to] + backward[to]
        ones = np.stack(
            [
                np.full(len(to), moves[0, 0]),
                moves[0, 1] + after,
                moves[1, 0] + forward[before],
                moves[1, 1] + forward[before] + after,
            ]
        )
        ones = np.exp(np.clip(ones - ones.max(axis=0), -60, 0))
        expected = (ones / ones.sum(axis=0)).sum(axis=1).reshape(2, 2)
        for kind in range(kinds):
            gradient = np.bincount(toks.features[kind], error, BUCKETS) - RIDGE * weights[kind]
            squares[kind] += gradient**2
            weights[kind] += RATE * gradient / np.sqrt(squares[kind])
        gradient = counts - expected
        move_squares += gradient**2
        moves += 0.2 * gradient / np.sqrt(move_squares)
        bias_square += error.sum() ** 2
        bias += RATE * error.sum() / np.sqrt(bias_square)
    model = Model(weights.astype(np.float32), float(bias), moves, np.zeros(3))
    summary = _summary(marginals(model, toks), toks.row, len(toxic))
    beta = logistic.fit(summary, toxic.astype(np.float64)) if len(set(toxic.tolist())) == 2 else np.array([0.0, 0.0, -3.0])
    return model._replace(calibration=beta)


def _summary(p: np.ndarray, row: np.ndarray, rows: int) -> np.ndarray:
    """What a document's score depends on: its most likely token, and the expected number of them."""
    most = np.zeros(rows)
    np.maximum.at(most, row, p)
    sure = np.bincount(row, np.where(p > 0.2, p, 0), rows)
    return np.column_stack([most, np.log1p(sure)])


# -- scoring


def _score(batches: Iterator[pa.RecordBatch], model) -> Iterator[pa.RecordBatch]:
    own: Model = model.value
    for batch in batches:
        for first, last, data, offsets in tb.text_slices(batch.column("text")):
            rows = last - first
            toks = tokens(data, offsets)
            p = marginals(own, toks)
            score = logistic.sigmoid(logistic.logits(_summary(p, toks.row, rows), own.calibration))
            at = np.flatnonzero(p >= 0.5)
            begins = np.ones(len(at), bool)
            begins[1:] = (np.diff(at) > 1) | np.diff(toks.row[at]).astype(bool)
            start = at[begins]
            stop = at[np.append(begins[1:], True)] if len(at) else at
            base = offsets[toks.row[start]]
            spans = pa.StructArray.from_arrays(
                [pa.array((toks.begin[start] - base).astype(np.int32)), pa.array((toks.end[stop] - base).astype(np.int32))],
                ["begin", "end"],
            )
            places = tb.ragged(np.arange(len(start)), np.bincount(toks.row[start], minlength=rows), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id").slice(first, rows),
                    pa.array(score),
                    pa.ListArray.from_arrays(places.offsets, spans),
                ],
                ["id", "score", "spans"],
            )


def fit_on(
    docs: DataFrame,
    labels: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    label_column: str = "toxic",
    per_class: int = PER_CLASS,
    train_bytes: int = TRAIN_BYTES,
) -> Model:
    """Train on up to `per_class` documents of each class, of up to `train_bytes` bytes each."""
    picked = samples.labelled_ids(labels, id_column, label_column, per_class)
    text = F.coalesce(F.col(f"`{text_column}`").cast("string"), F.lit(""))
    rows = docs.select(F.col(f"`{id_column}`").alias("id"), text.alias("text"))
    # At most 2 * per_class ids, whatever the tables' size.
    found = rows.filter(F.octet_length("text") <= train_bytes).join(F.broadcast(picked), "id")
    found = found.dropDuplicates(["id"]).toPandas().sort_values("id")
    data, offsets = tb.column_bytes(pa.array(found["text"].tolist(), pa.string()))
    return train(data[: offsets[-1]], offsets, found["label"].to_numpy(np.int64))


def score_toxicity(
    docs: DataFrame, model: Model, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """`id`, `score` (0 to 1) and `spans` (byte offsets of offending words) of every row.

    Whole texts are read; a score depends on the text alone, so equal texts have equal scores. Null and
    empty texts get the score of a text without offending words and no spans. An empty table
    gives no rows. If labels of only one class, or none, are at hand, all scores are low.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col(f"`{text_column}`").cast("string"), F.lit(""))
    rows = docs.select(F.col(f"`{id_column}`").alias("id"), text.alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    shared = spark.sparkContext.broadcast(model)
    return rows.mapInArrow(
        partial(_score, model=shared),
        f"id {kind}, score double, spans array<struct<begin:int,end:int>>",
    )
