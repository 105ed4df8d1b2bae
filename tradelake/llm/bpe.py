"""Byte-level BPE encoding and decoding as a monoid reduction over each text.

A text is halved until a block is short. Joining two encoded neighbours re-encodes a window
around their boundary, which grows on each side until it starts and ends at a seam: a non-blank
character followed by a space or a line end. No match of the splitting pattern spans a seam and none
looks across one (each of its alternatives takes blanks only before other characters), so the
tokens outside the window cannot change, whatever stands on the other side. Decoding
joins the bytes of blocks of ids pairwise up the same kind of tree.

The blocks themselves are encoded by the tiktoken library.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator
from functools import lru_cache, partial
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradelake.llm import textbytes as tb

# Characters in a block that is encoded at once, and of the first window to either side of a join. Most
# documents have several blocks; blocks of 4,096 take half the time.
BLOCK = 512
WINDOW = 32
# Ids in a block that is decoded at once.
ID_BLOCK = 256
# Bytes of text in one output batch.
OUT_BYTES = 8 << 20

_SEAM = re.compile(r"\S(?=[ \n])")


class Encoded(NamedTuple):
    """Part of a text with its ids: an element of the monoid, whose neutral one is empty."""

    text: str
    ids: np.ndarray


class Codec:
    """The vocabulary of a rank file with the joins of the reduction."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self._encoding = tiktoken.Encoding(
            "ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}
        )
        self._bytes = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            self._bytes[rank] = token
        self._sizes = np.array([len(b) for b in self._bytes])

    def block(self, text: str) -> Encoded:
        return Encoded(text, np.array(self._encoding.encode_ordinary(text), np.uint32))

    def encode(self, text: str) -> Encoded:
        if len(text) <= BLOCK:
            return self.block(text)
        half = len(text) // 2
        return self.join(self.encode(text[:half]), self.encode(text[half:]))

    def join(self, left: Encoded, right: Encoded) -> Encoded:
        if not left.text or not right.text:
            return right if not left.text else left
        begin, end = _last_seam(left.text), _first_seam(right.text)
        tail, head = left.text[begin:], right.text[:end]
        stay = len(left.ids) - self._covering(left.ids[::-1], tail)
        skip = self._covering(right.ids, head)
        middle = self.block(tail + head).ids
        ids = np.concatenate([left.ids[:stay], middle, right.ids[skip:]])
        return Encoded(left.text + right.text, ids)

    def _covering(self, ids: np.ndarray, text: str) -> int:
        """How many leading tokens of `ids` have exactly the bytes of `text`."""
        size = len(text.encode())
        # No token is empty, so no more tokens than bytes are needed.
        return int(np.searchsorted(np.cumsum(self._sizes[ids[:size]]), size)) + 1 if size else 0

    def decode(self, ids: np.ndarray) -> bytes:
        parts = [
            b"".join(map(self._bytes.__getitem__, ids[i : i + ID_BLOCK].tolist()))
            for i in range(0, len(ids), ID_BLOCK)
        ]
        while len(parts) > 1:
            parts = [b"".join(parts[i : i + 2]) for i in range(0, len(parts), 2)]
        return parts[0] if parts else b""


def _last_seam(text: str) -> int:
    """Where the last seam of `text` lies, looking at ever longer ends; 0 if there is none."""
    size = WINDOW
    while True:
        begin = max(len(text) - size, 0)
        last = None
        for last in _SEAM.finditer(text, begin):
            pass
        if last:
            return last.end()
        if not begin:
            return 0
        size *= 2


def _first_seam(text: str) -> int:
    """Where the first seam of `text` lies, looking at ever longer parts; its end if none."""
    size = WINDOW
    while True:
        first = _SEAM.search(text, 0, size)
        # The last character looked at cannot be seen to be followed by a blank.
        if first:
            return first.end()
        if size >= len(text):
            return len(text)
        size *= 2


@lru_cache(maxsize=4)
def codec(ranks_path: str, pattern: str) -> Codec:
    with open(ranks_path, "rb") as lines:
        pairs = (line.split() for line in lines if line.strip())
        return Codec({base64.b64decode(token): int(rank) for token, rank in pairs}, pattern)


def _encode(batches: Iterator[pa.RecordBatch], ranks: str, pattern: str) -> Iterator[pa.RecordBatch]:
    own = codec(ranks, pattern)
    for batch in batches:
        for first, last, data, offsets in tb.text_slices(batch.column("text"), OUT_BYTES):
            raw = data.tobytes()
            ids = [
                own.encode(raw[offsets[i] : offsets[i + 1]].decode("utf-8", "replace")).ids
                for i in range(last - first)
            ]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("row").slice(first, last - first),
                    pa.array([len(x) for x in ids], pa.int64()),
                    pa.array([x.astype("<u4").tobytes() for x in ids], pa.binary()),
                ],
                ["row", "n_tokens", "ids"],
            )


def _decode(batches: Iterator[pa.RecordBatch], ranks: str, pattern: str) -> Iterator[pa.RecordBatch]:
    own = codec(ranks, pattern)
    for batch in batches:
        for first, last, data, offsets in tb.text_slices(batch.column("ids"), OUT_BYTES):
            texts = [
                own.decode(data[offsets[i] : offsets[i + 1]].view("<u4")) for i in range(last - first)
            ]
            part = batch.slice(first, last - first)
            yield pa.RecordBatch.from_arrays(
                [*part.columns, pa.array(texts, pa.binary())], [*part.schema.names, "decoded"]
            )


def _round_trip(
    batches: Iterator[pa.RecordBatch], ranks: str, pattern: str
) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        done = 0
        for part in _decode(_encode(iter([batch]), ranks, pattern), ranks, pattern):
            row, count, ids, decoded = part.columns
            own = batch.slice(done, len(part))
            done += len(part)
            same = pc.equal(own.column("text").cast(decoded.type), decoded)
            yield pa.RecordBatch.from_arrays(
                [row, own.column("absent"), own.column("text"), count, ids, same],
                ["row", "absent", "text", "n_tokens", "ids", "round_trip"],
            )


def encode(
    docs: DataFrame, ranks_path: str, pattern: str, text_column: str = "text"
) -> DataFrame:
    """Token ids of every text, as an encoder of this rank file and pattern without special tokens.

    Returns a row per input row: `row` (all its columns but the text), `n_tokens` and `ids`
    (little-endian unsigned 32-bit integers). Null and empty texts have no ids; a text without seams
    is re-encoded whole at each join, which is slow but right; bytes that are not UTF-8 count as
    U+FFFD. Rows are independent, so repeated rows and null ids need no care, and an empty table
    gives no rows. The file must be at this path on all machines.
    """
    others = [F.col(f"`{c}`") for c in docs.columns if c != text_column]
    text = F.coalesce(F.col(f"`{text_column}`").cast("string"), F.lit(""))
    rows = docs.select(F.struct(*others).alias("row"), text.alias("text"))
    schema = T.StructType(
        [rows.schema["row"], T.StructField("n_tokens", T.LongType()), T.StructField("ids", T.BinaryType())]
    )
    return rows.mapInArrow(partial(_encode, ranks=ranks_path, pattern=pattern), schema)


def decode(encoded: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """Add `decoded`, the bytes of `ids`, to rows of `encode`'s form; null ids have no bytes."""
    schema = T.StructType([*encoded.schema.fields, T.StructField("decoded", T.BinaryType())])
    return encoded.mapInArrow(partial(_decode, ranks=ranks_path, pattern=pattern), schema)


def encode_checked(
    docs: DataFrame, ranks_path: str, pattern: str, text_column: str = "text"
) -> DataFrame:
    """`encode` with `text` and `round_trip`: whether the decoded ids are the text again.

    A task encodes and decodes in the same Python worker, and a text enters and leaves it once. A
    null text stays null; its ids are empty and it counts as decoded.
    """
    others = [F.col(f"`{c}`") for c in docs.columns if c != text_column]
    text = F.col(f"`{text_column}`").cast("string")
    rows = docs.select(
        F.struct(*others).alias("row"),
        text.isNull().alias("absent"),
        F.coalesce(text, F.lit("")).alias("text"),
    )
    schema = T.StructType(
        [
            *rows.schema.fields,
            T.StructField("n_tokens", T.LongType()),
            T.StructField("ids", T.BinaryType()),
            T.StructField("round_trip", T.BooleanType()),
        ]
    )
    found = rows.mapInArrow(partial(_round_trip, ranks=ranks_path, pattern=pattern), schema)
    return found.withColumn("text", F.when(~F.col("absent"), F.col("text"))).drop("absent")
