"""Vectorised work on the UTF-8 bytes of a column of texts, inside tasks.

A batch of texts is one byte array plus offsets, as Arrow holds it; nothing here makes a Python
object per word. Work goes through the batch in slices of whole texts, so that memory follows
the slice size or the longest single text, whichever is larger.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa

# Bytes of text that one vectorised step looks at (a longer text is taken alone).
SLICE_BYTES = 2 << 20

# The constants of the splitmix64 finaliser, and an odd base for rolling hashes.
_GOLDEN = np.uint64(0x9E3779B97F4A7C15)
_MIX_1 = np.uint64(0xBF58476D1CE4E5B9)
_MIX_2 = np.uint64(0x94D049BB133111EB)
_BASE = 0xD6E8FEB86659FD93

_powers = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values over all bits (one-to-one)."""
    x = (x ^ (x >> np.uint64(30))) * _MIX_1
    x = (x ^ (x >> np.uint64(27))) * _MIX_2
    return x ^ (x >> np.uint64(31))


def chain(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Order-sensitive combination of two 64-bit hashes."""
    return mix(left * _GOLDEN + right)


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def column_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string or binary column; a null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null(b"" if pa.types.is_binary(column.type) else "")
    column = column.cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1, 8 * column.offset)
    raw = column.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8)
    return data, offsets


def slices(offsets: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows with up to `limit` bytes each, or a single longer row."""
    first, rows = 0, len(offsets) - 1
    while first < rows:
        last = int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1
        last = min(max(last, first + 1), rows)
        yield first, last
        first = last


def text_slices(
    column: pa.Array, limit: int = SLICE_BYTES
) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row after the last, bytes, offsets into them) of each slice of a column."""
    data, offsets = column_bytes(column)
    for first, last in slices(offsets, limit):
        begin, end = int(offsets[first]), int(offsets[last])
        yield first, last, data[begin:end], offsets[first : last + 1] - begin


def lower_ascii(data: np.ndarray) -> np.ndarray:
    upper = (data >= 65) & (data <= 90)
    return data + (upper.view(np.uint8) << 5)


def _grow(size: int) -> None:
    have = len(_powers["up"])
    if have < size:
        size = max(size, 2 * have)
        for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _powers[name] = np.cumprod(steps, dtype=np.uint64)


def prefix_hashes(data: np.ndarray) -> np.ndarray:
    """Sums from which `span_hashes` gets the hash of any span of `data`."""
    _grow(len(data) + 1)
    out = np.zeros(len(data) + 1, np.uint64)
    terms = data.astype(np.uint64)
    terms += np.uint64(1)
    terms *= _powers["up"][: len(data)]
    np.cumsum(terms, out=out[1:])
    return out


def span_hashes(prefix: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of the spans `data[begin:end]`, not yet mixed."""
    return (prefix[end] - prefix[begin]) * _powers["down"][begin]


# Bytes hashed at once, and the length from which a span gets a digest of its own.
_CHUNK_BYTES = 1 << 20
_LONG_BYTES = 1 << 16
# A Mersenne prime below 2^31 and a primitive root of it.
_PRIME = np.uint64((1 << 31) - 1)
_ROOT = 48271

_prime_powers: dict[str, np.ndarray] = {}


def _powers_mod_prime() -> tuple[np.ndarray, np.ndarray]:
    """Powers of the root up to a chunk's length, and their inverses."""
    if not _prime_powers:
        size = _CHUNK_BYTES + _LONG_BYTES + 1
        for name, base in (("up", _ROOT), ("down", pow(_ROOT, -1, int(_PRIME)))):
            powers = np.ones(1, np.uint64)
            while len(powers) < size:
                step = np.uint64(pow(base, len(powers), int(_PRIME)))
                powers = np.concatenate([powers, powers * step % _PRIME])
            _prime_powers[name] = powers[:size].copy()
    return _prime_powers["up"], _prime_powers["down"]


def hash_spans(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Mixed 64-bit hashes of ordered spans that don't overlap.

    Sums modulo 2^64 alone take some different long words for equal ones whatever their base
    (Thue-Morse sequences); sums modulo a prime, which do not, are mixed in. Long spans get a
    cryptographic digest instead. Memory follows the chunk, whatever the length of `data`.
    """
    out = np.empty(len(begin), np.uint64)
    length = end - begin
    for i in np.flatnonzero(length > _LONG_BYTES).tolist():
        raw = blake2b(data[begin[i] : end[i]], digest_size=8).digest()
        out[i] = np.frombuffer(raw, np.uint64)[0]
    short = length <= _LONG_BYTES
    begin, end, short = begin[short], end[short], np.flatnonzero(short)
    up, down = _powers_mod_prime()
    at = 0
    while at < len(short):
        base = int(begin[at])
        stop = int(np.searchsorted(begin, base + _CHUNK_BYTES))
        own = slice(at, stop)
        first, last = begin[own] - base, end[own] - base
        part = data[base : int(end[stop - 1])]
        raw = span_hashes(prefix_hashes(part), first, last)
        sums = np.zeros(len(part) + 1, np.uint64)
        # Below 2^63: a chunk's length times a byte times the prime.
        np.cumsum((part.astype(np.uint64) + np.uint64(1)) * up[: len(part)], out=sums[1:])
        other = (sums[last] - sums[first]) % _PRIME * down[first] % _PRIME
        out[short[own]] = chain(mix(raw), other + (last - first).astype(np.uint64) * _GOLDEN)
        at = stop
    return out


def spans_of(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begin and end of each run of true bytes, where no run crosses a text's end."""
    begins, ends = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    ends[:-1] &= ~inside[1:]
    edges = offsets[(offsets > 0) & (offsets < len(inside))]
    begins[edges] = inside[edges]
    ends[edges - 1] = inside[edges - 1]
    return np.flatnonzero(begins), np.flatnonzero(ends) + 1


# The bytes that separate words (space, and 09 to 0D).
_BLANK = np.zeros(256, bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True


def blank_words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begin and end of the words between ASCII white space."""
    return spans_of(~_BLANK[data], offsets)


def rows_of(positions: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The row of the slice that each byte position lies in."""
    return np.searchsorted(offsets, positions, "right") - 1


def ragged(values: np.ndarray, counts: np.ndarray, kind: pa.DataType) -> pa.Array:
    """A list column from flat values and the number of them in each row."""
    ends = np.zeros(len(counts) + 1, np.int32)
    np.cumsum(counts, out=ends[1:])
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(values, kind))
