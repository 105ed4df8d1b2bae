"""Token-id files in document order, with a minimal perfect hash index for access by key.

A shard file holds the ids of a range of documents, then a directory (document ids, and where each
one's ids begin), then a trailer:

    ids (unsigned 16 or 32 bits, little-endian) | document ids (int64) | known (uint8)
    | begins (uint64, one more than documents) | documents (uint64) | id width (uint64) | b"TOKIDS01"

The index is a table of buckets, found by a hash of the key. A bucket is a minimal perfect hash of
its keys whose slots store a fingerprint, the shard, the row in its directory, and how many rows
share the key. A lookup reads one slot, whatever the number of documents.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import lru_cache, partial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tradelake.llm import perfect_hash, shards
from tradelake.llm import textbytes as tb
from tradelake.llm.scratch import filesystem
from tradelake.sources import paths

MAGIC = b"TOKIDS01"
END_ID = 0
# Text bytes of a shard, and keys of an index bucket.
SHARD_BYTES = 512 << 20
_LEAST_SHARD = 1 << 20
BUCKET_KEYS = 4096
# Distinct pieces of text whose ids a task remembers.
REMEMBERED = 1 << 19

_NO_KEY = -(1 << 63)
_MANIFEST = (
    "shard int, part int, file string, temporary string, documents long, ids long, bytes long"
)


# -- tokenizing

# White space that takes more than a look at single bytes; texts with any of these
# bytes, or with an added token such as <|endoftext|>, are tokenized in one piece.
_ODD = np.zeros(256, bool)
_ODD[[0x0B, 0x0C, 0x0D, 0x1C, 0x1D, 0x1E, 0x1F, 0xC2, 0xE1, 0xE2, 0xE3]] = True
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x0A, 0x09]] = True
_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123)]] = True
_MARK = np.zeros(256, bool)
_MARK[[*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = True


class PieceTokenizer:
    """The tokenizers library behind a memory of pieces.

    Texts are split where no token and no match of the library's splitting pattern can span: before
    white space that follows another character, and between an ASCII letter and an ASCII mark.
    A piece has the same ids wherever it stands, so each distinct one is tokenized once.
    """

    def __init__(self, path: str):
        self._library = Tokenizer.from_file(path)
        added = self._library.get_added_tokens_decoder().values()
        self._added = [t.content.encode() for t in added if t.content]
        vocabulary = self._library.get_vocab()
        self.dtype = np.dtype("<u2" if max(vocabulary.values()) < 1 << 16 else "<u4")
        # Each character of a byte-level token is one byte.
        self._sizes = np.zeros(max(vocabulary.values()) + 1, np.int64)
        for token, number in vocabulary.items():
            self._sizes[number] = len(token)
        self._forget()

    def _forget(self) -> None:
        self._known: dict[int, int] = {}
        self._begins, self._counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self._ids = np.zeros(0, self.dtype)

    def _whole(self, texts: list[bytes]) -> list[np.ndarray]:
        found = self._library.encode_batch_fast(
            [t.decode("utf-8", "replace") for t in texts], add_special_tokens=False
        )
        return [np.array(e.ids, self.dtype) for e in found]

    def _learn(self, hashes: list[int], pieces: list[bytes]) -> None:
        """Tokenize new pieces; those that may follow each other directly, as one text."""
        runs = [i for i, p in enumerate(pieces) if _SPACE[p[0]] and not _SPACE[p[-1]]]
        rest = sorted(set(range(len(pieces))).difference(runs))
        ids: list[np.ndarray] = [None] * len(pieces)
        text = b"".join(pieces[i] for i in runs)
        if any(token in text for token in self._added):
            # No piece has an added token of its own, but pieces of other texts may make up one.
            runs, rest = [], range(len(pieces))
        if runs:
            (joined,) = self._whole([text])
            ends = np.cumsum(self._sizes[joined])
            cuts = np.searchsorted(ends, np.cumsum([len(pieces[i]) for i in runs]), "left") + 1
            for i, own in zip(runs, np.split(joined, cuts[:-1])):
                ids[i] = own
        for i, own in zip(rest, self._whole([pieces[i] for i in rest])):
            ids[i] = own
        counts = np.array([len(x) for x in ids])
        begins = len(self._ids) + np.cumsum(counts) - counts
        self._known.update(zip(hashes, range(len(self._begins), len(self._begins) + len(ids))))
        self._begins = np.concatenate([self._begins, begins])
        self._counts = np.concatenate([self._counts, counts])
        self._ids = np.concatenate([self._ids, *ids])

    def _quoting(self, raw: bytes, offsets: np.ndarray) -> set[int]:
        """Rows whose text contains an added token."""
        rows = set()
        for token in self._added:
            at = raw.find(token)
            while at >= 0:
                row = int(np.searchsorted(offsets, at, "right")) - 1
                if at + len(token) <= offsets[row + 1]:
                    rows.add(row)
                    at = raw.find(token, int(offsets[row + 1]))
                else:
                    at = raw.find(token, at + 1)
        return rows

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids of a slice of texts, and the number of ids of each."""
        rows = len(offsets) - 1
        raw = data.tobytes()
        odd = np.zeros(len(data) + 1, np.int64)
        np.cumsum(_ODD[data], out=odd[1:])
        odd_rows = np.flatnonzero(odd[offsets[1:]] > odd[offsets[:-1]])
        odd_rows = np.array(sorted(self._quoting(raw, offsets).union(odd_rows.tolist())), np.int64)
        first = np.zeros(len(data), bool)
        first[1:] = (_SPACE[data[1:]] & ~_SPACE[data[:-1]]) | (_MARK[data[1:]] & _LETTER[data[:-1]])
        first[offsets[:-1][np.diff(offsets) > 0]] = True
        begin = np.flatnonzero(first)
        end = np.append(begin[1:], len(data))
        row = tb.rows_of(begin, offsets)
        if len(odd_rows):
            plain = ~np.isin(row, odd_rows)
            begin, end, row = begin[plain], end[plain], row[plain]
        hashes = tb.mix(tb.span_hashes(tb.prefix_hashes(data), begin, end))
        code, distinct = pd.factorize(hashes)
        if len(self._known) > REMEMBERED:
            self._forget()
        known = list(map(self._known.get, distinct.tolist()))
        if None in known:
            at = np.empty(len(distinct), np.int64)
            at[code[::-1]] = np.arange(len(code))[::-1]
            new = [i for i, k in enumerate(known) if k is None]
            spans = zip(begin[at[new]].tolist(), end[at[new]].tolist())
            self._learn(distinct[new].tolist(), [raw[b:e] for b, e in spans])
            known = list(map(self._known.get, distinct.tolist()))
        slot = np.array(known, np.int64)[code]
        counts = self._counts[slot]
        ends = np.cumsum(counts)
        source = np.repeat(self._begins[slot] - (ends - counts), counts)
        ids = self._ids[source + np.arange(len(source))]
        per_row = np.bincount(row, weights=counts, minlength=rows).astype(np.int64)
        if not len(odd_rows):
            return ids, per_row
        whole = [raw[offsets[i] : offsets[i + 1]] for i in odd_rows]
        parts = np.split(ids, np.cumsum(per_row)[:-1])
        for i, own in zip(odd_rows, self._whole(whole)):
            parts[i] = own
        return np.concatenate(parts), np.array([len(p) for p in parts])


@lru_cache(maxsize=2)
def piece_tokenizer(path: str) -> PieceTokenizer:
    return PieceTokenizer(path)


# -- writing


class _ShardFile:
    def __init__(self, folder: str, shard: int, attempt: str, dtype: np.dtype):
        self.shard, self.dtype = shard, dtype
        self.file = shards.OutputFile(folder, f"tokens-{shard:06d}.bin", attempt)
        self.keys, self.known, self.counts = [], [], []

    def add(self, ids: np.ndarray, counts: np.ndarray, keys: np.ndarray, known: np.ndarray) -> None:
        self.file.write(ids.astype(self.dtype, copy=False).tobytes())
        self.keys.append(keys)
        self.known.append(known)
        self.counts.append(counts)

    def close(self) -> dict:
        counts = np.concatenate(self.counts)
        begins = np.concatenate([[0], np.cumsum(counts)]).astype("<u8")
        self.file.write(np.concatenate(self.keys).astype("<i8").tobytes())
        self.file.write(np.concatenate(self.known).astype("u1").tobytes())
        self.file.write(begins.tobytes())
        self.file.write(np.array([len(counts), self.dtype.itemsize], "<u8").tobytes() + MAGIC)
        self.file.close()
        return {
            "shard": self.shard,
            "part": 0,
            "file": self.file.final,
            "temporary": self.file.temporary,
            "documents": len(counts),
            "ids": int(begins[-1]),
            "bytes": self.file.size,
        }


def _with_end(ids: np.ndarray, counts: np.ndarray, end_id: int) -> np.ndarray:
    return np.insert(ids, np.cumsum(counts), end_id)


def _write(
    batches: Iterator[pa.RecordBatch], folder: str, tokenizer: str, end_id: int
) -> Iterator[pa.RecordBatch]:
    own = piece_tokenizer(tokenizer)
    attempt, file, done = shards.attempt_name(), None, []
    for batch in batches:
        shard = batch.column("shard").to_numpy(zero_copy_only=False)
        column = batch.column("id")
        known = column.is_valid().to_numpy(zero_copy_only=False)
        keys = column.fill_null(_NO_KEY).to_numpy(zero_copy_only=False)
        for first, last, data, offsets in tb.text_slices(batch.column("text")):
            ids, counts = own.encode(data, offsets)
            ids, counts = _with_end(ids, counts, end_id), counts + 1
            ends = np.concatenate([[0], np.cumsum(counts)])
            part = shard[first:last]
            cuts = np.flatnonzero(np.diff(part)) + 1
            for low, high in zip([0, *cuts], [*cuts, len(part)]):
                if file is None or file.shard != part[low]:
                    if file:
                        done.append(file.close())
                    file = _ShardFile(folder, int(part[low]), attempt, own.dtype)
                rows = slice(first + low, first + high)
                file.add(ids[ends[low] : ends[high]], counts[low:high], keys[rows], known[rows])
    if file:
        done.append(file.close())
    if done:
        yield pa.RecordBatch.from_pylist(
            done,
            pa.schema(
                [("shard", pa.int32()), ("part", pa.int32()), ("file", pa.string()), ("temporary", pa.string())]
                + [(n, pa.int64()) for n in ("documents", "ids", "bytes")]
            ),
        )


def write_tokens(
    docs: DataFrame,
    folder: str,
    tokenizer_path: str,
    id_column: str = "doc_id",
    text_column: str = "text",
    end_id: int = END_ID,
    shard_number: int | None = None,
) -> None:
    """Encode every text and write its ids, in ascending order of ids, into a new folder.

    Each text's ids are those of the tokenizers library without special tokens, then `end_id`. Null
    and empty texts have the end id only. Null ids come first; rows that share an id stand
    together, in order of their text, and share an index entry. An empty table gives no files.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col(f"`{text_column}`").cast("string"), F.lit(""))
    rows = docs.select(F.col(f"`{id_column}`").cast("long").alias("id"), text.alias("text"))
    if shard_number is None:
        total = rows.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
        shard_number = shards.shard_count(spark, total, SHARD_BYTES, _LEAST_SHARD)
    ordered = shards.in_shards(shards.with_shard(rows, "id", shard_number), shard_number, "id", "text")
    paths.make_dir(spark, folder)
    written = ordered.mapInArrow(
        partial(_write, folder=folder, tokenizer=tokenizer_path, end_id=end_id), _MANIFEST
    )
    manifest = shards.commit(written, folder)
    _build_index(spark, folder, manifest)


# -- reading files


def _directory(stream, size: int):
    """(keys, known, begins, id type) of an open shard file."""
    stream.seek(size - 24)
    trailer = stream.read(24)
    if trailer[16:] != MAGIC:
        raise ValueError("not a token file, or not a whole one")
    documents, width = (int(x) for x in np.frombuffer(trailer[:16], "<u8"))
    stream.seek(size - 24 - 17 * documents - 8)
    keys = np.frombuffer(stream.read(8 * documents), "<i8")
    known = np.frombuffer(stream.read(documents), "u1").astype(bool)
    begins = np.frombuffer(stream.read(8 * (documents + 1)), "<u8").astype(np.int64)
    return keys, known, begins, np.dtype(f"<u{width}")


def _bucket(keys: np.ndarray, buckets: int) -> np.ndarray:
    return (tb.mix(keys.astype(np.int64).view(np.uint64)) % np.uint64(buckets)).astype(np.int32)


def _keys_of(row: dict, folder: str, buckets: int) -> Iterator[pa.RecordBatch]:
    """The distinct keys of a shard, with the first row and the number of rows of each."""
    system, path = filesystem(f"{folder}/{row['file']}")
    with system.open_input_file(path) as stream:
        keys = _directory(stream, row["bytes"])[0]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    count = np.diff(np.append(first, len(keys)))
    own = keys[first]
    yield pa.RecordBatch.from_arrays(
        [
            pa.array(_bucket(own, buckets)),
            pa.array(own),
            pa.array(np.full(len(own), row["shard"], np.int32)),
            pa.array(first.astype(np.int64)),
            pa.array(count.astype(np.int64)),
        ],
        ["bucket", "key", "shard", "row", "rows"],
    )


def _index_bucket(rows: pd.DataFrame) -> pd.DataFrame:
    made = perfect_hash.build(rows["key"].to_numpy(np.int64).view(np.uint64))
    slot = made.slots(rows["key"].to_numpy(np.int64).view(np.uint64))
    at = np.argsort(slot)
    values = {c: rows[c].to_numpy(np.int64)[at].astype("<i8").tobytes() for c in ("shard", "row", "rows")}
    return pd.DataFrame(
        [
            {
                "bucket": int(rows["bucket"].iloc[0]),
                "displace": made.displace.astype("<i8").tobytes(),
                "prints": made.prints.astype("<u4").tobytes(),
                **values,
            }
        ]
    )


_INDEX = "bucket int, displace binary, prints binary, shard binary, row binary, rows binary"


def _build_index(spark: SparkSession, folder: str, manifest: list) -> None:
    buckets = _buckets(manifest)
    schema = shards.manifest_of(spark, folder, _MANIFEST).schema
    files = shards.each_file(manifest, spark, schema)
    keys = shards.read_files(
        files, _keys_of, "bucket int, key long, shard int, row long, rows long", folder=folder, buckets=buckets
    )
    index = keys.groupBy("bucket").applyInPandas(_index_bucket, _INDEX)
    index.write.parquet(f"{folder}/_index")


def _buckets(manifest: list) -> int:
    return max(1, -(-sum(r.documents for r in manifest) // BUCKET_KEYS))


def _find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Look keys up in their buckets: one slot each, proved by its fingerprint."""
    for batch in batches:
        for bucket in batch.to_pylist():
            keys = np.array(bucket["keys"], np.int64)
            index = perfect_hash.PerfectHash(
                np.frombuffer(bucket["displace"], "<i8"), np.frombuffer(bucket["prints"], "<u4")
            )
            slot = index.slots(keys.view(np.uint64))
            hit = slot >= 0
            values = [
                np.frombuffer(bucket[c], "<i8")[slot[hit]] for c in ("shard", "row", "rows")
            ]
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys[hit]), pa.array(values[0].astype(np.int32)), *map(pa.array, values[1:])],
                ["key", "shard", "row", "rows"],
            )


def _fetch(batches: Iterator[pa.RecordBatch], folder: str, payloads: bool) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for shard in batch.to_pylist():
            system, path = filesystem(f"{folder}/{shard['file']}")
            with system.open_input_file(path) as stream:
                keys, known, begins, dtype = _directory(stream, shard["bytes"])
                rows = np.concatenate(
                    [np.arange(p["row"], p["row"] + p["rows"]) for p in shard["places"] if keys[p["row"]] == p["key"]]
                    or [np.zeros(0, np.int64)]
                )
                rows.sort()
                for low in range(0, len(rows), 2048):
                    part = rows[low : low + 2048]
                    crcs, raws = [], []
                    for r in part.tolist():
                        stream.seek(int(begins[r]) * dtype.itemsize)
                        ids = np.frombuffer(stream.read(int(begins[r + 1] - begins[r]) * dtype.itemsize), dtype)
                        raw = ids.astype("<u4").tobytes()
                        crcs.append(zlib.crc32(raw))
                        raws.append(raw if payloads else None)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(keys[part], mask=~known[part]),
                            pa.array(begins[part] + shard["base"]),
                            pa.array(begins[part + 1] - begins[part]),
                            pa.array(crcs, pa.int64()),
                            pa.array(raws, pa.binary()),
                        ],
                        ["doc_id", "start", "n_tokens", "ids_crc32", "ids"],
                    )


def read_tokens(
    spark: SparkSession,
    folder: str,
    keys: DataFrame,
    key_column: str = "doc_id",
    payloads: bool = True,
) -> DataFrame:
    """The documents of the given keys, found through the index and read from the shard files.

    Returns `doc_id`, `start` (ids of all documents before it), `n_tokens` (with the end id),
    `ids_crc32` and, unless not asked for, `ids` (little-endian unsigned 32-bit integers). Unknown keys
    give no row; repeated ones count once; a null key finds the rows with a null id.
    """
    manifest = shards.manifest_of(spark, folder, _MANIFEST)
    files = manifest.orderBy("shard").collect()
    buckets, base, based = _buckets(files), 0, []
    for f in files:
        based.append((f.shard, f.file, f.bytes, base))
        base += f.ids
    places = spark.createDataFrame(based, "shard int, file string, bytes long, base long")

    @F.pandas_udf("int")
    def bucket_of(values: pd.Series) -> pd.Series:
        return pd.Series(_bucket(values.to_numpy(np.int64), buckets))

    key = F.coalesce(F.col(f"`{key_column}`").cast("long"), F.lit(_NO_KEY))
    wanted = keys.select(key.alias("key")).distinct().withColumn("bucket", bucket_of("key"))
    # A bucket has about BUCKET_KEYS keys, so the lists are short.
    wanted = wanted.groupBy("bucket").agg(F.collect_list("key").alias("keys"))
    index = spark.read.schema(_INDEX).parquet(f"{folder}/_index")
    found = wanted.join(index, "bucket").mapInArrow(_find, "key long, shard int, row long, rows long")
    # A shard has a bounded size; its list is at most its directory.
    by_shard = found.groupBy("shard").agg(F.collect_list(F.struct("key", "row", "rows")).alias("places"))
    return by_shard.join(places, "shard").mapInArrow(
        partial(_fetch, folder=folder, payloads=payloads),
        "doc_id long, start long, n_tokens long, ids_crc32 long, ids binary",
    )
