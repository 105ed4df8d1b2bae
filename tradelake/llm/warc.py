"""Deterministic WARC archives: range-sorted records, files rolled by compressed size.

Records are sorted by page and dealt to range shards. Each task writes its shards' files record by
record (a gzip member each) under temporary names; headers and digests are made from the
payload at hand, dates and record names from parameters and content alone, so
that a second run gives the same bytes. A page whose payload repeats that of a page with a smaller
id becomes a revisit without payload.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator
from functools import partial
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradelake.llm import shards
from tradelake.llm.scratch import filesystem
from tradelake.sources import paths

# Payloads shorter than this are never revisits.
LEAST_REVISIT = 100
# Compressed bytes at which a file is closed, and payload bytes of a shard.
ROLL_BYTES = 64 << 20
SHARD_BYTES = 512 << 20
_LEAST_SHARD = 1 << 20

# Names from the WARC 1.1 format.
_VERSION = "WARC/1.1"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

DATE = "2000-01-01T00:00:00Z"
# Salt spread of one payload's pages over tasks when they look for their first page.
_SALTS = 16

_MANIFEST = (
    "shard int, part int, file string, temporary string, records long, bytes long, sha256 string"
)
_RECORDS = (
    "page_id long, url string, payload_bytes long, payload_digest string, record_type string, "
    "refers_to long, file string, payload binary"
)


# -- records


def _record_name(page_id: int | None, digest: str, copy: int) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_OID, f'{page_id}/{digest}/{copy}')}>"


def _clean(value: str) -> str:
    """A header value on one line."""
    return "".join(c if c.isprintable() else f"%{ord(c):02X}" for c in value)


def _member(headers: list[tuple[str, str]], block: bytes) -> bytes:
    """One record as a gzip member; its header has no time and no name."""
    lines = [_VERSION, *(f"{k}: {_clean(v)}" for k, v in headers), f"Content-Length: {len(block)}"]
    raw = "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(raw) + packer.flush()


def page_record(
    page_id: int | None, url: str | None, payload: bytes, copy: int, refers_to: int | None, date: str
) -> bytes:
    digest = sha256(payload).hexdigest()
    headers = [
        ("WARC-Type", "response" if refers_to is None else "revisit"),
        ("WARC-Record-ID", _record_name(page_id, digest, copy)),
        ("WARC-Date", date),
        ("WARC-Payload-Digest", f"sha256:{digest}"),
        ("X-Payload-Length", str(len(payload))),
    ]
    if url is not None:
        headers.append(("WARC-Target-URI", url))
    if page_id is not None:
        headers.append(("X-Page-ID", str(page_id)))
    if refers_to is not None:
        headers += [
            ("WARC-Profile", _PROFILE),
            ("WARC-Refers-To", _record_name(refers_to, digest, 0)),
            ("X-Refers-To-Page-ID", str(refers_to)),
        ]
        payload = b""
    headers += [
        ("WARC-Block-Digest", f"sha256:{sha256(payload).hexdigest()}"),
        ("Content-Type", "text/html"),
    ]
    return _member(headers, payload)


def _info_record(name: str, date: str) -> bytes:
    headers = [
        ("WARC-Type", "warcinfo"),
        ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_OID, name)}>"),
        ("WARC-Date", date),
        ("WARC-Filename", name),
        ("Content-Type", "application/warc-fields"),
    ]
    return _member(headers, b"format: WARC File Format 1.1\r\n")


# -- writing


class _Files:
    """The files of the shards that one task writes."""

    def __init__(self, folder: str, roll_bytes: int, date: str):
        self.folder, self.roll_bytes, self.date = folder, roll_bytes, date
        self.attempt = shards.attempt_name()
        self.shard, self.part, self.file = None, -1, None
        self.done: list[dict] = []

    def add(self, shard: int, record: bytes) -> None:
        if shard != self.shard:
            self.close()
            self.shard, self.part = shard, -1
        if self.file and self.file.size + len(record) > self.roll_bytes and self.records:
            self.close()
        if not self.file:
            self.part += 1
            name = f"pages-{shard:06d}-{self.part:04d}.warc.gz"
            self.file = shards.OutputFile(self.folder, name, self.attempt)
            self.records, self.hash = 0, sha256()
            self._write(_info_record(name, self.date))
        self._write(record)
        self.records += 1

    def _write(self, raw: bytes) -> None:
        self.file.write(raw)
        self.hash.update(raw)

    def close(self) -> None:
        if self.file:
            self.file.close()
            self.done.append(
                {
                    "shard": self.shard,
                    "part": self.part,
                    "file": self.file.final,
                    "temporary": self.file.temporary,
                    "records": self.records,
                    "bytes": self.file.size,
                    "sha256": self.hash.hexdigest(),
                }
            )
            self.file = None


def _write(
    batches: Iterator[pa.RecordBatch], folder: str, roll_bytes: int, date: str
) -> Iterator[pa.RecordBatch]:
    files = _Files(folder, roll_bytes, date)
    decided, refers_to, copy, last = None, None, 0, None
    for batch in batches:
        columns = {c: batch.column(c) for c in batch.schema.names}
        for i in range(batch.num_rows):
            page = columns["page_id"][i].as_py()
            own = (page, columns["digest"][i].as_py())
            if columns["kind"][i].as_py() == 0:
                decided, refers_to = own, columns["first"][i].as_py()
                continue
            copy = copy + 1 if own == last else 0
            last = own
            payload = columns["payload"][i].as_py() or b""
            target = refers_to if own == decided else None
            url = columns["url"][i].as_py()
            files.add(
                columns["shard"][i].as_py(), page_record(page, url, payload, copy, target, date)
            )
    files.close()
    if files.done:
        yield pa.RecordBatch.from_pylist(
            files.done,
            pa.schema(
                [
                    ("shard", pa.int32()),
                    ("part", pa.int32()),
                    ("file", pa.string()),
                    ("temporary", pa.string()),
                    ("records", pa.int64()),
                    ("bytes", pa.int64()),
                    ("sha256", pa.string()),
                ]
            ),
        )


def write_archives(
    pages: DataFrame,
    folder: str,
    id_column: str = "page_id",
    url_column: str = "url",
    payload_column: str = "html",
    least_revisit: int = LEAST_REVISIT,
    roll_bytes: int = ROLL_BYTES,
    date: str = DATE,
    shard_number: int | None = None,
) -> list:
    """Write a record for every row into a new folder; returns the manifest, a row for each file.

    Among rows with equal payloads of `least_revisit` bytes or more, those with the smallest id are
    responses, the others revisits of it. A null payload is empty; a null url has no header;
    null ids come first and are never revisited, so without any id a group is all responses.
    Repeated rows get a record each. An empty table gives an empty manifest. A record always goes
    to one file, however long it is.
    """
    spark = pages.sparkSession
    payload = F.coalesce(F.col(f"`{payload_column}`").cast("binary"), F.lit(b""))
    rows = pages.select(
        F.col(f"`{id_column}`").cast("long").alias("page_id"),
        F.col(f"`{url_column}`").cast("string").alias("url"),
        payload.alias("payload"),
    ).withColumn("digest", F.sha2("payload", 256))
    size = F.octet_length("payload").cast("long")

    long = rows.filter(size >= least_revisit).select("page_id", "digest")
    firsts = (
        long.groupBy("digest")
        .agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
        .filter("n > 1 and first is not null")
        .select("digest", "first", F.explode(F.sequence(F.lit(0), F.lit(_SALTS - 1))).alias("salt"))
    )
    # Rows that repeat an id and a payload, or a payload without id, share one decision.
    salted = long.distinct().withColumn("salt", F.pmod(F.xxhash64("page_id"), F.lit(_SALTS)).cast("int"))
    revisits = (
        salted.join(firsts, ["digest", "salt"])
        .filter("page_id is null or page_id != first")
        .select("page_id", "digest", "first")
    )

    if shard_number is None:
        total = rows.agg(F.sum(size)).first()[0] or 0
        shard_number = shards.shard_count(spark, total, SHARD_BYTES, _LEAST_SHARD)
    # Decisions ride along with the pages and sort just before them: one shuffle of payloads.
    merged = rows.select(
        "page_id", "digest", F.lit(1).alias("kind"), "url", "payload", F.lit(None).cast("long").alias("first")
    ).union(
        revisits.select(
            "page_id",
            "digest",
            F.lit(0),
            F.lit(None).cast("string"),
            F.lit(None).cast("binary"),
            "first",
        )
    )
    # In the order of digests, so that decisions and payloads of one id stay together when it is split.
    tie = F.conv(F.substring("digest", 1, 15), 16, 10).cast("long")
    merged = shards.with_shard(merged, "page_id", shard_number, rows, tie)
    ordered = shards.in_shards(merged, shard_number, "page_id", "digest", "kind", "url")
    written = ordered.mapInArrow(
        partial(_write, folder=folder, roll_bytes=roll_bytes, date=date), _MANIFEST
    )
    paths.make_dir(spark, folder)
    return shards.commit(written, folder)


# -- reading


def members(stream, chunk: int = 1 << 20) -> Iterator[bytes]:
    """The gzip members of a stream, unpacked; holds one of them and a chunk."""
    raw = stream.read(chunk)
    while raw:
        unpacker, parts = zlib.decompressobj(31), []
        while not unpacker.eof:
            if not raw:
                raise ValueError("an archive ends within a record")
            parts.append(unpacker.decompress(raw))
            raw = unpacker.unused_data if unpacker.eof else stream.read(chunk)
        raw = raw or stream.read(chunk)
        yield b"".join(parts)


def parse_record(raw: bytes) -> tuple[dict[str, str], bytes]:
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if lines[0] != _VERSION:
        raise ValueError(f"not a record: {lines[0][:40]}")
    headers = dict(line.split(": ", 1) for line in lines[1:])
    block = rest[: int(headers["Content-Length"])]
    if headers.get("WARC-Block-Digest", f"sha256:{sha256(block).hexdigest()}")[7:] != sha256(block).hexdigest():
        raise ValueError(f"wrong digest in {headers['WARC-Record-ID']}")
    return headers, block


def _read(row: dict, folder: str, payloads: bool) -> Iterator[pa.RecordBatch]:
    system, path = filesystem(f"{folder}/{row['file']}")
    kind = pa.schema(
        [
            ("page_id", pa.int64()),
            ("url", pa.string()),
            ("payload_bytes", pa.int64()),
            ("payload_digest", pa.string()),
            ("record_type", pa.string()),
            ("refers_to", pa.int64()),
            ("file", pa.string()),
            ("payload", pa.binary()),
        ]
    )
    number = lambda text: None if text is None else int(text)
    found, held, count = [], 0, 0
    with system.open_input_stream(path, compression=None) as stream:
        for raw in members(stream):
            headers, block = parse_record(raw)
            if headers["WARC-Type"] == "warcinfo":
                continue
            count += 1
            revisit = headers["WARC-Type"] == "revisit"
            found.append(
                {
                    "page_id": number(headers.get("X-Page-ID")),
                    "url": headers.get("WARC-Target-URI"),
                    "payload_bytes": int(headers["X-Payload-Length"]) if revisit else len(block),
                    "payload_digest": headers["WARC-Payload-Digest"][7:] if revisit else sha256(block).hexdigest(),
                    "record_type": headers["WARC-Type"],
                    "refers_to": number(headers.get("X-Refers-To-Page-ID")),
                    "file": row["file"],
                    "payload": block if payloads and not revisit else None,
                }
            )
            held += len(block)
            if held > 8 << 20 or len(found) >= 10_000:
                yield pa.RecordBatch.from_pylist(found, kind)
                found, held = [], 0
    if count != row["records"]:
        raise ValueError(f"{row['file']} has {count} records, the manifest says {row['records']}")
    if found:
        yield pa.RecordBatch.from_pylist(found, kind)


def read_archives(spark, folder: str, payloads: bool = True) -> DataFrame:
    """A row for each page record of a committed folder; digests are checked, revisits have no payload."""
    manifest = shards.manifest_of(spark, folder, _MANIFEST)
    files = shards.each_file(manifest.collect(), spark, manifest.schema)
    return shards.read_files(files, _read, _RECORDS, folder=folder, payloads=payloads)
