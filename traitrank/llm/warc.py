"""WARC archives: a deterministic, sharded writer and a reader.

Records are sorted by id and dealt into shards of equal counts, whose bounds are exact positions
in that order. The task that has a shard writes it record by record, each a gzip member, and
rolls to the next file before one would pass ``roll_bytes`` of compressed data. Headers and
digests are made anew from the payload; names, record ids and dates follow from the input, so the
same input gives the same bytes. A file is written under a temporary name with the attempt in
it and renamed when complete; only files that the manifest names belong to the archive, and the
manifest is written last, by Spark's own commit. A lost task is written again under the same
names.

Files go through ``pyarrow.fs``, so the folder may lie in any store that it reaches, under the name
that Spark has for it.
"""

from __future__ import annotations

import hashlib
import posixpath
import re
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from traitrank.llm.common import SMALL_BYTES
from traitrank.operators.joins import Size, lookup_join
from traitrank.operators.ordering import ranged_positions
from traitrank.sources.paged import file_system
from traitrank.sources.staging import Staging

# Payloads below this are always written in full.
REVISIT_BYTES = 100
SHARD_RECORDS = 4096
ROLL_BYTES = 64 << 20
LEVEL = 4
DATE = "2020-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_NAMES = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")  # fixed: the namespace of URLs
_UNSAFE = re.compile(r"[\x00-\x20\x7f]")
_CHUNK = 1 << 20
_ROWS = 256


def record_id(key: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(_NAMES, f'page:{key}:{digest}')}>"


def record(key: int | None, url: str | None, payload: bytes, original: int | None, date: str = DATE) -> bytes:
    """One WARC record. ``original`` is the id whose response holds an equal payload."""
    digest = hashlib.sha256(payload).hexdigest()
    target = _UNSAFE.sub(lambda m: "%%%02X" % ord(m[0]), url or "") or f"urn:page:{key}"
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if original is not None else http + payload
    fields = [
        ("WARC-Type", "response" if original is None else "revisit"),
        ("WARC-Record-ID", record_id(key, digest)),
        ("WARC-Date", date),
        ("WARC-Target-URI", target),
        ("WARC-Payload-Digest", f"sha256:{digest}"),
        ("WARC-Block-Digest", f"sha256:{hashlib.sha256(block).hexdigest()}"),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    if key is not None:
        fields.append(("X-Page-Id", str(key)))
    if original is not None:
        fields += [
            ("WARC-Profile", PROFILE), ("WARC-Refers-To", record_id(original, digest)), ("X-Refers-To-Page-Id", str(original)),
        ]
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n"
    return head.encode() + block + b"\r\n\r\n"


def parse(data: bytes) -> dict:
    """Fields of one record and its payload; wrong lengths and digests raise ``ValueError``."""
    head, _, rest = data.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    fields = dict(line.split(": ", 1) for line in lines)
    block = rest[: int(fields["Content-Length"])]
    if version != "WARC/1.1" or rest[len(block) :] != b"\r\n\r\n":
        raise ValueError("broken WARC record")
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(re.search(rb"(?m)^Content-Length: (\d+)", http)[1])
    digest = fields["WARC-Payload-Digest"].removeprefix("sha256:")
    if fields["WARC-Block-Digest"] != f"sha256:{hashlib.sha256(block).hexdigest()}":
        raise ValueError("block digest differs")
    if fields["WARC-Type"] == "response" and (len(payload) != size or hashlib.sha256(payload).hexdigest() != digest):
        raise ValueError("payload digest differs")
    whole = fields["WARC-Type"] == "response"
    number = lambda name: int(fields[name]) if name in fields else None
    return {
        "page_id": number("X-Page-Id"), "url": fields["WARC-Target-URI"], "record_type": fields["WARC-Type"],
        "payload_bytes": size, "payload_digest": digest, "refers_to": number("X-Refers-To-Page-Id"),
        "payload": payload if whole else None,
    }


_MANIFEST = pa.schema([
    ("file", pa.string()), ("records", pa.int64()), ("bytes", pa.int64()), ("sha256", pa.string()),
])


class _Roller:
    """Writes the files of one shard after another."""

    def __init__(self, folder: str, roll_bytes: int):
        self.store, self.folder = file_system(folder)
        self.roll_bytes, self.shard, self.file = roll_bytes, None, None
        context = TaskContext.get()
        self.attempt = f"{context.taskAttemptId()}-{uuid.uuid4().hex[:8]}"
        self.store.create_dir(self.folder, recursive=True)

    def add(self, shard: int, member: bytes) -> Iterator[tuple]:
        if shard != self.shard:
            yield from self.close()
            self.shard, self.n_files = shard, 0
        elif self.file and self.size + len(member) > self.roll_bytes:
            yield from self.close()
        if not self.file:
            self.name = f"{self.shard:07d}-{self.n_files:05d}.warc.gz"
            self.temporary = posixpath.join(self.folder, f".{self.name}.{self.attempt}")
            self.file = self.store.open_output_stream(self.temporary, compression=None)
            self.size, self.records, self.sum = 0, 0, hashlib.sha256()
        self.file.write(member)
        self.size, self.records = self.size + len(member), self.records + 1
        self.sum.update(member)

    def close(self) -> Iterator[tuple]:
        if not self.file:
            return
        self.file.close()
        final = posixpath.join(self.folder, self.name)
        if self.store.get_file_info(final).type != fs.FileType.NotFound:
            self.store.delete_file(final)  # the same bytes, left by an attempt that was lost
        self.store.move(self.temporary, final)
        yield self.name, self.records, self.size, self.sum.hexdigest()
        self.file, self.n_files = None, self.n_files + 1


def _writer(folder: str, roll_bytes: int, level: int, date: str):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        roller, done = None, []
        for batch in batches:
            roller = roller or _Roller(folder, roll_bytes)
            for shard, key, url, html, original in zip(*batch.columns):
                payload = html.as_buffer().to_pybytes() if html.is_valid else b""
                squeeze = zlib.compressobj(level, zlib.DEFLATED, 31)
                plain = record(key.as_py(), url.as_py(), payload, original.as_py(), date)
                done += roller.add(shard.as_py(), squeeze.compress(plain) + squeeze.flush())
        if roller:
            done += roller.close()
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*done), _MANIFEST)], schema=_MANIFEST)

    return write


def write_archives(
    pages: DataFrame,
    folder: str,
    staging: Staging,
    *,
    key: str = "page_id",
    url: str = "url",
    html: str = "html",
    shard_records: int = SHARD_RECORDS,
    roll_bytes: int = ROLL_BYTES,
    level: int = LEVEL,
    date: str = DATE,
) -> DataFrame:
    """Writes one record per row and returns the written manifest (file, records, bytes, sha256).

    Of rows with equal payloads of at least ``REVISIT_BYTES`` those with the smallest id are
    responses and the others revisit it. Null texts are empty payloads, null URLs become URNs.
    Rows without id come first and are always responses. Rows that repeat an id are records each.
    An empty table gives an empty manifest; further columns are not written. The bounds of the
    shards on the driver are one number per ``shard_records`` rows.
    """
    plain = pages.select(
        F.col(key).cast("long").alias("page_id"), F.col(url).alias("url"), F.col(html).alias("html"),
        F.sha2(F.coalesce(F.col(html), F.lit("")), 256).alias("digest"),
    )
    narrow = staging.write(
        plain.select("page_id", "digest", F.coalesce(F.octet_length("html"), F.lit(0)).alias("bytes")), "digests"
    )
    equal = staging.write(
        narrow.filter(F.col("page_id").isNotNull() & (F.col("bytes") >= REVISIT_BYTES))
        .groupBy("digest").agg(F.min("page_id").alias("first_id"), F.max("page_id").alias("last_id"))
        .filter("last_id > first_id").drop("last_id"),
        "equal_payloads",
    )
    placed = ranged_positions(narrow.filter("page_id IS NOT NULL").select("page_id"), [], [F.col("page_id")], "at", staging)
    bounds = np.array(sorted(r[0] for r in placed.filter((F.col("at") - 1) % shard_records == 0).select("page_id").collect()), np.int64)

    @F.arrow_udf("long")
    def shard(keys: pa.Array) -> pa.Array:
        at = np.searchsorted(bounds, keys.fill_null(-(1 << 63)).to_numpy(zero_copy_only=False), side="right") - 1
        return pa.array(np.maximum(at, 0))

    n = equal.count()
    size = Size(rows=n, bytes=160 * n if 160 * n <= SMALL_BYTES else 1 << 62)
    met = lookup_join(plain, equal, ["digest"], how="left", spread=["page_id"], size=size)
    original = F.when(F.col("page_id") > F.col("first_id"), F.col("first_id"))
    dealt = (
        met.select(shard(F.col("page_id")).alias("shard"), "page_id", "url", "html", original.alias("original"))
        .repartitionByRange(max(1, min(len(bounds), 100_000)), "shard")
        .sortWithinPartitions("shard", "page_id", F.xxhash64("url", "html"), "url", "html")
    )
    written = dealt.mapInArrow(_writer(folder, roll_bytes, level, date), "file string, records long, bytes long, sha256 string")
    return staging.write(written, "manifest")


def _reader(folder: str):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = file_system(folder)
        for batch in batches:
            for name, expected in zip(batch.column("file").to_pylist(), batch.column("sha256").to_pylist()):
                seen, rows = hashlib.sha256(), []
                for data in _members(store, posixpath.join(root, name), seen):
                    rows.append(parse(data))
                    if len(rows) == _ROWS:
                        yield pa.RecordBatch.from_pylist(rows, schema=_READ)
                        rows = []
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema=_READ)
                if seen.hexdigest() != expected:
                    raise ValueError(f"{name} is not the file of the manifest")

    return read


_READ = pa.schema([
    ("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("payload_bytes", pa.int64()),
    ("payload_digest", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary()),
])
_READ_SQL = "page_id long, url string, record_type string, payload_bytes long, payload_digest string, refers_to long, payload binary"


def _members(store, path: str, seen) -> Iterator[bytes]:
    """Unpacked gzip members of a file, one record each; a record at a time is in memory."""
    with store.open_input_stream(path, compression=None) as file:
        unpack, parts, pending = zlib.decompressobj(31), [], b""
        while True:
            if not pending:
                pending = file.read(_CHUNK)
                seen.update(pending)
                if not pending:
                    break
            parts.append(unpack.decompress(pending))
            pending = b""
            if unpack.eof:
                yield b"".join(parts)
                pending = unpack.unused_data
                unpack, parts = zlib.decompressobj(31), []
        if parts and any(parts):
            raise ValueError(f"{path} ends within a record")


def read_archives(manifest: DataFrame, folder: str) -> DataFrame:
    """Records of the manifest's files, each checked: (page_id, url, record_type, payload_bytes,
    payload_digest, refers_to, payload). A revisit has the size and digest of the full payload and
    no payload."""
    files = max(1, manifest.count())
    return manifest.repartition(files, "file").mapInArrow(_reader(folder), _READ_SQL)
