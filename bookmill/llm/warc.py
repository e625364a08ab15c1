"""WARC archives compressed record by record against a dictionary that each archive carries.

An archive (.warc.zst) is a skippable Zstandard frame that holds the dictionary, then one frame
per record, so any record can be read alone. The dictionary is trained on a bounded sample of the
pages to archive. Of the pages with one payload of at least `least` bytes, that with the largest
id is a response record; the others are revisit records that refer to it and hold only headers.

The revisit decision moves ids and digests only. Pages that have none are written where they
are read; only those that may be revisits (a bounded set of hashes tells) are dealt out. Writers make archives of bounded size in the shared folder, each under a name of its
task attempt; the manifest lists those of the attempts that count. Null html is an empty payload.
A null url is written as a name made from the id. A page without id is always a response, and so
is each of repeated rows of the largest id.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator, Sequence
from urllib.parse import quote

import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from . import _store
from ._marks import marked, marks
from ._worker import arrow_map

_SKIPPABLE = 0x184D2A5D
_DATE = "1970-01-01T00:00:00Z"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def revisits(pages: DataFrame, *, least: int) -> DataFrame:
    """(page_id, key, refers_to) of the pages whose payload another page's response record holds. Columns of pages: page_id, key, size."""
    own = pages.where(F.col("page_id").isNotNull() & (F.col("size") >= least)).select("page_id", "key")
    kept = (
        own.groupBy("key").agg(F.max("page_id").alias("refers_to"), F.min("page_id").alias("other"))
        .where("other < refers_to").select("key", "refers_to")
    )
    return own.join(kept, "key").where("page_id < refers_to").distinct()


def train_dictionary(samples: Sequence[bytes], size: int) -> bytes:
    """A Zstandard dictionary, or nothing where the samples are too few to train one."""
    samples = [s for s in samples if s]
    total = sum(map(len, samples))
    if len(samples) < 8 or total < 4096:
        return b""
    try:
        return zstandard.train_dictionary(min(size, max(1024, total // 8)), samples).as_bytes()
    except zstandard.ZstdError:
        return b""


def dictionary_frame(dictionary: bytes) -> bytes:
    body = zstandard.ZstdCompressor(level=10).compress(dictionary)
    return struct.pack("<II", _SKIPPABLE, len(body)) + body


def _record(fields: list[tuple[str, str]], block: bytes) -> bytes:
    head = "".join(f"{k}: {v}\r\n" for k, v in [*fields, ("Content-Length", str(len(block)))])
    return b"WARC/1.1\r\n" + head.encode() + b"\r\n" + block + b"\r\n\r\n"


def _name(page_id: int | None) -> str:
    return f"<urn:x-page:{page_id}>" if page_id is not None else f"<urn:uuid:{uuid.uuid4()}>"


def page_record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """The response record of a page, or with refers_to its revisit record."""
    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    uri = quote(url, safe="%/:=&?~#+!$,;'@()*[]") if url else f"urn:x-page:{page_id}"
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    kind = "response" if refers_to is None else "revisit"
    fields = [
        ("WARC-Type", kind), ("WARC-Record-ID", _name(page_id)), ("WARC-Date", _DATE), ("WARC-Target-URI", uri),
        ("WARC-Payload-Digest", f"sha1:{digest}"), ("Content-Type", "application/http;msgtype=response")
    ]
    if refers_to is not None:
        fields += [("WARC-Profile", _PROFILE), ("WARC-Refers-To", _name(refers_to))]
    return _record(fields, http if refers_to is not None else http + payload)


_MANIFEST = pa.schema([("path", pa.string()), ("records", pa.int64()), ("bytes", pa.int64())])


def _write(folder: str, dictionary: bytes, level: int, archive_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        data = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        z = zstandard.ZstdCompressor(level=level, dict_data=data)
        start = [dictionary_frame(dictionary)] if dictionary else []
        start.append(
            z.compress(
                _record(
                    [
                        ("WARC-Type", "warcinfo"), ("WARC-Record-ID", _name(None)), ("WARC-Date", _DATE),
                        ("Content-Type", "application/warc-fields")
                    ],
                    b"format: WARC File Format 1.1\r\n"
                )
            )
        )
        frames, size, n, files = list(start), 0, 0, 0

        def close() -> pa.RecordBatch:
            nonlocal frames, size, n, files
            path = f"{folder}/pages-{task.partitionId():06d}-{task.taskAttemptId()}-{files:05d}.warc.zst"
            _store.write(path, frames)
            out = pa.RecordBatch.from_pydict({"path": [path], "records": [n], "bytes": [sum(map(len, frames))]}, schema=_MANIFEST)
            frames, size, n, files = list(start), 0, 0, files + 1
            return out

        for b in batches:
            for page_id, url, payload, refers_to in zip(*(b.column(k).to_pylist() for k in range(4)), strict=True):
                frames.append(z.compress(page_record(page_id, url, payload, refers_to)))
                size, n = size + len(frames[-1]), n + 1
                if size >= archive_bytes:
                    yield close()
        if n:
            yield close()

    return run


def _sampled(rows: DataFrame, most: int) -> DataFrame:
    """`most` rows (all, if fewer), by a hash of id and payload. Only about four times as many are sorted, so few leave their tasks."""
    n, whole = rows.count(), 1 << 30
    h = F.xxhash64("page_id", "payload")
    few = rows.select("*", h.alias("h")).where(F.pmod("h", F.lit(whole)) < whole * min(1.0, 4 * most / max(n, 1)))
    return few.orderBy(F.pmod("h", F.lit(whole)), "h", "page_id").limit(most)


def write_archives(
    pages: DataFrame, *, page_id: str = "page_id", url: str = "url", html: str = "html", least: int = 1000, level: int = 3,
    dictionary_bytes: int = 64 << 10, samples: int = 256, sample_bytes: int = 16 << 10, archive_bytes: int = 32 << 20,
) -> DataFrame:
    """Archive every page; the manifest: path, records, bytes. The dictionary sees about `samples` pages, `sample_bytes` of each at most."""
    spark = pages.sparkSession
    payload = F.coalesce(F.col(html), F.lit("")).cast("binary")
    rows = pages.select(F.col(page_id).cast("long").alias("page_id"), F.col(url).alias("url"), payload.alias("payload"))
    taken = _sampled(rows, samples).select("page_id", "url", F.substring("payload", 1, sample_bytes).alias("p")).collect()
    dictionary = train_dictionary([page_record(r["page_id"], r["url"], bytes(r["p"]), None) for r in taken], dictionary_bytes)
    keyed = rows.withColumn("key", F.sha2("payload", 256))
    again = revisits(keyed.select("page_id", "key", F.octet_length("payload").alias("size")), least=least)
    again = _store.table(again.withColumn("h", F.xxhash64("page_id", "key")), "revisits")
    sent = marks(again.select("h"))
    keyed = keyed.withColumn("h", F.xxhash64("page_id", "key")).withColumn("may", marked(sent, F.col("h")))
    alone = keyed.where("NOT may").select("page_id", "url", "payload", F.lit(None).cast("long").alias("refers_to"))
    asked = keyed.where("may").join(again.drop("h"), ["page_id", "key"], "left").select("page_id", "url", "payload", "refers_to")
    write, schema = _write(_store.new_dir(spark, "warc"), dictionary, level, archive_bytes), "path string, records bigint, bytes bigint"
    manifest = _store.table(alone.transform(arrow_map, write, schema).unionByName(asked.transform(arrow_map, write, schema)), "manifest")
    sent.destroy()
    _store.drop(again)
    return manifest


class ArchiveReader:
    """Iterates over the records of an archive: (fields in lower case, block)."""

    def __init__(self, stream):
        head = stream.read(8)
        self.dictionary = b""
        magic, size = struct.unpack("<II", head) if len(head) == 8 else (0, 0)
        if magic == _SKIPPABLE:
            self.dictionary = zstandard.ZstdDecompressor().decompress(stream.read(size))
            head = b""
        data = zstandard.ZstdCompressionDict(self.dictionary) if self.dictionary else None
        self._in = zstandard.ZstdDecompressor(dict_data=data).stream_reader(_Rest(head, stream), read_across_frames=True)
        self._buffer = b""

    def _fill(self, n: int) -> bool:
        parts, have = [self._buffer], len(self._buffer)
        while have < n and (part := self._in.read(max(n - have, 1 << 16))):
            parts.append(part)
            have += len(part)
        self._buffer = b"".join(parts)
        return have >= n

    def __iter__(self) -> Iterator[tuple[dict[str, str], bytes]]:
        while True:
            at = -1
            while (at := self._buffer.find(b"\r\n\r\n")) < 0 and self._fill(len(self._buffer) + 1):
                pass
            if at < 0:
                return
            lines = self._buffer[:at].decode().split("\r\n")
            fields = {k.lower(): v for k, _, v in (line.partition(": ") for line in lines[1:])}
            size = int(fields["content-length"])
            self._fill(at + 8 + size)
            yield fields, self._buffer[at + 4 : at + 4 + size]
            self._buffer = self._buffer[at + 8 + size :]


class _Rest:
    """A stream with bytes put back before it."""

    def __init__(self, head: bytes, stream):
        self._head, self._stream = head, stream

    def read(self, n: int = -1) -> bytes:
        if self._head:
            out, self._head = self._head, b""
            return out
        return self._stream.read(n)


def _id(name: str) -> int | None:
    return int(name[12:-1]) if name.startswith("<urn:x-page:") else None


_READ = pa.schema(
    [
        ("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("payload_bytes", pa.int64()),
        ("payload_digest", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary())
    ]
)


def _read(with_payload: bool, rows: int = 256):
    def of(path: str) -> Iterator[tuple]:
        with _store.open_read(path) as f:
            for fields, block in ArchiveReader(f):
                kind = fields["warc-type"]
                if kind == "warcinfo":
                    continue
                http, _, payload = block.partition(b"\r\n\r\n")
                size = int(http.rpartition(b"Content-Length: ")[2])
                digest = base64.b32decode(fields["warc-payload-digest"].removeprefix("sha1:")).hex()
                if kind == "response" and (len(payload) != size or hashlib.sha1(payload).hexdigest() != digest):
                    raise ValueError(f"{path}: {fields['warc-record-id']} doesn't match its digest")
                refers = fields.get("warc-refers-to")
                yield _id(
                    fields["warc-record-id"]
                ), fields["warc-target-uri"], kind, size, digest, _id(refers) if refers else None, payload if with_payload and kind == "response" else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path in b.column(0).to_pylist():
                kept: list[tuple] = []
                for r in of(path):
                    kept.append(r)
                    if len(kept) >= rows:
                        yield pa.RecordBatch.from_pydict({n: [x[k] for x in kept] for k, n in enumerate(_READ.names)}, schema=_READ)
                        kept = []
                if kept:
                    yield pa.RecordBatch.from_pydict({n: [x[k] for x in kept] for k, n in enumerate(_READ.names)}, schema=_READ)

    return run


def read_archives(spark: SparkSession, manifest: DataFrame, *, payload: bool = True) -> DataFrame:
    """A row for each page record of the archives, its digest verified: page_id, url, record_type, payload_bytes, payload_digest, refers_to, payload (of responses)."""
    return manifest.select("path").transform(
        arrow_map, _read(payload),
        "page_id bigint, url string, record_type string, payload_bytes bigint, payload_digest string, refers_to bigint, payload binary"
    )
