"""WARC archives compressed record by record with a Zstandard dictionary.

An archive is a ``.warc.zst`` file: a skippable frame (magic 0x184D2A5D) holds the dictionary, then every
WARC record is a Zstandard frame of its own that was compressed with it, so a record can be read alone.
The dictionary is built from records of the archive itself: those that come first, up to ``SAMPLE_BYTES``.
(If they are too few to train on, the dictionary is their raw content.)

A task streams its rows into one archive after another of about ``archive_bytes`` of payload; it holds the
sample and one record at a time.  Files go to the shared folder through pyarrow's file systems, under a name
that no other attempt uses, and only the files that the committed manifest lists are read back; an
attempt that is lost leaves a file that nobody reads.

Records with equal payloads of at least ``LEAST_REVISIT`` bytes are stored once: the row with the largest
page_id is a ``response``, the others are ``revisit`` records without payload.  That is decided on narrow
rows (id, digest, length).

Defined results: a null html is the empty payload; a null url has no target header; null page_ids have no
id in their record and come back as null, and they never hold the payload if an equal one has an id.  Rows
that repeat page_id and payload get a record each, of the same type.  Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import struct
import uuid
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
import pyarrow.fs as pafs
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import in_arrow, keep

LEAST_REVISIT = 1000
ARCHIVE_BYTES = 64 << 20
SAMPLE_BYTES = 2 << 20
DICTIONARY_BYTES = 64 << 10
LEVEL = 3
DICTIONARY_MAGIC = 0x184D2A5D
DATE = "2024-01-01T00:00:00Z"
_URN = "urn:page:"

MANIFEST = "archive string, records long, bytes long"
_MANIFEST = pa.schema([("archive", pa.string()), ("records", pa.int64()), ("bytes", pa.int64())])
RECORD = ("page_id long, url string, payload_bytes long, payload_digest string, record_type string, "
          "refers_to long, payload binary")
_RECORD = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()),
                     ("payload_digest", pa.string()), ("record_type", pa.string()),
                     ("refers_to", pa.int64()), ("payload", pa.binary())])


def record_bytes(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None = None,
                 revisit: bool = False) -> bytes:
    """One WARC 1.1 record of an HTTP response, or a revisit of one."""
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            f"Content-Length: {len(payload)}\r\n\r\n").encode()
    block = http if revisit else http + payload
    head = [("WARC-Type", "revisit" if revisit else "response"),
            ("WARC-Record-ID", f"<{_URN}{'' if page_id is None else page_id}>"), ("WARC-Date", DATE)]
    if url is not None:
        head.append(("WARC-Target-URI", quote(url, safe=":/?#[]@!$&'()*+,;=-._~")))
    if revisit:
        head += [("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
                 ("WARC-Refers-To", f"<{_URN}{refers_to}>")]
    head += [("WARC-Payload-Digest", "sha1:" + hashlib.sha1(payload).hexdigest()),
             ("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    lines = "".join(f"{k}: {v}\r\n" for k, v in head)
    return b"WARC/1.1\r\n" + lines.encode() + b"\r\n" + block + b"\r\n\r\n"


def _id(value: str | None) -> int | None:
    text = (value or "").strip("<>").removeprefix(_URN)
    return int(text) if text else None


def parse_record(data: bytes) -> dict:
    """The fields of one record; a response's length and digest are taken from its payload."""
    end = data.index(b"\r\n\r\n")
    lines = data[:end].decode().split("\r\n")
    if lines[0] != "WARC/1.1":
        raise ValueError(f"not a WARC record: {lines[0][:40]!r}")
    head = dict(x.split(": ", 1) for x in lines[1:])
    block = data[end + 4:end + 4 + int(head["Content-Length"])]
    if data[end + 4 + len(block):] != b"\r\n\r\n":
        raise ValueError("a WARC record is cut short")
    cut = block.index(b"\r\n\r\n")
    http = dict(x.split(": ", 1) for x in block[:cut].decode().split("\r\n")[1:])
    payload, kind = block[cut + 4:], head["WARC-Type"]
    digest, n = head["WARC-Payload-Digest"].removeprefix("sha1:"), int(http["Content-Length"])
    if kind == "response" and (len(payload) != n or hashlib.sha1(payload).hexdigest() != digest):
        raise ValueError("a payload differs from its digest")
    url = head.get("WARC-Target-URI")
    return {"page_id": _id(head["WARC-Record-ID"]), "url": None if url is None else unquote(url),
            "payload_bytes": n, "payload_digest": digest, "record_type": kind,
            "refers_to": _id(head.get("WARC-Refers-To")), "payload": payload if kind == "response" else None}


def build_dictionary(records: list[bytes], size: int = DICTIONARY_BYTES) -> zstandard.ZstdCompressionDict:
    total = sum(map(len, records))
    if len(records) >= 16 and total >= 8 * 1024:
        try:
            return zstandard.train_dictionary(min(size, max(1024, total // 8)), records, k=256, d=8)
        except zstandard.ZstdError:  # e.g. all records alike
            pass
    return zstandard.ZstdCompressionDict(b"".join(records)[:size] or b"WARC/1.1\r\n", zstandard.DICT_TYPE_RAWCONTENT)


class Archive:
    """An open archive: dictionary frame first, then a frame per record."""

    def __init__(self, folder: str, sample: list[bytes]):
        self.fs, path = pafs.FileSystem.from_uri(folder)
        self.path = f"{path}/{uuid.uuid4().hex}.warc.zst"
        self.uri = f"{folder}/{self.path.rpartition('/')[2]}"
        dictionary = build_dictionary(sample)
        raw = dictionary.as_bytes()
        self.out = self.fs.open_output_stream(self.path, compression=None)
        self.out.write(struct.pack("<II", DICTIONARY_MAGIC, len(raw)) + raw)
        self.compressor = zstandard.ZstdCompressor(level=LEVEL, dict_data=dictionary, write_content_size=True)
        self.records, self.bytes = 0, 8 + len(raw)

    def add(self, record: bytes) -> None:
        frame = self.compressor.compress(record)
        self.out.write(frame)
        self.records += 1
        self.bytes += len(frame)

    def close(self) -> dict:
        self.out.close()
        return {"archive": self.uri, "records": self.records, "bytes": self.bytes}


def _records(batches: Iterator[pa.RecordBatch]) -> Iterator[bytes]:
    for batch in batches:
        for i in range(batch.num_rows):
            page, url, html, refers = (c[i].as_py() for c in batch.columns)
            yield record_bytes(page, url, (html or "").encode("utf-8"), refers, refers is not None)


def _write(folder: str, archive_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]):
        records, done, waiting = _records(batches), [], []
        while True:
            size, waiting = 0, []
            for r in records:
                waiting.append(r)
                size += len(r)
                if size >= SAMPLE_BYTES:
                    break
            if not waiting:
                break
            archive = Archive(folder, waiting)
            for r in waiting:
                archive.add(r)
            if size >= SAMPLE_BYTES:
                for r in records:
                    archive.add(r)
                    size += len(r)
                    if size >= archive_bytes:
                        break
            done.append(archive.close())
        yield pa.RecordBatch.from_pylist(done, schema=_MANIFEST)
    return run


def revisits(pages: DataFrame, least: int = LEAST_REVISIT) -> DataFrame:
    """(page_id, digest, refers_to) of the rows whose payload another row holds."""
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select("page_id", F.sha1(payload).alias("digest"), F.octet_length(payload).alias("n")).where(F.col("n") >= least)
    groups = (rows.groupBy("digest").agg(F.max("page_id").alias("refers_to"), F.count(F.lit(1)).alias("of"),
                                         F.first("n").alias("n")).where("of > 1 and refers_to is not null"))
    return (rows.join(groups, ["n", "digest"]).where(~F.col("page_id").eqNullSafe(F.col("refers_to")))
            .select("page_id", "digest", "refers_to").distinct())


def write_warc(pages: DataFrame, folder: str, least: int = LEAST_REVISIT,
               archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write one record per row of ``pages`` (page_id, url, html) below ``folder``, a URI; returns the
    manifest (archive, records, bytes) of the archives that count."""
    fs, path = pafs.FileSystem.from_uri(folder)
    fs.create_dir(path, recursive=True)
    again = keep(revisits(pages, least))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html")
    if again.isEmpty():
        rows = rows.withColumn("refers_to", F.lit(None).cast("long"))
    else:
        digest = F.sha1(F.coalesce(F.col("html"), F.lit("")).cast("binary"))
        known = again.select(F.xxhash64(F.coalesce(F.col("page_id").cast("string"), F.lit("null"))).alias("key"), "digest",
                             "refers_to")
        key = F.xxhash64(F.coalesce(F.col("page_id").cast("string"), F.lit("null")))
        rows = (rows.withColumn("key", key).withColumn("digest", digest).join(known, ["key", "digest"], "left")
                .select("page_id", "url", "html", F.col("refers_to").cast("long").alias("refers_to")))
    return keep(in_arrow(rows, _write(folder, archive_bytes), MANIFEST))


def _read(with_payload: bool):
    schema = _RECORD if with_payload else pa.schema(list(_RECORD)[:-1])

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            for uri in batch.column(0).to_pylist():
                rows, size = [], 0
                for data in read_archive(uri):
                    r = parse_record(data)
                    size += len(data) if with_payload else 200
                    if not with_payload:
                        del r["payload"]
                    rows.append(r)
                    if size >= 4 << 20:
                        yield pa.RecordBatch.from_pylist(rows, schema=schema)
                        rows, size = [], 0
                yield pa.RecordBatch.from_pylist(rows, schema=schema)
    return run


def read_archive(uri: str) -> Iterator[bytes]:
    """The records of one archive, streamed."""
    fs, path = pafs.FileSystem.from_uri(uri)
    with fs.open_input_stream(path, compression=None) as f:
        magic, n = struct.unpack("<II", f.read(8))
        if magic != DICTIONARY_MAGIC:
            raise ValueError("the archive doesn't begin with a dictionary")
        decompressor = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(f.read(n)))
        rest = b""
        while True:
            more = f.read(1 << 20)
            rest += more
            while rest:
                d = decompressor.decompressobj()
                data = d.decompress(rest)
                if not d.eof:
                    if not more:
                        raise ValueError("the archive is cut short")
                    break
                yield data
                rest = d.unused_data
            if not more:
                return


def read_warc(manifest: DataFrame, payload: bool = True) -> DataFrame:
    """The records of the archives in ``manifest``; each task streams some archives."""
    schema = RECORD if payload else RECORD.rpartition(", ")[0]
    return in_arrow(manifest.select("archive"), _read(payload), schema)


def archive_folder(spark) -> str:
    """A fresh folder for archives in the shared folder, as a URI."""
    path = scratch_path(spark, "warc")
    return path if "://" in path or path.startswith("file:") else "file://" + path
