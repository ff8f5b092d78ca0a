"""WARC archives compressed with a dictionary of their own records.

Each task writes its rows to files in a shared folder.  The first records of a file
(up to SAMPLE_BYTES) train a Zstandard dictionary; the file begins with a skippable
frame that holds it, and every record after that is a frame of its own, so a reader
needs nothing but the file, and any record can be read alone.  A file is closed after
FILE_BYTES and the next one gets its own dictionary.

A file counts once its row is in the stored manifest.  Files have the task attempt in their
name, so a retried or speculative task leaves an unlisted file and never half a one.

Payloads are compared by SHA-1 over all pages; one response is archived, the others
become revisit records that name it.
"""

from __future__ import annotations

import base64
import hashlib
import io
import struct
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civicflow.llm.common import slices, stored
from civicflow.session import scratch_path

DICT_FRAME = 0x184D2A5D   # skippable frame that holds the dictionary
ZSTD_FRAME = 0xFD2FB528
DICT_BYTES = 64 << 10
SAMPLE_BYTES = 2 << 20
FILE_BYTES = 512 << 20    # of records before compression
LEVEL = 3
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MANIFEST = "path string, records bigint, bytes bigint, dictionary_bytes bigint"
RECORD = ("page_id bigint, url string, record_type string, payload_bytes bigint, payload_digest string, refers_to bigint")


def filesystem(uri: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a folder and the path within it; local paths may lack a scheme."""
    if uri.startswith("file:/") and not uri.startswith("file://"):
        uri = "file://" + uri[len("file:"):]
    return pafs.FileSystem.from_uri(uri)


def _one_line(value: str) -> str:
    return "".join(c if c.isprintable() else f"%{ord(c):02X}" for c in value)


def record_bytes(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One WARC/1.1 record; a revisit holds the HTTP header only, whose Content-Length is the payload's."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    revisit = refers_to is not None
    block = http if revisit else http + payload
    head = [f"WARC-Type: {'revisit' if revisit else 'response'}",
            f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>", f"WARC-Date: {DATE}"]
    if url is not None:
        head.append(f"WARC-Target-URI: {_one_line(url)}")
    head.append(f"WARC-Payload-Digest: sha1:{digest}")
    if revisit:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return ("WARC/1.1\r\n" + "\r\n".join(head) + "\r\n\r\n").encode() + block + b"\r\n\r\n"


def dictionary(samples: list[bytes]) -> zstandard.ZstdCompressionDict:
    """Trained on the samples; too few of them serve as a raw dictionary."""
    total = sum(map(len, samples))
    try:
        return zstandard.train_dictionary(min(DICT_BYTES, max(1024, total // 10)), samples, k=512, d=8)
    except zstandard.ZstdError:
        return zstandard.ZstdCompressionDict(b"".join(samples)[-DICT_BYTES:], dict_type=zstandard.DICT_TYPE_RAWCONTENT)


class ArchiveWriter:
    """Writes records to numbered files of one task; yields a manifest row per closed file."""

    def __init__(self, folder: str, name: str):
        self.fs, self.folder = filesystem(folder)
        self.fs.create_dir(self.folder, recursive=True)
        self.uri, self.name, self.files = folder.rstrip("/"), name, 0
        self._fresh()

    def _fresh(self) -> None:
        self.waiting, self.sampled, self.out, self.records, self.size = [], 0, None, 0, 0

    def add(self, record: bytes) -> Iterator[tuple]:
        self.records += 1
        self.size += len(record)
        if self.out is None:
            self.waiting.append(record)
            self.sampled += len(record)
            if self.sampled >= SAMPLE_BYTES:
                self._open()
        else:
            self.out.write(self.compressor.compress(record))
        if self.size >= FILE_BYTES:
            yield from self.close()

    def _open(self) -> None:
        self.dict = dictionary(self.waiting)
        self.file = f"{self.name}-{self.files:04d}.warc.zst"
        self.files += 1
        self.out = self.fs.open_output_stream(f"{self.folder}/{self.file}", compression=None)
        raw = self.dict.as_bytes()
        self.out.write(struct.pack("<II", DICT_FRAME, len(raw)) + raw)
        self.compressor = zstandard.ZstdCompressor(level=LEVEL, dict_data=self.dict, write_content_size=True, write_checksum=True)
        for record in self.waiting:
            self.out.write(self.compressor.compress(record))
        self.waiting = []

    def close(self) -> Iterator[tuple]:
        if self.records:
            if self.out is None:
                self._open()
            written = self.out.tell()
            self.out.close()
            yield f"{self.uri}/{self.file}", self.records, written, len(self.dict.as_bytes())
        self._fresh()


def _write(batches: Iterator[pa.RecordBatch], folder: str) -> Iterator[pa.RecordBatch]:
    task = TaskContext.get()
    writer = ArchiveWriter(folder, f"pages-{task.partitionId():06d}-{task.taskAttemptId()}" if task else "pages")
    done: list[tuple] = []
    for batch in batches:
        for part in slices(batch, "html"):
            for page_id, url, html, sha, first in zip(*(part.column(c).to_pylist() for c in ("page_id", "url", "html", "sha", "first"))):
                digest = base64.b32encode(bytes.fromhex(sha)).decode()
                done.extend(writer.add(record_bytes(page_id, url, html.encode(), digest, first)))
    done.extend(writer.close())
    yield pa.RecordBatch.from_arrays([pa.array([d[k] for d in done], t) for k, t in enumerate((pa.string(), *[pa.int64()] * 3))],
                                     names=["path", "records", "bytes", "dictionary_bytes"])


def write_archives(pages: DataFrame, folder: str | None = None, least_bytes: int = 0) -> DataFrame:
    """Archive every row of ``pages`` (page_id, url, html); returns the stored manifest of files.

    Of pages with equal payloads of at least ``least_bytes`` bytes, those with the smallest page_id are
    responses and the others revisit it; smaller payloads are all responses.  NULL html is an empty
    payload, a NULL url leaves its field out, a NULL page_id is never the one revisited.  Other columns
    are ignored; an empty table gives an empty manifest.

    Only digests are shuffled; the table of repeated digests joins back by its measured size.
    """
    spark = pages.sparkSession
    folder = folder or scratch_path(spark, "warc")
    payload = F.coalesce("html", F.lit(""))
    slim = pages.select("page_id", "url", payload.alias("html"), F.sha1(payload.cast("binary")).alias("sha"))
    known = slim.select("page_id", "sha", F.octet_length("html").alias("size"))
    repeated = stored(known.where(F.col("size") >= least_bytes).groupBy("sha")
                      .agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
                      .where("n > 1 and first is not null").select("sha", "first"), "warc-repeats")
    rows = slim.join(repeated, "sha", "left").select(
        "page_id", "url", "html", "sha", F.when(~F.col("page_id").eqNullSafe(F.col("first")), F.col("first")).alias("first"))
    return stored(rows.mapInArrow(lambda it: _write(it, folder), MANIFEST), "warc-manifest")


def _headers(source: io.BufferedReader) -> dict[str, str] | None:
    line = source.readline()
    if not line:
        return None
    if not line.startswith((b"WARC/", b"HTTP/")):
        raise ValueError(f"not a record: {line[:40]!r}")
    out = {}
    while (line := source.readline()) not in (b"\r\n", b""):
        name, _, value = line.decode().partition(":")
        out[name.strip().lower()] = value.strip()
    return out


def _page(uri: str) -> int | None:
    number = uri.removeprefix("<urn:page:").removesuffix(">")
    return int(number) if number else None


def open_archive(path: str) -> io.BufferedReader:
    """Decompressed records of one archive, with the dictionary from its leading frame."""
    fs, inner = filesystem(path)
    raw = fs.open_input_stream(inner, compression=None)
    magic, size = struct.unpack("<II", raw.read(8))
    if magic != DICT_FRAME:
        raise ValueError(f"{path}: no dictionary frame")
    held = raw.read(size)
    if held[:4] == struct.pack("<I", ZSTD_FRAME):  # the dictionary itself may be compressed
        held = zstandard.ZstdDecompressor().decompress(held)
    reader = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(held))
    return io.BufferedReader(reader.stream_reader(raw, read_across_frames=True, closefd=True), 1 << 16)


def read_archive(path: str) -> Iterator[tuple]:
    """(page_id, url, type, payload bytes, payload digest, refers to) of each record; payloads are read
    in pieces and must have the digest that their header states."""
    with open_archive(path) as source:
        while (head := _headers(source)) is not None:
            left = int(head["content-length"])
            at = source.tell()
            http = _headers(source) or {}
            left -= source.tell() - at
            stated = head["warc-payload-digest"].removeprefix("sha1:")
            if head["warc-type"] == "response":
                sha, size = hashlib.sha1(), left
                while left:
                    piece = source.read(min(left, 1 << 20))
                    if not piece:
                        raise ValueError(f"{path}: a record ends early")
                    sha.update(piece)
                    left -= len(piece)
                if base64.b32encode(sha.digest()).decode() != stated:
                    raise ValueError(f"{path}: payload digest of {head['warc-record-id']} differs")
            else:
                size = int(http["content-length"])
            if source.read(4) != b"\r\n\r\n":
                raise ValueError(f"{path}: a record isn't closed")
            yield (_page(head["warc-record-id"]), head.get("warc-target-uri"), head["warc-type"], size, stated,
                   _page(head["warc-refers-to"]) if "warc-refers-to" in head else None)


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    types = (pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64())
    names = ["page_id", "url", "record_type", "payload_bytes", "payload_digest", "refers_to"]
    for batch in batches:
        for path in batch.column("path").to_pylist():
            rows = []
            for row in read_archive(path):
                rows.append(row)
                if len(rows) == 10_000:
                    yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(types)], names=names)
                    rows = []
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(types)], names=names)


def read_archives(manifest: DataFrame) -> DataFrame:
    """One row per record of the listed archives: see RECORD."""
    files = manifest.count()
    return manifest.select("path").repartition(max(1, files)).mapInArrow(_read, RECORD)
