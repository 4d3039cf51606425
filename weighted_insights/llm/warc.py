"""WARC archives in seekable Zstandard bundles.

Records are grouped into frames that decompress on their own.  A bundle ends with a seek table (a
skippable frame, so any Zstandard reader reads the bundle as one stream), and the index maps every
record to bundle, frame and offset in the frame.  A task writes its bundles under names of its own
attempt; the index names the files of the attempts that succeeded, so a task that runs again or twice
leaves files that nothing refers to, never doubled records.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..storage import new_path, settle
from .text import prepare, slices

SKIPPABLE = 0x184D2A5E
SEEKABLE = 0x8F92EAB1
CHECKSUMS = 0x80
FRAME_BYTES = 256 << 10
BUNDLE_BYTES = 64 << 20
READ_BYTES = 16 << 20
DATE = "1970-01-01T00:00:00Z"

INDEX_SCHEMA = (
    "page_id long, record_id string, bundle string, frame long, offset long, length long, "
    "frame_start long, frame_bytes long"
)
READ_SCHEMA = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, record_id string, url string"


def digest_text(digest: bytes) -> str:
    return base64.b32encode(digest).decode()


def record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id}:{digest}')}>"


def record(page_id: int | None, url: str | None, payload: bytes, length: int, digest: str, refers_to: int | None, date: str) -> tuple[str, bytes]:
    """Id and bytes of one record; with ``refers_to`` a revisit, which has no payload."""
    name = record_id(page_id, digest)
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {length}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: {name}",
        f"WARC-Date: {date}",
        f"WARC-Payload-Digest: sha1:{digest}",
        "Content-Type: application/http;msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if page_id is not None:
        head.append(f"X-Page-ID: {page_id}")
    if url is not None:
        # A header is one line.
        head.append("WARC-Target-URI: " + "".join(c if c > " " else f"%{ord(c):02X}" for c in url))
    if refers_to is not None:
        head.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        head.append(f"WARC-Refers-To: {record_id(refers_to, digest)}")
        head.append(f"X-Refers-To-Page-ID: {refers_to}")
    return name, "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(frame: bytes, start: int = 0) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and block of the records of a decompressed frame, from a record's offset on."""
    while start < len(frame):
        stop = frame.index(b"\r\n\r\n", start)
        lines = frame[start:stop].decode().split("\r\n")
        if lines[0] != "WARC/1.1":
            raise ValueError("not a WARC record")
        headers = dict(line.split(": ", 1) for line in lines[1:])
        length = int(headers["Content-Length"])
        yield headers, frame[stop + 4 : stop + 4 + length]
        start = stop + 8 + length


def row_of(headers: dict[str, str], block: bytes) -> tuple:
    """A record as a row of ``READ_SCHEMA``; digest and size of a response come from its payload."""
    http, _, payload = block.partition(b"\r\n\r\n")
    revisit = headers["WARC-Type"] == "revisit"
    if revisit:
        size = int(http.rsplit(b"Content-Length: ", 1)[1])
        digest = headers["WARC-Payload-Digest"].removeprefix("sha1:")
    else:
        size, digest = len(payload), digest_text(hashlib.sha1(payload).digest())
        if headers["WARC-Payload-Digest"] != f"sha1:{digest}":
            raise ValueError(f"payload of {headers['WARC-Record-ID']} does not match its digest")
    page, refers = headers.get("X-Page-ID"), headers.get("X-Refers-To-Page-ID")
    return (
        None if page is None else int(page),
        size,
        digest,
        headers["WARC-Type"],
        None if refers is None else int(refers),
        headers["WARC-Record-ID"],
        headers.get("WARC-Target-URI"),
    )


def open_folder(uri: str) -> tuple[pyarrow.fs.FileSystem, str]:
    """File system and path of a folder given by URI or plain path."""
    if "://" in uri or uri.startswith("file:"):
        return pyarrow.fs.FileSystem.from_uri(uri)
    return pyarrow.fs.LocalFileSystem(), uri


@dataclass(frozen=True)
class Frame:
    start: int
    size: int
    full: int
    checksum: int


class BundleWriter:
    """One bundle: frames, then the seek table."""

    def __init__(self, folder: str, name: str, frame_bytes: int, level: int):
        self.fs, path = open_folder(folder)
        self.fs.create_dir(path, recursive=True)
        self.name, self.frame_bytes = name, frame_bytes
        # The file system must not compress by the name.
        self.out = self.fs.open_output_stream(f"{path}/{name}", compression=None)
        self.coder = zstandard.ZstdCompressor(level=level)
        self.frames: list[Frame] = []
        self.open: list[bytes] = []
        self.filled = self.written = 0
        self.held: list[tuple] = []
        self.rows: list[tuple] = []

    def add(self, page_id: int | None, name: str, data: bytes) -> None:
        self.held.append((page_id, name, self.filled, len(data)))
        self.open.append(data)
        self.filled += len(data)
        if self.filled >= self.frame_bytes:
            self.end_frame()

    def end_frame(self) -> None:
        if not self.open:
            return
        data = b"".join(self.open)
        packed = self.coder.compress(data)
        self.out.write(packed)
        number = len(self.frames)
        self.frames.append(Frame(self.written, len(packed), len(data), xxhash.xxh64_intdigest(data) & 0xFFFFFFFF))
        self.rows += [(p, n, self.name, number, offset, length, self.written, len(packed)) for p, n, offset, length in self.held]
        self.written += len(packed)
        self.open, self.held, self.filled = [], [], 0

    def close(self) -> None:
        self.end_frame()
        entries = b"".join(struct.pack("<III", f.size, f.full, f.checksum) for f in self.frames)
        footer = struct.pack("<IBI", len(self.frames), CHECKSUMS, SEEKABLE)
        self.out.write(struct.pack("<II", SKIPPABLE, len(entries) + len(footer)) + entries + footer)
        self.out.close()


def read_range(fs: pyarrow.fs.FileSystem, path: str, start: int, size: int) -> bytes:
    with fs.open_input_file(path) as file:
        file.seek(start)
        return file.read(size)


def seek_table(fs: pyarrow.fs.FileSystem, path: str) -> list[Frame]:
    """The frames of a bundle, from its end alone."""
    whole = fs.get_file_info(path).size
    n, descriptor, magic = struct.unpack("<IBI", read_range(fs, path, whole - 9, 9))
    if magic != SEEKABLE or descriptor != CHECKSUMS:
        raise ValueError(f"{path} has no seek table")
    table = read_range(fs, path, whole - 9 - 12 * n - 8, 8 + 12 * n)
    if struct.unpack_from("<II", table) != (SKIPPABLE, 12 * n + 9):
        raise ValueError(f"{path} has a damaged seek table")
    frames, start = [], 0
    for size, full, checksum in struct.iter_unpack("<III", table[8:]):
        frames.append(Frame(start, size, full, checksum))
        start += size
    return frames


def read_frame(fs: pyarrow.fs.FileSystem, path: str, start: int, size: int, checksum: int | None = None) -> bytes:
    data = zstandard.ZstdDecompressor().decompress(read_range(fs, path, start, size))
    if checksum is not None and xxhash.xxh64_intdigest(data) & 0xFFFFFFFF != checksum:
        raise ValueError(f"frame at {start} of {path} is damaged")
    return data


def with_revisits(pages: DataFrame, min_revisit_bytes: int = 0) -> DataFrame:
    """``page_id, url, payload, length, digest (hex), refers_to``; the payload is null where the page is a revisit.

    Of equal payloads with ``min_revisit_bytes`` or more, the page of smallest id is the response.  Only ids and
    digests are shuffled; the payloads are, too, if the list of revisits is too long to be broadcast.
    """
    payload = F.coalesce(F.encode("html", "UTF-8"), F.lit(b""))
    rows = pages.select("page_id", "url", payload.alias("payload")).withColumns(
        {"digest": F.sha1("payload"), "length": F.octet_length("payload").cast("long")}
    )
    keys = rows.where(F.col("length") >= min_revisit_bytes).select("page_id", "digest")
    first = keys.groupBy("digest").agg(F.min("page_id").alias("refers_to"), F.count("*").alias("n")).where("n > 1").drop("n")
    revisits = keys.join(first, "digest").where(~F.col("page_id").eqNullSafe(F.col("refers_to")) & F.col("refers_to").isNotNull()).distinct()
    # Written first, so that its true size decides how it is joined.
    revisits = settle(revisits, "revisits").select(F.col("page_id").alias("_page"), F.col("digest").alias("_digest"), "refers_to")
    same = F.col("page_id").eqNullSafe(F.col("_page")) & (F.col("digest") == F.col("_digest"))
    return rows.join(revisits, same, "left").select(
        "page_id", "url", F.when(F.col("refers_to").isNull(), F.col("payload")).alias("payload"), "length", "digest", "refers_to"
    )


def write_archives(
    pages: DataFrame,
    folder: str | None = None,
    min_revisit_bytes: int = 0,
    frame_bytes: int = FRAME_BYTES,
    bundle_bytes: int = BUNDLE_BYTES,
    level: int = 3,
    date: str = DATE,
) -> tuple[str, DataFrame]:
    """Write one record per page (``page_id``, ``url``, ``html``); returns the folder and the index.

    The folder must be one that all executors reach (default: a new one in the shared folder).  A null ``html`` is an
    empty payload, a null ``url`` or ``page_id`` is left out of the headers.  Rows that repeat an id and its payload
    are responses both.  An empty table gives no bundle and an empty index.  Other columns are not read.
    """
    spark = pages.sparkSession
    prepare(spark)
    folder = folder or new_path(spark, "warc")
    rows = with_revisits(pages, min_revisit_bytes)

    def run(batches):
        context = TaskContext.get()
        stem = f"bundle-{context.partitionId():06d}-{context.attemptNumber()}-{uuid.uuid4().hex[:12]}"
        bundle, n = None, 0
        for batch, payloads in slices(batches, "payload"):
            columns = [payloads if name == "payload" else batch.column(name).to_pylist() for name in batch.schema.names]
            for page_id, url, payload, length, digest, refers_to in zip(*columns):
                if bundle is None:
                    bundle = BundleWriter(folder, f"{stem}-{n}.warc.zst", frame_bytes, level)
                    n += 1
                name, data = record(page_id, url, payload or b"", length, digest_text(bytes.fromhex(digest)), refers_to, date)
                bundle.add(page_id, name, data)
                if bundle.written >= bundle_bytes:
                    bundle.close()
                    yield index_rows(bundle)
                    bundle = None
        if bundle is not None:
            bundle.close()
            yield index_rows(bundle)

    return folder, settle(rows.mapInArrow(run, INDEX_SCHEMA), "warc-index")


def index_rows(bundle: BundleWriter) -> pa.RecordBatch:
    names = [part.split()[0] for part in INDEX_SCHEMA.split(", ")]
    kinds = [pa.int64(), pa.string(), pa.string(), *[pa.int64()] * 5]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*bundle.rows), kinds)], names)


def _records(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string()]
    columns = list(zip(*rows)) if rows else [()] * len(kinds)
    names = [part.split()[0] for part in READ_SCHEMA.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)


def read_archives(folder: str, index: DataFrame) -> DataFrame:
    """Every record of the indexed bundles, frame by frame as their seek tables tell."""
    prepare(index.sparkSession)
    sizes = index.groupBy("bundle").agg(F.max("frame").alias("last"), F.max(F.col("frame_start") + F.col("frame_bytes")).alias("size"))
    total = sizes.agg(F.sum("size")).first()[0] or 0
    # Bundles hold about a third of what they hold unpacked.
    parts = max(index.sparkSession.sparkContext.defaultParallelism, 4 * total // READ_BYTES)

    def frames(batches):
        fs, path = open_folder(folder)
        for batch in batches:
            for bundle in batch.column("bundle").to_pylist():
                found = seek_table(fs, f"{path}/{bundle}")
                columns = [[bundle] * len(found), *zip(*((f.start, f.size, f.checksum) for f in found))]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(columns, (pa.string(), pa.int64(), pa.int64(), pa.int64()))],
                    ["bundle", "start", "size", "checksum"],
                )

    def records(batches):
        fs, path = open_folder(folder)
        for batch in batches:
            for bundle, start, size, checksum in zip(*(c.to_pylist() for c in batch.columns)):
                frame = read_frame(fs, f"{path}/{bundle}", start, size, checksum)
                yield _records([row_of(*found) for found in parse(frame)])

    places = sizes.select("bundle").mapInArrow(frames, "bundle string, start long, size long, checksum long")
    return places.repartition(parts, "bundle", "start").mapInArrow(records, READ_SCHEMA)


def read_records(folder: str, index: DataFrame, ids: DataFrame) -> DataFrame:
    """The records of the given ``page_id`` rows only: their frames are read, nothing else of the bundles."""
    prepare(index.sparkSession)
    wanted = index.join(ids.select("page_id").distinct(), "page_id").select("bundle", "frame_start", "frame_bytes", "offset")

    def run(batches):
        fs, path = open_folder(folder)
        for batch in batches:
            for bundle, start, size, offset in zip(*(c.to_pylist() for c in batch.columns)):
                frame = read_frame(fs, f"{path}/{bundle}", start, size)
                yield _records([row_of(*next(parse(frame, offset)))])

    return wanted.mapInArrow(run, READ_SCHEMA)
