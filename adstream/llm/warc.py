"""WARC archives in seekable Zstandard bundles.

A bundle is a file of independent frames, each a group of whole records, and ends
in a skippable frame with a table of all frames' sizes. The index maps a record's
id to its bundle, frame, and place inside the decompressed frame, so a record is
read by decompressing one frame. Names of bundles are new for each attempt of a
task, and only those of attempts that Spark committed are in the index: files of
lost or repeated tasks are never read.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from dataclasses import dataclass

import pyarrow as pa
import xxhash
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adstream.llm.tables import split_join, stored
from adstream.session import shared_folder

# The seekable format's magic numbers and its checksum flag, the
# base32 alphabet beside Spark's digits of base 32, and the profile of a revisit.
SKIPPABLE = 0x184D2A5E
SEEKABLE = 0x8F92EAB1
CHECKSUMS = 0x80
DIGITS = "0123456789ABCDEFGHIJKLMNOPQRSTUV"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

READ_BYTES = 1 << 25
INDEX = (
    "record_id string, page_id bigint, bundle string, frame int, offset bigint, length bigint"
)
RECORD = (
    "record_id string, page_id bigint, url string, record_type string, payload binary, "
    "payload_bytes bigint, payload_digest string, refers_to bigint, bundle string, "
    "frame int, offset bigint"
)


@dataclass(frozen=True)
class Bundling:
    """Sizes before compression; payloads below ``revisit_bytes`` are never revisits."""

    frame_bytes: int = 1 << 20
    bundle_bytes: int = 256 << 20
    level: int = 3
    revisit_bytes: int = 0
    date: str = "2024-01-01T00:00:00Z"


def sha1_base32(payload: Column) -> Column:
    """Upper-case base32 of the SHA-1 digest; 40 bits are eight of its letters."""
    digest = F.sha1(payload)
    parts = [
        F.lpad(F.conv(F.substring(digest, 10 * k + 1, 10), 16, 32), 8, "0") for k in range(4)
    ]
    return F.translate(F.concat(*parts), DIGITS, BASE32)


def with_revisits(pages: DataFrame, least: int = 0) -> DataFrame:
    """Digest and size of each page's payload, and the page it refers to, if any.

    Of equal payloads of at least ``least`` bytes, the smallest page_id is the
    response and the others refer to it. Repeated rows of that page are responses
    too, and so is all of a group whose page_ids are all null; other null page_ids
    refer to the response. A null html is an empty payload.
    """
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    pages = pages.select(
        F.col("page_id").cast("bigint").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        payload.alias("payload"),
        F.octet_length(payload).cast("bigint").alias("payload_bytes"),
        sha1_base32(payload).alias("payload_digest"),
    )
    firsts = (
        pages.where(F.col("payload_bytes") >= least)
        .groupBy("payload_digest", "payload_bytes")
        .agg(F.min("page_id").alias("first"), F.count("*").alias("copies"))
        .where("copies > 1")
        .drop("copies")
    )
    joined = split_join(pages, firsts, ["payload_digest", "payload_bytes"], "left")
    return joined.withColumn(
        "refers_to", F.when(~F.col("page_id").eqNullSafe(F.col("first")), F.col("first"))
    ).drop("first")


def _urn(page_id) -> str:
    return f"<urn:x-page:{'null' if page_id is None else page_id}>"


def _page(urn: str | None) -> int | None:
    name = (urn or "null>").rpartition(":")[2].rstrip(">")
    return None if name == "null" else int(name)


def _record(page_id, url, payload, size, digest, refers_to, date) -> bytes:
    """One record. A revisit keeps the payload's headers and leaves out the payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n"
    block = http.encode() + (payload if refers_to is None else b"")
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: {_urn(page_id)}",
        f"WARC-Date: {date}",
        f"WARC-Payload-Digest: sha1:{digest}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if url is not None:
        lines.append(f"WARC-Target-URI: {url.replace('%', '%25').replace('\r', '%0D').replace('\n', '%0A')}")
    if refers_to is not None:
        lines += [f"WARC-Refers-To: {_urn(refers_to)}", f"WARC-Profile: {PROFILE}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _headers(head: bytes) -> dict[str, str]:
    lines = head.decode().split("\r\n")[1:]
    return dict(line.split(": ", 1) for line in lines)


def parse_record(data: bytes) -> tuple:
    """record_id, page_id, url, type, payload, its size and digest, and refers_to.

    Raises where a response's payload is not what its digest says.
    """
    head, _, rest = data.partition(b"\r\n\r\n")
    warc = _headers(head)
    http, _, payload = rest[: int(warc["Content-Length"])].partition(b"\r\n\r\n")
    size = int(_headers(http)["Content-Length"])
    digest = warc["WARC-Payload-Digest"].removeprefix("sha1:")
    kind = warc["WARC-Type"]
    if kind == "response":
        found = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        if (found, len(payload)) != (digest, size):
            raise ValueError(f"record {warc['WARC-Record-ID']} is damaged")
    url = warc.get("WARC-Target-URI")
    if url is not None:
        url = url.replace("%0A", "\n").replace("%0D", "\r").replace("%25", "%")
    urn = warc["WARC-Record-ID"]
    refers_to = _page(warc.get("WARC-Refers-To"))
    return urn, _page(urn), url, kind, payload, size, digest, refers_to


class _Bundle:
    """An open bundle: records gather to a frame, frames are written as they fill."""

    def __init__(self, folder: str, how: Bundling):
        store, path = fs.FileSystem.from_uri(folder)
        store.create_dir(path, recursive=True)
        self.name = f"{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}.warc.zst"
        self.out = store.open_output_stream(f"{path}/{self.name}", compression=None)
        self.how, self.frame, self.frames, self.size = how, bytearray(), [], 0
        self.coder = zstandard.ZstdCompressor(level=how.level)

    def add(self, record: bytes) -> tuple[int, int]:
        if self.frame and len(self.frame) + len(record) > self.how.frame_bytes:
            self._close_frame()
        place = len(self.frames), len(self.frame)
        self.frame += record
        self.size += len(record)
        return place

    def _close_frame(self):
        data = bytes(self.frame)
        packed = self.coder.compress(data)
        self.out.write(packed)
        check = xxhash.xxh64_intdigest(data) & 0xFFFFFFFF
        self.frames.append(struct.pack("<III", len(packed), len(data), check))
        self.frame = bytearray()

    def close(self):
        if self.frame:
            self._close_frame()
        table = b"".join(self.frames) + struct.pack("<IBI", len(self.frames), CHECKSUMS, SEEKABLE)
        self.out.write(struct.pack("<II", SKIPPABLE, len(table)) + table)
        self.out.close()


def seek_table(source) -> list[tuple[int, int, int, int]]:
    """Start, packed size, size and checksum of each frame of an open bundle."""
    end = source.size()
    source.seek(end - 9)
    count, flags, magic = struct.unpack("<IBI", source.read(9))
    if magic != SEEKABLE or flags != CHECKSUMS:
        raise ValueError("no seek table")
    source.seek(end - 9 - 12 * count)
    frames, start = [], 0
    for packed, size, check in struct.iter_unpack("<III", source.read(12 * count)):
        frames.append((start, packed, size, check))
        start += packed
    return frames


def write_archive(pages: DataFrame, folder: str, how: Bundling = Bundling()) -> DataFrame:
    """Write pages with revisits (see with_revisits) as bundles; gives their index.

    ``folder`` is a URI that every executor can reach. The index is a table in the
    shared folder; without rows there are no bundles and an empty index.
    """

    def written(batches):
        bundle = None
        for batch in batches:
            rows = []
            for row in batch.to_pylist():
                record = _record(
                    row["page_id"], row["url"], row["payload"], row["payload_bytes"],
                    row["payload_digest"], row["refers_to"], how.date,
                )
                if bundle and bundle.size + len(record) > how.bundle_bytes:
                    bundle.close()
                    bundle = None
                bundle = bundle or _Bundle(folder, how)
                frame, offset = bundle.add(record)
                rows.append((_urn(row["page_id"]), row["page_id"], bundle.name, frame, offset, len(record)))
            columns = zip(*rows, strict=True) if rows else [()] * len(index)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(columns, index, strict=True)], schema=index
            )
        if bundle:
            bundle.close()

    index = pa.schema([
        ("record_id", pa.string()), ("page_id", pa.int64()), ("bundle", pa.string()),
        ("frame", pa.int32()), ("offset", pa.int64()), ("length", pa.int64()),
    ])
    return stored(pages.mapInArrow(written, INDEX), "warc_index")


def read_archive(index: DataFrame, folder: str) -> DataFrame:
    """The records of an index, or of any part of it, from their frames.

    Each frame is read once, by its bundle's seek table, and its checksum tested. There
    is a task for every READ_BYTES of records, as the index itself is too small to tell.
    """
    size = index.agg(F.sum("length")).first()[0] or 0
    tasks = size // READ_BYTES + 1
    frames = index.groupBy("bundle", "frame").agg(
        F.sort_array(F.collect_list(F.struct("offset", "length"))).alias("records")
    )
    frames = frames.repartition(tasks, "bundle", "frame").sortWithinPartitions("bundle", "frame")

    def read(batches):
        store, path = fs.FileSystem.from_uri(folder)
        name, source, table = None, None, []
        coder = zstandard.ZstdDecompressor()
        for batch in batches:
            for row in batch.to_pylist():
                if row["bundle"] != name:
                    name = row["bundle"]
                    source = store.open_input_file(f"{path}/{name}")
                    table = seek_table(source)
                start, packed, size, check = table[row["frame"]]
                source.seek(start)
                data = coder.decompress(source.read(packed), max_output_size=size)
                if xxhash.xxh64_intdigest(data) & 0xFFFFFFFF != check:
                    raise ValueError(f"frame {row['frame']} of {name} is damaged")
                records = [
                    (*parse_record(data[r["offset"] : r["offset"] + r["length"]]), name, row["frame"], r["offset"])
                    for r in row["records"]
                ]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, f.type) for c, f in zip(zip(*records, strict=True), record, strict=True)],
                    schema=record,
                )

    record = pa.schema([
        ("record_id", pa.string()), ("page_id", pa.int64()), ("url", pa.string()),
        ("record_type", pa.string()), ("payload", pa.binary()), ("payload_bytes", pa.int64()),
        ("payload_digest", pa.string()), ("refers_to", pa.int64()), ("bundle", pa.string()),
        ("frame", pa.int32()), ("offset", pa.int64()),
    ])
    return frames.mapInArrow(read, RECORD)


def archive_folder(df: DataFrame, name: str) -> str:
    """A new shared folder as a URI that names its file system."""
    spark = df.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(shared_folder(spark, name))
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toString()


def round_trip(pages: DataFrame, how: Bundling = Bundling()) -> DataFrame:
    """Archive the pages and read every record back."""
    folder = archive_folder(pages, "warc")
    index = write_archive(with_revisits(pages, how.revisit_bytes), folder, how)
    return read_archive(index, folder)
