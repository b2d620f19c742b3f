"""WARC records in seekable Zstandard bundles.

Every page becomes one WARC/1.1 record. Of pages with equal payloads the one of the smallest page_id is written
as a response, the others as revisits (identical-payload-digest profile), which carry the HTTP header
but no payload. Records are gathered into frames of about `frame_bytes`, each a Zstandard frame of its own;
a bundle is a file of frames, closed by a seek table in the format of seekable Zstandard: a skippable frame
(magic 0x184D2A5E) with compressed and decompressed size of each frame, their count, a descriptor
byte and the magic 0x8F92EAB1. Any Zstandard reader reads a bundle as one WARC file; with the table a
reader opens a single frame. An index maps each record id to bundle, frame, and the record's offset and size in the
frame.

The digest is SHA-1 in base 32, of the full payload in UTF-8. A revisit's HTTP header still says the payload's
length.

Defined cases: a null payload is empty; a null url is written as an empty target; a null page_id is written
as `null` and is a response, unless a page with an id has the same payload; rows of equal page_id and payload
are all responses if that id is the smallest; payloads below `revisit_from` bytes are always responses; an empty
table writes nothing and gives an empty result; extra columns are not looked at.
"""

from __future__ import annotations

import base64
import hashlib
import struct

import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sievelake.llm.storage import folder, keep, write_file

FRAME_BYTES = 256 * 1024
BUNDLE_BYTES = 32 * 1024 * 1024
SKIPPABLE = 0x184D2A5E
SEEKABLE = 0x8F92EAB1
DATE = "2026-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_INDEX = "page_id long, bundle string, frame int, offset long, size long, record_type string"
_READ = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(page_id: int | None) -> str:
    return f"<urn:page:{'null' if page_id is None else page_id}>"


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    block = http.encode() + (payload if refers_to is None else b"")
    target = "".join((url or "").splitlines())
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: {record_id(page_id)}",
        f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {target}",
        f"WARC-Payload-Digest: sha1:{digest(payload)}",
    ]
    if refers_to is not None:
        lines += [f"WARC-Refers-To: {record_id(refers_to)}", f"WARC-Profile: {PROFILE}"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode("utf-8", "replace") + b"\r\n\r\n" + block + b"\r\n\r\n"


def _header(data: bytes, at: int) -> tuple[dict[str, str], int]:
    end = data.index(b"\r\n\r\n", at)
    lines = data[at:end].decode("utf-8").split("\r\n")[1:]
    return {k.lower(): v for k, _, v in (line.partition(": ") for line in lines)}, end + 4


def parse(data: bytes, at: int = 0) -> tuple[dict[str, str], bytes, int]:
    """WARC header, block and the place after the record that begins at `at`."""
    header, begin = _header(data, at)
    end = begin + int(header["content-length"])
    return header, data[begin:end], end + 4


class Bundle:
    """Frames being written; `parts()` gives the file with its seek table."""

    def __init__(self):
        self.frames: list[bytes] = []
        self.sizes: list[tuple[int, int]] = []
        self.size = 0
        self.compressor = zstandard.ZstdCompressor(level=3, write_content_size=True)

    def add(self, frame: bytes) -> None:
        packed = self.compressor.compress(frame)
        self.frames.append(packed)
        self.sizes.append((len(packed), len(frame)))
        self.size += len(packed)

    def parts(self):
        yield from self.frames
        table = b"".join(struct.pack("<II", *s) for s in self.sizes)
        table += struct.pack("<IBI", len(self.sizes), 0, SEEKABLE)
        yield struct.pack("<II", SKIPPABLE, len(table)) + table


def frames(data) -> list[tuple[int, int, int]]:
    """(begin, compressed size, size) of each frame, from the footer."""
    count, _, magic = struct.unpack_from("<IBI", data, len(data) - 9)
    if magic != SEEKABLE:
        raise ValueError("no seek table")
    at, begin, out = len(data) - 9 - 8 * count, 0, []
    for i in range(count):
        packed, size = struct.unpack_from("<II", data, at + 8 * i)
        out.append((begin, packed, size))
        begin += packed
    return out


def read_frame(data, place: tuple[int, int, int]) -> bytes:
    begin, packed, size = place
    return zstandard.ZstdDecompressor().decompress(bytes(data[begin : begin + packed]), max_output_size=size)


def writer(target: str, frame_bytes: int, bundle_bytes: int):
    """For mapInArrow: (page_id, url, html, refers_to) to the index, one row per record."""

    def rows(batches):
        partition = TaskContext.get().partitionId()
        bundle, number, held, size, index = Bundle(), 0, [], 0, []
        name = f"part-{partition:06d}-{number:06d}.warc.zst"

        def close_frame():
            nonlocal held, size
            if held:
                bundle.add(b"".join(held))
                held, size = [], 0

        def out():
            columns = list(zip(*index)) or [()] * 6
            kinds = [pa.int64(), pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.string()]
            return pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)],
                names=["page_id", "bundle", "frame", "offset", "size", "record_type"],
            )

        for batch in batches:
            for page_id, url, html, refers_to in zip(*(c.to_pylist() for c in batch.columns)):
                data = record(page_id, url, (html or "").encode("utf-8", "replace"), refers_to)
                index.append((page_id, name, len(bundle.sizes), size, len(data), "response" if refers_to is None else "revisit"))
                held.append(data)
                size += len(data)
                if size >= frame_bytes:
                    close_frame()
                if bundle.size >= bundle_bytes:
                    close_frame()
                    write_file(f"{target}/{name}", bundle.parts())
                    yield out()
                    bundle, number, index = Bundle(), number + 1, []
                    name = f"part-{partition:06d}-{number:06d}.warc.zst"
        close_frame()
        if bundle.sizes:
            write_file(f"{target}/{name}", bundle.parts())
        yield out()

    return rows


def _page(urn: str) -> int | None:
    text = urn[len("<urn:page:") : -1]
    return None if text == "null" else int(text)


def read_rows(batches):
    """For mapInArrow: bundles to one row per record; lengths and digests of responses are those of the payload read."""
    for batch in batches:
        for content in batch.column(0):
            data = content.as_buffer()
            view = memoryview(data)
            out: list[tuple] = []
            for place in frames(view):
                frame, at = read_frame(view, place), 0
                while at < len(frame):
                    header, block, at = parse(frame, at)
                    http, begin = _header(block, 0)
                    payload, kind = block[begin:], header["warc-type"]
                    length, sum_ = int(http["content-length"]), header["warc-payload-digest"].removeprefix("sha1:")
                    if kind == "response":
                        if len(payload) != length or digest(payload) != sum_:
                            raise ValueError(f"{header['warc-record-id']}: payload differs from its digest")
                    refers_to = header.get("warc-refers-to")
                    out.append((_page(header["warc-record-id"]), length, sum_, kind, refers_to and _page(refers_to)))
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(list(zip(*out)) or [()] * 5, kinds)],
                names=["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"],
            )


def with_references(pages: DataFrame, page_id: str, url: str, html: str, revisit_from: int) -> DataFrame:
    """page_id, url, html, refers_to (null: response).

    Digests are grouped with partial minima. Only pages that revisit another are joined to the pages, by page_id and
    digest, so that no group of copies meets in one task.
    """
    read = pages.select(F.col(page_id).cast("long").alias("page_id"), F.col(url).alias("url"), F.col(html).alias("html"))
    payload = F.coalesce("html", F.lit(""))
    hashed = read.select(
        "page_id",
        F.sha1(F.encode(payload, "UTF-8")).alias("sha"),
        (F.octet_length(payload) >= revisit_from).alias("long_enough"),
    )
    first = (
        hashed.where("long_enough")
        .groupBy("sha")
        .agg(F.min("page_id").alias("refers_to"), F.count(F.lit(1)).alias("n"))
        .where("n > 1 AND refers_to IS NOT NULL")
        .drop("n")
    )
    revisits = keep(
        hashed.where("long_enough")
        .join(first, "sha")
        .where("NOT page_id <=> refers_to")
        .select(F.col("page_id").alias("of"), F.col("sha").alias("of_sha"), "refers_to")
        .distinct()
    )
    marked = read.withColumn("sha", F.sha1(F.encode(payload, "UTF-8")))
    return marked.join(
        revisits, marked["page_id"].eqNullSafe(revisits["of"]) & (marked["sha"] == revisits["of_sha"]), "left"
    ).select("page_id", "url", "html", "refers_to")


def write_bundles(
    pages: DataFrame,
    target: str,
    page_id: str = "page_id",
    url: str = "url",
    html: str = "html",
    revisit_from: int = 0,
    frame_bytes: int = FRAME_BYTES,
    bundle_bytes: int = BUNDLE_BYTES,
) -> DataFrame:
    """Write the bundles; the index, one row per record: page_id, bundle, frame, offset, size, record_type."""
    records = with_references(pages, page_id, url, html, revisit_from)
    return keep(records.mapInArrow(writer(target, frame_bytes, bundle_bytes), _INDEX))


def read_bundles(spark: SparkSession, target: str) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to of every record, from the bundles."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.zst").load(target)
    return files.select("content").mapInArrow(read_rows, _READ)


def read_records(spark: SparkSession, target: str, index: DataFrame) -> DataFrame:
    """page_id and record (bytes) of the index rows given; of each bundle only the frames they name are opened."""

    def pick(batches):
        for batch in batches:
            for content, wanted in zip(batch.column(0), batch.column(1).to_pylist()):
                view, got, last, frame = memoryview(content.as_buffer()), [], -1, b""
                places = frames(view)
                for w in sorted(wanted, key=lambda w: (w["frame"], w["offset"])):
                    if w["frame"] != last:
                        last, frame = w["frame"], read_frame(view, places[w["frame"]])
                    got.append((w["page_id"], frame[w["offset"] : w["offset"] + w["size"]]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([g[0] for g in got], pa.int64()), pa.array([g[1] for g in got], pa.binary())],
                    names=["page_id", "record"],
                )

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.zst").load(target)
    named = files.select("content", F.element_at(F.split("path", "/"), -1).alias("bundle"))
    wanted = index.groupBy("bundle").agg(F.collect_list(F.struct("page_id", "frame", "offset", "size")).alias("wanted"))
    return named.join(wanted, "bundle").select("content", "wanted").mapInArrow(pick, "page_id long, record binary")


def round_trip(pages: DataFrame, **options) -> DataFrame:
    """Write `pages` to a new folder of bundles and read every record back."""
    spark, target = pages.sparkSession, folder(pages.sparkSession)
    index = write_bundles(pages, target, **options)
    if not index.limit(1).count():
        return spark.createDataFrame([], _READ)
    return read_bundles(spark, target)
