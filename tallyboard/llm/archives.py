"""WARC archives: a writer, and a reader that salvages what is left of damaged ones.

The writer makes a record of each page: of equal payloads (SHA-1 and length) the
page with the smallest id is a response, the others revisit it. Records are
gzip members of their own, or plain. Every task writes one file by Spark's text
sink, whose commit survives lost executors: the sink's line separator is the
last byte of each member, which is zero because it ends the length of less than
16 MB; a longer record is followed by an empty member. Files keep Spark's names.

The reader checks each record whole: the member's CRC, version line, headers,
Content-Length, end of record, block and payload digests. After a failed check
it searches for the next gzip member or version line from which a whole valid
record can be read, goes on there, and reports the bytes between as a
quarantined gap with the reason. A file is read by one task, as binaryFile gives
it (2 GB at most); the writer's files are about as large as its input splits.
A record embedded in the payload of a damaged plain record is found as a record.

Null and empty payloads are records without payload bytes. A page without an id
is always a response, and so is every page that repeats the smallest id; null
urls are left out; line breaks in urls become spaces. No pages give no records.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import batches, ship

#: Fixed values of the format.
VERSION, END, GZIP = b"WARC/1.1\r\n", b"\r\n\r\n", b"\x1f\x8b\x08"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"
#: The date of every record written, so that a retried task writes the same bytes.
DATE = "2000-01-01T00:00:00Z"
LEVEL, OUT_BYTES = 6, 8 << 20
VERSION_LINE, START = re.compile(rb"WARC/1\.[01]\r\n"), re.compile(rb"\x1f\x8b\x08|WARC/1\.[01]\r\n")
EMPTY_MEMBER_FROM, CHUNK = 1 << 24, 1 << 16

FIELDS = (
    "path string, offset long, bytes long, reason string, record_id string, record_type string, target_uri string, "
    "payload_digest string, payload_bytes long, refers_to string, payload binary"
)


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record(page: int | None, url: str | None, payload: bytes, first: int | None) -> bytes:
    """The record of a page; a revisit if `first`, the page it repeats, is given."""
    revisit = first is not None
    block = HTTP % len(payload) + (b"" if revisit else payload)
    headers = {
        "WARC-Type": "revisit" if revisit else "response",
        "WARC-Record-ID": record_id(page),
        "WARC-Date": DATE,
        "WARC-Target-URI": None if url is None else re.sub(r"[\r\n]+", " ", url),
        "WARC-Refers-To": record_id(first) if revisit else None,
        "WARC-Profile": PROFILE if revisit else None,
        "WARC-Payload-Digest": f"sha1:{base32_sha1(payload)}",
        "WARC-Block-Digest": f"sha1:{base32_sha1(block)}",
        "X-Payload-Length": str(len(payload)),
        "Content-Type": "application/http; msgtype=response",
        "Content-Length": str(len(block)),
    }
    lines = "".join(f"{name}: {value}\r\n" for name, value in headers.items() if value is not None)
    return VERSION + lines.encode() + b"\r\n" + block + END


def record_id(page: int | None) -> str:
    return "<urn:page:none>" if page is None else f"<urn:page:{page}>"


def member(data: bytes, level: int = LEVEL) -> bytes:
    """A gzip member whose last byte is zero."""
    packer = zlib.compressobj(level, zlib.DEFLATED, 31)
    packed = packer.compress(data) + packer.flush()
    return packed if len(data) % 2**32 < EMPTY_MEMBER_FROM else packed + member(b"")


def with_firsts(pages: DataFrame, least_bytes: int) -> DataFrame:
    """page_id, url, payload and `first`, the page whose payload a page repeats."""
    page = F.col("page_id").cast("long")
    payload = F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary")
    rows = pages.select(page.alias("page_id"), F.col("url").cast("string").alias("url"), payload.alias("payload"))
    keyed = rows.withColumns({"digest": F.sha1("payload"), "size": F.octet_length("payload")})
    repeated = (
        keyed.where((F.col("size") >= least_bytes) & F.col("page_id").isNotNull())
        .groupBy("digest", "size")
        .agg(F.min("page_id").alias("first"), F.max("page_id").alias("last"))
        .where("first < last")
        .select("digest", "size", "first")
    )
    found = keyed.join(repeated, ["digest", "size"], "left")
    return found.select("payload", "page_id", "url", F.when(F.col("page_id") > F.col("first"), F.col("first")).alias("first"))


def write_archives(pages: DataFrame, path: str, least_bytes: int = 0, compress: bool = True) -> None:
    """Writes (page_id, url, html) as archives into a new folder; payloads of fewer bytes are never revisits."""
    ship(pages.sparkSession)
    separator = "\x00" if compress else "\n"

    def lines(iterator):
        for batch in batches(iterator, OUT_BYTES):
            rows = zip(*(batch.column(c).to_pylist() for c in ("page_id", "url", "payload", "first")))
            made = [record(*row) for row in rows]
            made = [(member(data) if compress else data)[:-1] for data in made]
            yield pa.RecordBatch.from_arrays([pa.array(made, pa.binary())], names=["value"])

    written = with_firsts(pages, least_bytes).mapInArrow(lines, "value binary")
    written.select(F.col("value").cast("string").alias("value")).write.option("lineSep", separator).text(path)


class Damaged(ValueError):
    """What cannot be read as a whole record."""


def inflated(data: bytes, at: int) -> tuple[bytes, int]:
    """What the gzip member at a place holds, and where it ends."""
    unpacker, parts, view = zlib.decompressobj(31), [], memoryview(data)
    try:
        while not unpacker.eof and at < len(data):
            parts.append(unpacker.decompress(view[at : at + CHUNK]))
            at += CHUNK
    except zlib.error as problem:
        raise Damaged(f"gzip member: {problem}") from None
    if not unpacker.eof:
        raise Damaged("gzip member: cut short")
    return b"".join(parts), min(at, len(data)) - len(unpacker.unused_data)


def parsed(data: bytes, start: int = 0) -> tuple[tuple, int]:
    """The checked record whose version line starts there, and its end."""
    head = data.find(END, start)
    if head < 0:
        raise Damaged("headers cut short")
    headers = {}
    for line in data[start:head].split(b"\r\n")[1:]:
        name, colon, value = line.partition(b":")
        if not colon:
            raise Damaged("header without a colon")
        headers[name.strip().lower().decode("utf-8", "replace")] = value.strip().decode("utf-8", "replace")
    if not re.fullmatch("[0-9]+", length := headers.get("content-length", "")):
        raise Damaged("no Content-Length")
    if not headers.get("warc-record-id") or not headers.get("warc-type"):
        raise Damaged("mandatory header missing")
    block_at = head + len(END)
    end = block_at + int(length)
    if data[end : end + len(END)] != END:
        raise Damaged("Content-Length does not lead to the end of the record")
    block = data[block_at:end]
    if not told(headers.get("warc-block-digest"), block):
        raise Damaged("block digest differs")
    payload, kind = None, headers["warc-type"]
    if kind == "response":
        payload = block
        if headers.get("content-type", "").startswith("application/http"):
            split = block.find(END)
            if split < 0:
                raise Damaged("HTTP headers cut short")
            payload = block[split + len(END) :]
        if not told(headers.get("warc-payload-digest"), payload):
            raise Damaged("payload digest differs")
    digest = (headers.get("warc-payload-digest") or "").removeprefix("sha1:") or None
    size = len(payload) if payload is not None else int(headers["x-payload-length"]) if headers.get("x-payload-length", "").isdigit() else None
    row = (headers["warc-record-id"], kind, headers.get("warc-target-uri"), digest, size, headers.get("warc-refers-to"), payload)
    return row, end + len(END)


def told(digest: str | None, data: bytes) -> bool:
    """Whether a SHA-1 digest holds; none and other algorithms are not checked."""
    return not (digest or "").startswith("sha1:") or digest.removeprefix("sha1:").upper() == base32_sha1(data)


def read_at(data: bytes, at: int) -> tuple[list[tuple], int]:
    """(reason, record) of the gzip member, or of the plain record, at a place, and where it ends."""
    if data[at : at + 3] != GZIP:
        row, end = parsed(data, at)
        return [(None, row)], end
    inside, end = inflated(data, at)
    found = [(reason and f"within the member: {reason}", row) for _, _, reason, row in salvaged(inside, VERSION_LINE)]
    if found and not any(row for _, row in found):
        raise Damaged(found[0][0])
    return found, end


def salvaged(data: bytes, start: re.Pattern = START):
    """(offset, bytes, reason, record or None): whole records and the gaps between them, in order."""
    at, gap, reason = 0, None, None
    while at < len(data):
        try:
            if not start.match(data, at):
                raise Damaged("no gzip member or version line")
            rows, end = read_at(data, at)
        except Damaged as problem:
            gap, reason = (at, str(problem)) if gap is None else (gap, reason)
            following = start.search(data, at + 1)
            at = following.start() if following else len(data)
            continue
        if gap is not None:
            yield gap, at - gap, reason, None
            gap = None
        for why, row in rows:
            yield at, end - at, why, row
        at = end
    if gap is not None:
        yield gap, len(data) - gap, reason, None


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """One row for each record, and one with a `reason` and no record for each quarantined gap.

    offset and bytes are places in the file; a record's are those of its member.
    payload_bytes is the length of the full payload, null where a revisit does not tell it.
    """
    ship(spark)

    def read(iterator):
        for batch in iterator:
            for name, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                held, size = [], 0
                for offset, length, reason, row in salvaged(content.as_py()):
                    held.append((name, offset, length, reason, *(row or [None] * 7)))
                    size += len(row[-1] or b"") if row else 0
                    if size >= OUT_BYTES:
                        yield told_rows(held)
                        held, size = [], 0
                if held:
                    yield told_rows(held)

    types = [pa.string(), pa.int64(), pa.int64(), *[pa.string()] * 5, pa.int64(), pa.string(), pa.binary()]
    names = [field.split()[0] for field in FIELDS.split(", ")]

    def told_rows(held: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), types)], names=names)

    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInArrow(read, FIELDS)


def records(found: DataFrame) -> DataFrame:
    return found.where("reason IS NULL").drop("reason")


def quarantined(found: DataFrame) -> DataFrame:
    """The log of byte gaps: path, offset, bytes, reason."""
    return found.where("reason IS NOT NULL").select("path", "offset", "bytes", "reason")


def page_of(record_id: str) -> Column:
    """The page that the record id in a column names."""
    return F.regexp_extract(record_id, "^<urn:page:(-?[0-9]+)>$", 1).try_cast("long")
