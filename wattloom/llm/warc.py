"""Web archives: writing with revisit records, and a reader that salvages.

Writing: one record per page in gzip members, revisit records for equal payloads of at
least ``REVISIT_BYTES``: of those the page with the largest id is the response.

Reading: each member or record is checked (gzip checksum, version line, headers, length,
closing line feeds, payload digest). After a failed check the reader searches for the
next member that unpacks or the next version line, goes on there, and logs the skipped
bytes as quarantined. That holds inside a member, too, and for what can be unpacked of
one that is cut off or fails its checksum: the bytes of the member are quarantined, and
records in it that pass their own checks are read, with stop = start as a sign.

Rows: a null html is an empty payload; a null id or url is left out of the record and
read back as null. Pages with a null id never become the response of others. Repeated
pages keep their rows; of equal payloads every page with the largest id is a response.
An empty table makes archives without records. Archives are read whole, one at a time,
so writers should roll them; those written here hold one partition of pages each.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattloom.llm import common
from wattloom.session import scratch_dir

REVISIT_BYTES = 1000
# Fixed values of the format.
VERSION = b"WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORD_END = b"\r\n\r\n"
MEMBER_START = b"\x1f\x8b\x08"
PAGE_URN = "urn:page:"
#: The table has no time of capture.
CAPTURED = "1970-01-01T00:00:00Z"
_OUT_BYTES = 8_000_000
_CHUNK_BYTES = 4_096


def member(data: bytes) -> bytes:
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


#: Stands between records as the line separator of the text writer.
EMPTY_MEMBER = member(b"")


def _record(headers: list[tuple[str, str]], block: bytes) -> bytes:
    lines = [VERSION, *(f"{k}: {v}".encode() for k, v in headers), f"Content-Length: {len(block)}".encode()]
    return b"\r\n".join(lines) + RECORD_END + block + RECORD_END


def page_record(page_id: int | None, url: str | None, payload: bytes, response: int | None) -> bytes:
    """A response record, or a revisit of the page ``response``."""
    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
    headers = [("WARC-Type", "response" if response is None else "revisit"), ("WARC-Date", CAPTURED)]
    if page_id is not None:
        headers.append(("WARC-Record-ID", f"<{PAGE_URN}{page_id}>"))
    if url is not None:
        headers.append(("WARC-Target-URI", quote(url, safe="!#$&'()*+,/:;=?@[]~")))
    headers += [("WARC-Payload-Digest", f"sha1:{digest}"), ("X-Payload-Length", str(len(payload)))]
    headers.append(("Content-Type", "application/http; msgtype=response"))
    if response is None:
        return _record(headers, http + f"Content-Length: {len(payload)}\r\n\r\n".encode() + payload)
    headers += [("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", f"<{PAGE_URN}{response}>")]
    return _record(headers, http + b"\r\n")


def write(pages: DataFrame, path: str, key: str = "page_id", url: str = "url", html: str = "html") -> None:
    """Write archives of gzip members below ``path``."""
    payload = F.coalesce(F.col(html), F.lit(""))
    facts = pages.select(
        F.col(key).alias("key"),
        F.col(url).alias("url"),
        payload.alias("html"),
        F.octet_length(payload).alias("size"),
        F.sha1(payload.cast("binary")).alias("digest"),
    )
    large = facts.where(F.col("size") >= REVISIT_BYTES)
    shared = (
        large.groupBy("digest", "size")
        .agg(F.max("key").alias("response"), F.count("*").alias("n"))
        .where("n > 1")
        .select("digest", "size", "response")
    )
    decided = facts.join(shared, ["digest", "size"], "left").select(
        "key", "url", "html", F.when(~F.col("key").eqNullSafe(F.col("response")), F.col("response")).alias("response")
    )

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = zip(*(c.to_pylist() for c in batch.columns))
        members = [member(page_record(k, u, h.encode(), r)) for k, u, h, r in rows]
        return pa.RecordBatch.from_arrays([pa.array(members, pa.binary())], names=["member"])

    members = common.map_batches(decided, run, [T.StructField("member", T.BinaryType())])
    # The text writer puts out the bytes as they are and the separator after each.
    writer = members.select(F.col("member").cast("string")).write
    writer.option("encoding", "ISO-8859-1").option("lineSep", EMPTY_MEMBER.decode("latin-1")).text(path)


class Damaged(ValueError):
    """A record or member that fails a check."""


_VERSION_LINE = re.compile(rb"WARC/1\.[01]\r\n")


def _unpack(content: bytes, at: int) -> tuple[bytes, int, Damaged | None]:
    """The data of the gzip member at a position, and where it ends; of a damaged one what
    can be unpacked, where that ends, and the error."""
    begin, unpacker = at, zlib.decompressobj(31)
    parts = []
    while not unpacker.eof and at < len(content):
        chunk = content[at : at + _CHUNK_BYTES]
        try:
            parts.append(unpacker.decompress(chunk))
        except zlib.error as error:
            return b"".join([*parts, *_before_error(content, begin, at)]), at + len(chunk), Damaged(f"member does not unpack: {error}")
        at += len(chunk)
    if not unpacker.eof:
        return b"".join(parts), at, Damaged("member is cut off")
    return b"".join(parts), at - len(unpacker.unused_data), None


def _before_error(content: bytes, begin: int, at: int) -> Iterator[bytes]:
    """The data of the member at ``begin`` from ``at`` to the error in the next chunk."""
    unpacker = zlib.decompressobj(31)
    for start in range(begin, at, _CHUNK_BYTES):
        unpacker.decompress(content[start : start + _CHUNK_BYTES])
    try:
        for place in range(at, at + _CHUNK_BYTES):
            yield unpacker.decompress(content[place : place + 1])
    except zlib.error:
        return


def parse_record(data: bytes, at: int) -> tuple[dict[str, str], bytes, int]:
    """Headers, block and end of the record at a position; raises ``Damaged``."""
    if not _VERSION_LINE.match(data, at):
        raise Damaged("no version line")
    split = data.find(RECORD_END, at)
    if split < 0:
        raise Damaged("headers are cut off")
    headers = {}
    for line in data[at:split].split(b"\r\n")[1:]:
        name, colon, value = line.partition(b":")
        if not colon:
            raise Damaged("header without a colon")
        headers[name.decode("latin-1").strip().lower()] = value.decode("utf-8", "replace").strip()
    length = headers.get("content-length", "")
    if not (length.isascii() and length.isdigit() and len(length) < 19):
        raise Damaged("no length")
    begin, end = split + 4, split + 4 + int(length)
    if data[end : end + 4] != RECORD_END:
        raise Damaged("record does not end where it should")
    block = data[begin:end]
    if headers.get("warc-type") == "response" and "warc-payload-digest" in headers:
        payload = block.partition(RECORD_END)[2]
        if hashlib.sha1(payload).hexdigest() != _hexadecimal(headers["warc-payload-digest"]):
            raise Damaged("payload does not match its digest")
    return headers, block, end + 4


def _hexadecimal(digest: str) -> str | None:
    kind, _, value = digest.rpartition(":")
    try:
        return base64.b32decode(value.upper()).hex() if kind.lower() in ("", "sha1") and len(value) == 32 else value.lower()
    except ValueError:
        return None


def _next_start(content: bytes, at: int) -> int:
    """The next position where a member or a version line may start."""
    line = _VERSION_LINE.search(content, at)
    found = [p for p in (content.find(MEMBER_START, at), line.start() if line else -1) if p >= 0]
    return min(found, default=len(content))


def _records(data: bytes) -> tuple[list[tuple[dict[str, str], bytes]], Damaged | None]:
    """Headers and block of the records that pass their checks, and the first error."""
    records, first, at = [], None, 0
    while at < len(data):
        try:
            headers, block, at = parse_record(data, at)
            records.append((headers, block))
        except Damaged as error:
            first = first or error
            line = _VERSION_LINE.search(data, at + 1)
            at = line.start() if line else len(data)
    return records, first


def salvage(content: bytes) -> Iterator[tuple]:
    """("record", start, stop, headers, block) and ("gap", start, stop, reason, None) of
    an archive, gzip members and plain records in any order."""
    at, gap, reason = 0, None, ""
    # Where the unpacked part of the last damaged member ends, and its records: stored
    # without compression they can be met again as plain ones.
    unpacked, met = 0, []
    while at < len(content):
        records: list[tuple] = []
        error: Damaged | None = None
        if content.startswith(MEMBER_START, at):
            data, end, cut = _unpack(content, at)
            records, error = _records(data)
            if cut:
                if records:
                    unpacked, met = end, list(records)
                error, end = cut, _next_start(content, at + 1)
        else:
            try:
                headers, block, end = parse_record(content, at)
                if at < unpacked and (headers, block) in met:
                    met.remove((headers, block))
                    raise Damaged("record of a damaged member")
                records.append((headers, block))
            except Damaged as wrong:
                error, end = wrong, _next_start(content, at + 1)
        if error:
            if gap is None:
                gap, reason = at, str(error)
            # Whole records of a damaged member stay.
            for headers, block in records:
                yield "record", at, at, headers, block
            at = end
            continue
        if gap is not None:
            yield "gap", gap, at, reason, None
            gap = None
        for headers, block in records:
            yield "record", at, end, headers, block
        at = end
    if gap is not None:
        yield "gap", gap, at, reason, None


_READ_SCHEMA = (
    "kind string, archive string, start long, stop long, reason string, page_id long, url string, record_type string,"
    " refers_to long, payload_bytes long, payload_digest string, payload binary"
)


def _page_number(value: str | None) -> int | None:
    digits = (value or "").strip("<>").removeprefix(PAGE_URN)
    return int(digits) if re.fullmatch(r"-?[0-9]{1,19}", digits) else None


def _row(archive: str, found: tuple) -> tuple:
    kind, start, stop, detail, block = found
    if kind == "gap":
        return (kind, archive, start, stop, detail, *[None] * 7)
    payload = block.partition(RECORD_END)[2] if detail.get("warc-type") == "response" else None
    length = detail.get("x-payload-length") or (str(len(payload)) if payload is not None else "")
    return (
        kind,
        archive,
        start,
        stop,
        None,
        _page_number(detail.get("warc-record-id")),
        unquote(detail["warc-target-uri"]) if "warc-target-uri" in detail else None,
        detail.get("warc-type"),
        _page_number(detail.get("warc-refers-to")),
        int(length) if length.isascii() and length.isdigit() and len(length) < 19 else None,
        _hexadecimal(detail.get("warc-payload-digest", "")),
        payload,
    )


def read(spark: SparkSession, path: str) -> DataFrame:
    """Records and quarantined gaps (``kind``) of all archives below ``path``."""
    archives = spark.read.format("binaryFile").load(path).select("path", "content")
    schema = T._parse_datatype_string(_READ_SCHEMA)
    kinds = [pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
    names = schema.names

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for archive, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                rows, held = [], 0
                for found in salvage(content.as_py()):
                    rows.append(_row(archive, found))
                    held += len(rows[-1][-1] or b"") + 500
                    if held > _OUT_BYTES:
                        yield batch_of(rows)
                        rows, held = [], 0
                if rows:
                    yield batch_of(rows)

    return archives.mapInArrow(run, schema)


def round_trip(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Write the archives into the shared folder and read them back."""
    path = scratch_dir(pages.sparkSession, "archives")
    write(pages, path, key, url, html)
    return read(pages.sparkSession, path)
