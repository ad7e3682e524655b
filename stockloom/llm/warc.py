"""WARC archives: a writer of gzip members per record, and a salvage reader.

The reader checks each record: gzip's CRC, version line, headers, lengths and digests.
After a failed check it searches for the next valid gzip member or version line, goes on
from there, and logs the bytes in between as a quarantined gap. Members are unpacked as
streams and searched in the same way, so records around a damaged place of one are kept.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stockloom.llm.common import staged
from stockloom.session import stage_folder

VERSION = b"WARC/1.1\r\n"
# Compressed bytes of one archive before the next begins.
ARCHIVE_BYTES = 64 << 20
READ = 1 << 20
# Packed bytes that are unpacked at once: how exactly places inside a member are known.
CHUNK = 2 << 10
_START = re.compile(rb"\x1f\x8b\x08|WARC/1\.[01]\r\n")
_MEMBER = re.compile(rb"\x1f\x8b\x08")
_VERSION = re.compile(rb"WARC/1\.[01]\r\n")


def digest(payload: bytes) -> str:
    """Base32 SHA-1, without a prefix."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page_id: int | None, url: str | None, payload: bytes, sha1: str, refers_to: int | None, revisit: bool) -> bytes:
    """One record: an HTTP response, or a revisit with the response's headers only."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if revisit else http + payload
    target = re.sub(r"[\r\n]", "", url or "")
    lines = [
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>",
        f"WARC-Target-URI: {target}",
        "WARC-Date: 1970-01-01T00:00:00Z",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
        f"WARC-Block-Digest: sha1:{digest(block)}",
        f"WARC-Payload-Digest: sha1:{sha1}",
        f"WARC-Payload-Length: {len(payload)}",
    ]
    if revisit:
        lines += [
            "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
            f"WARC-Refers-To: <urn:page:{'' if refers_to is None else refers_to}>",
        ]
    header = VERSION + "\r\n".join(lines).encode() + b"\r\n\r\n"
    return header + block + b"\r\n\r\n"


def gzip_member(data: bytes) -> bytes:
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def with_revisits(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """``pages`` with payload_digest, revisit and refers_to.

    Of rows with equal payloads of at least ``min_bytes`` bytes, those with the smallest
    page_id are responses and the others revisit it; smaller payloads are all responses.
    A null html is an empty payload. A row without page_id revisits a page that has one.
    """
    hex_digest = F.sha1(F.coalesce("html", F.lit("")))
    marked = pages.select("page_id", "url", "html", hex_digest.alias("sha1"))
    first = (
        marked.filter(F.octet_length(F.coalesce("html", F.lit(""))) >= min_bytes)
        .groupBy("sha1")
        .agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
        .filter("n > 1 and first is not null")
        .select("sha1", "first")
    )
    revisit = F.expr("first is not null and not (page_id <=> first)")
    return marked.join(first, "sha1", "left").select(
        "page_id",
        "url",
        "html",
        revisit.alias("revisit"),
        F.expr("if(first is not null and not (page_id <=> first), first, null)").alias("refers_to"),
    )


def _store(folder: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(folder if "://" in folder or folder.startswith("file:") else f"file://{folder}")


def write_archives(records: DataFrame, folder: str) -> DataFrame:
    """Writes records as gzip members into archives below ``folder``; returns their list.

    ``records`` is what ``with_revisits`` returns. Each task writes files of its own, with
    unique names; only files of tasks that succeeded are in the list (path, records, bytes),
    so the leftovers of lost executors are never read. The list is written beside them.
    """
    if folder.startswith("/"):
        folder = f"file://{folder}"
    folder = re.sub(r"^file:/+", "file:///", folder)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = _store(folder)
        out, path, count, size, done = None, "", 0, 0, []
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("page_id", "url", "html", "revisit", "refers_to")]
            for page_id, url, html, revisit, refers_to in zip(*columns, strict=True):
                if out is None:
                    store.create_dir(base, recursive=True)
                    path = f"{base}/{uuid.uuid4()}.warc.gz"
                    out, count, size = store.open_output_stream(path, compression=None), 0, 0
                payload = (html or "").encode()
                member = gzip_member(record(page_id, url, payload, digest(payload), refers_to, revisit))
                out.write(member)
                count, size = count + 1, size + len(member)
                if size >= ARCHIVE_BYTES:
                    out.close()
                    done.append((path, count, size))
                    out = None
        if out is not None:
            out.close()
            done.append((path, count, size))
        yield pa.record_batch(
            [
                pa.array([f"{folder}/{d[0].rsplit('/', 1)[1]}" for d in done], pa.string()),
                pa.array([d[1] for d in done], pa.int64()),
                pa.array([d[2] for d in done], pa.int64()),
            ],
            ["path", "records", "bytes"],
        )

    return staged(records.mapInArrow(run, "path string, records bigint, bytes bigint"), "archives")


class Found(NamedTuple):
    """A record with its place, or a gap of bytes that hold none (``headers`` is None)."""

    start: int
    end: int
    headers: dict[str, str] | None
    block: bytes
    reason: str = ""


class Window:
    """A stream of which only the bytes from ``base`` on are held."""

    def __init__(self, stream):
        self.stream, self.base, self.data, self.over = stream, 0, bytearray(), False

    def fill(self, size: int) -> bool:
        """Whether at least ``size`` bytes are held, reading on if need be."""
        while len(self.data) < size and not self.over:
            more = self.stream.read(READ)
            self.over = not more
            self.data += more
        return len(self.data) >= size

    def skip(self, size: int) -> None:
        del self.data[:size]
        self.base += size


class Broken(ValueError):
    pass


def _parse(window: Window) -> tuple[dict[str, str], bytes, int]:
    """Headers, block and length of the record at the beginning of ``window``.

    A header may be of any length; it ends at the latest at a line without a colon.
    """
    window.fill(len(VERSION))
    data = window.data
    if not data.startswith((VERSION, b"WARC/1.0\r\n")):
        raise Broken("no version line")
    headers, at, seen = {}, len(VERSION), len(VERSION)
    while True:
        end = data.find(b"\r\n", seen)
        if end < 0:
            seen = max(at, len(data) - 1)
            if not window.fill(len(data) + 1):
                raise Broken("no end of the header")
            continue
        if end == at:
            break
        name, colon, value = bytes(data[at:end]).partition(b":")
        if not colon:
            raise Broken("a header line without a colon")
        headers[name.strip().lower().decode("ascii", "replace")] = value.strip().decode("utf-8", "replace")
        at = seen = end + 2
    if not {"warc-type", "warc-record-id"} <= headers.keys():
        raise Broken("no type or no id")
    if not re.fullmatch(r"[0-9]{1,18}", headers.get("content-length", "")):
        raise Broken("no content length")
    first = end + 2
    last = first + int(headers["content-length"])
    window.fill(last + 4)
    if bytes(data[last : last + 4]) != b"\r\n\r\n":
        raise Broken("the record does not end where its length says")
    block = bytes(data[first:last])
    stated = headers.get("warc-block-digest", "").removeprefix("sha1:")
    if stated and stated.upper() != digest(block):
        raise Broken("the block differs from its digest")
    _check_payload(headers, block)
    return headers, block, last + 4


def _check_payload(headers: dict[str, str], block: bytes) -> None:
    stated = headers.get("warc-payload-digest", "").removeprefix("sha1:")
    if headers.get("warc-type") == "response" and stated and digest(payload(block)) != stated.upper():
        raise Broken("the payload differs from its digest")


def payload(block: bytes) -> bytes:
    """The body of an HTTP response."""
    return block.partition(b"\r\n\r\n")[2]


class Unpacked:
    """The gzip member at the beginning of ``packed``, as a stream of its unpacked bytes.

    ``used`` bytes of ``packed`` are unpacked. At a damaged place the stream ends, after all
    that could be unpacked before it, and ``error`` says why.
    """

    def __init__(self, packed: Window):
        self.packed, self.used, self.error = packed, 0, ""
        self.unpacker = zlib.decompressobj(31)

    def place(self) -> int:
        return self.packed.base + self.used

    def read(self, size: int) -> bytes:
        out = b""
        while not (out or self.unpacker.eof or self.error):
            # Some bytes are kept, for a search after damage.
            if self.used > 2 * READ:
                self.packed.skip(self.used - READ)
                self.used = READ
            if not self.packed.fill(self.used + 1):
                self.error = "a member that is cut short"
                break
            chunk = bytes(self.packed.data[self.used : self.used + CHUNK])
            before = self.unpacker.copy()
            try:
                out = self.unpacker.decompress(chunk)
                self.used += len(chunk) - len(self.unpacker.unused_data)
            except zlib.error as error:
                self.error = f"a damaged member: {error}"
                out = self._rest(before, chunk)
        return out

    def _rest(self, unpacker, chunk: bytes) -> bytes:
        """What comes out of ``chunk`` before the damaged byte."""
        out = []
        for k in range(len(chunk)):
            try:
                out.append(unpacker.decompress(chunk[k : k + 1]))
            except zlib.error:
                break
            self.used += 1
        return b"".join(out)


def _records(member: Unpacked) -> Iterator[tuple[int, int, dict[str, str] | None, bytes, str]]:
    """(start, end, headers, block, reason) of a member's records; headers are None after a
    failed check. Places are those of the packed bytes."""
    window = Window(member)
    while window.fill(1):
        start = member.place()
        try:
            headers, block, length = _parse(window)
        except Broken as error:
            yield start, start, None, b"", str(error)
            _next_start(window, _VERSION)
            continue
        window.skip(length)
        # At the last record, this reads the member's end.
        window.fill(1)
        yield start, member.place(), headers, block, ""


def salvage(stream) -> Iterator[Found]:
    """Records and gaps of an archive, in order; together they cover every byte of it.

    Inside a member, places are known to ``CHUNK`` packed bytes, so a record or gap that
    shares them with the one before may have no bytes of its own.
    """
    # All before ``at`` is given out; with a reason, a gap begins there.
    window, at, reason = Window(stream), 0, ""
    while window.fill(1):
        window.fill(16)
        begin = window.base
        if not window.data.startswith(b"\x1f\x8b"):
            try:
                headers, block, length = _parse(window)
            except Broken as error:
                reason = reason or str(error)
                _next_start(window, _START)
                continue
            if reason:
                yield Found(at, max(at, begin), None, b"", reason)
                at, reason = max(at, begin), ""
            window.skip(length)
            yield Found(at, window.base, headers, block)
            at = window.base
            continue
        member, records, lost = Unpacked(window), 0, False
        for start, end, headers, block, why in _records(member):
            if headers is None:
                reason, lost = reason or why, True
                continue
            if reason:
                # The member's first bytes are the record's if nothing in it was lost.
                start = max(at, start if records or lost else begin)
                yield Found(at, start, None, b"", reason)
                at, reason = start, ""
            end = max(at, end)
            yield Found(at, end, headers, block)
            at, records = end, records + 1
        if not member.error:
            window.skip(member.used)
            if not records:
                reason = reason or "a member without a record"
            continue
        reason = reason or member.error
        # Records of this member that are given out already must not be found again.
        _next_start(window, _MEMBER if records else _START, max(0, begin + 1 - window.base))
    if reason:
        yield Found(at, max(at, window.base), None, b"", reason)


def _next_start(window: Window, start: re.Pattern, first: int = 1) -> None:
    """Skips to the next place, from ``first`` on, where a record or member may begin."""
    while True:
        found = start.search(window.data, first)
        if found:
            window.skip(found.start())
            return
        keep = min(len(window.data), 16)
        if window.over:
            window.skip(len(window.data))
            return
        window.skip(len(window.data) - keep)
        first = 0
        window.fill(keep + READ)


def _number(text: str) -> int | None:
    found = re.search(r":(-?[0-9]+)>", text)
    return int(found[1]) if found else None


def read_archives(archives: DataFrame, with_payload: bool = True) -> DataFrame:
    """Records and gaps of the archives in column ``path``, one archive per task at a time.

    Columns: path, start, end (bytes of the archive), reason (of a gap, else null), page_id,
    url, record_type, payload_bytes, payload_digest, refers_to and, if asked for, payload.
    Memory is bounded by the largest record. An empty archive gives no rows.
    """
    schema = (
        "path string, start bigint, end bigint, reason string, page_id bigint, url string,"
        " record_type string, payload_bytes bigint, payload_digest string, refers_to bigint"
    )
    schema += ", payload binary" if with_payload else ""
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string()]
    kinds += [pa.string(), pa.int64(), pa.string(), pa.int64()] + [pa.binary()] * with_payload
    names = [part.split()[0] for part in schema.split(", ")]

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows, strict=True))
        return pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    def row_of(path: str, found: Found) -> tuple:
        if found.headers is None:
            return (path, found.start, found.end, found.reason, *[None] * (len(names) - 4))
        own = found.headers
        body = payload(found.block)
        revisit = own.get("warc-type") == "revisit"
        size = own.get("warc-payload-length", "") if revisit else ""
        row = (
            path,
            found.start,
            found.end,
            None,
            _number(own.get("warc-record-id", "")),
            own.get("warc-target-uri"),
            own.get("warc-type"),
            int(size) if size.isdigit() else len(body),
            own.get("warc-payload-digest", "").removeprefix("sha1:") or digest(body),
            _number(own.get("warc-refers-to", "")),
        )
        return (*row, body) if with_payload else row

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column("path").to_pylist():
                store, place = _store(path)
                rows, held = [], 0
                with store.open_input_stream(place, compression=None) as stream:
                    for found in salvage(stream):
                        rows.append(row_of(path, found))
                        held += len(found.block)
                        if held > 8 * READ or len(rows) >= 5000:
                            yield batch_of(rows)
                            rows, held = [], 0
                if rows:
                    yield batch_of(rows)

    many = max(1, archives.count())
    return archives.select("path").repartition(many, "path").mapInArrow(run, schema)


def archived(spark: SparkSession, pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Writes ``pages`` as archives in the shared folder and reads them back."""
    folder = stage_folder(spark, "warc")
    return read_archives(write_archives(with_revisits(pages, min_bytes), folder), with_payload=False)
