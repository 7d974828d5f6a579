"""WARC archives: a writer with revisit records, and a reader that salvages what follows damage.

**Writing.** Payloads are grouped by their SHA-1. Of pages with equal payloads of at least ``min_bytes`` bytes, the one with the smallest id gets a response record and the
others revisit records that refer to it. Only ids and digests are grouped and joined, never the payloads, and large groups of copies combine
before they are exchanged; where a copied payload's rows meet their group again, Spark's adaptive join splits them. Each task streams
files of one gzip member per record. A file's name is new for every attempt at a task, and only files in the manifest, which Spark commits, count.

**Reading.** Every record is checked: the member's own checksum, version line, headers, lengths, block and payload digests. After a failed check the reader
looks for the next gzip member that opens with a version line (in plain archives and inside members: the next version line), goes on there, and
logs the bytes in between as a quarantined gap with the reason. A member may hold any number of records. The reader holds one record and one chunk of the file.

Edge cases: null and empty payloads are 0 bytes and equal; rows repeated with the smallest id are all responses; a null id is
written as such, refers to nothing and is read as null; an empty table gives no archives and no rows; columns besides id, address and payload are ignored;
control characters and spaces in addresses are percent-encoded.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from urllib.parse import quote

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bizmetrics.llm.common import file_system, scratch_dir, ship_package, stored, utf8

VERSION = b"WARC/1.1"
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
ROTATE_BYTES = 256_000_000
CHUNK = 1 << 20
GZIP_MAGIC = b"\x1f\x8b\x08"
PIECE = 1 << 14  # of a member, unpacked at a time
HEADER_CHUNK = 1 << 16
BLANK = b"\r\n\r\n"


def digest(data: bytes) -> str:
    """Upper-case base32 SHA-1."""
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """A response record, or a revisit record if it refers to a page."""
    revisit = refers_to is not None
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    headers = {
        "WARC-Type": "revisit" if revisit else "response",
        "WARC-Record-ID": f"<urn:page:{'null' if page_id is None else page_id}>",
        "WARC-Date": DATE,
        "WARC-Target-URI": quote(url or "", safe="%/:=&?~#+!$,;'@()*[]"),
        "WARC-Payload-Digest": f"sha1:{digest(payload)}",
        "WARC-Block-Digest": f"sha1:{digest(block)}",
        "Content-Type": "application/http; msgtype=response",
        "Content-Length": str(len(block)),
    }
    if revisit:
        headers |= {"WARC-Profile": PROFILE, "WARC-Refers-To": f"<urn:page:{refers_to}>"}
    return VERSION + b"\r\n" + "".join(f"{k}: {v}\r\n" for k, v in headers.items()).encode() + b"\r\n" + block + b"\r\n\r\n"


def member(data: bytes) -> bytes:
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


# ---- reading


@dataclass
class Record:
    start: int
    end: int
    headers: dict[str, str] = field(repr=False)
    payload: bytes = field(repr=False)
    payload_bytes: int = 0

    @property
    def kind(self) -> str:
        return self.headers["warc-type"]


@dataclass
class Gap:
    """Bytes that hold no valid record."""

    start: int
    end: int
    reason: str


class Damage(ValueError):
    """A check failed."""


class Unreadable(Damage):
    """A member cannot be unpacked any further."""


class _Bytes:
    """A file by offset, a chunk at a time."""

    def __init__(self, source) -> None:
        self.source, self.size, self.at, self.chunk = source, source.size(), 0, b""

    def read(self, offset: int, size: int = CHUNK) -> bytes:
        """Up to ``size`` bytes from ``offset``; less only where the chunk or the file ends, none only past the file's end."""
        if not self.at <= offset < self.at + len(self.chunk):
            self.source.seek(offset)
            self.at, self.chunk = offset, self.source.read(CHUNK)
        return self.chunk[offset - self.at : offset - self.at + size]

    def exactly(self, offset: int, size: int) -> bytes:
        parts, left = [], size
        while left and (part := self.read(offset, left)):
            parts.append(part)
            offset, left = offset + len(part), left - len(part)
        return b"".join(parts)

    def find(self, needles: tuple[bytes, ...], offset: int) -> int:
        """Where one of the needles stands next, or the end of the file."""
        overlap = max(map(len, needles)) - 1
        while offset < self.size:
            part = self.exactly(offset, CHUNK)
            if hits := [at for n in needles if (at := part.find(n)) >= 0]:
                return offset + min(hits)
            offset += max(1, len(part) - overlap) if offset + len(part) < self.size else len(part)
        return self.size


def _parse(head: bytes) -> dict[str, str]:
    lines = head.split(b"\r\n")
    if not re.fullmatch(rb"WARC/1\.\d+", lines[0]):
        raise Damage("no version line")
    headers = {}
    for line in lines[1:]:
        name, colon, value = line.partition(b":")
        if not colon or not name.strip():
            raise Damage("malformed header")
        headers[name.strip().lower().decode("utf-8", "replace")] = value.strip().decode("utf-8", "replace")
    if not re.fullmatch(r"\d+", headers.get("content-length", "")):
        raise Damage("no length")
    if "warc-type" not in headers or "warc-record-id" not in headers:
        raise Damage("missing header")
    return headers


def _checked(start: int, end: int, headers: dict[str, str], block: bytes) -> Record:
    named = headers.get("warc-block-digest")
    if named and named.lower().startswith("sha1:") and named[5:].upper() != digest(block):
        raise Damage("block digest")
    payload, size = block, len(block)
    if headers.get("content-type", "").startswith("application/http"):
        http, _, payload = block.partition(b"\r\n\r\n")
        size = len(payload)
        if (said := re.search(rb"(?im)^content-length:\s*(\d+)", http)) and headers["warc-type"] == "revisit":
            size = int(said[1])
    named = headers.get("warc-payload-digest")
    if headers["warc-type"] == "response" and named and named.lower().startswith("sha1:") and named[5:].upper() != digest(payload):
        raise Damage("payload digest")
    return Record(start, end, headers, payload, size)


def _unpacked(data: _Bytes, start: int) -> Iterator[tuple[bytes, int]]:
    """Pieces of what the member at ``start`` holds, each with the place up to which the file is read; the last is the member's end."""
    unpacker, at, rest = zlib.decompressobj(31), start, b""
    try:
        while not unpacker.eof:
            if not rest:
                if not (rest := data.read(at, PIECE)):
                    raise Unreadable("cut off")
                at += len(rest)
            piece = unpacker.decompress(rest, 4 * PIECE)
            rest = unpacker.unconsumed_tail
            yield piece, at - len(unpacker.unused_data if unpacker.eof else rest)
    except zlib.error as error:
        raise Unreadable("member checksum" if "incorrect" in str(error) else "bad member") from None


def _sound(data: _Bytes, start: int) -> bool:
    """Whether the member at ``start`` has the checksum it names."""
    try:
        for _ in _unpacked(data, start):
            pass
    except Unreadable:
        return False
    return True


def _member_at(data: _Bytes, start: int) -> Iterator[Record | Gap]:
    """The records in the gzip member at ``start``, one after another, and what lies between them.

    Where a member has several, a record's place is what was read of the file for it. A record that others follow is given before the member's checksum is
    reached, on its own block digest; without one, the whole member is unpacked first.
    """
    pieces, held, here, read, sound, count = _unpacked(data, start), bytearray(), start, start, None, 0

    def more() -> bool:
        nonlocal read
        piece, read = next(pieces, (None, read))
        held.extend(piece or b"")
        return piece is not None

    def take() -> tuple[dict[str, str], int, int]:
        """The headers of what is held, and where its block begins and ends."""
        while len(held) < 7 and more():
            pass
        if not held.startswith(b"WARC/1.") and held:
            raise Damage("no version line")
        searched = 0
        while (length := held.find(BLANK, max(0, searched - 3))) < 0:
            searched = len(held)
            if not more():
                raise Damage("no end of headers")
        headers = _parse(bytes(held[:length]))
        begin, end = length + 4, length + 4 + int(headers["content-length"])
        while len(held) < end + 4:
            if not more():
                raise Damage("length")
        if held[end : end + 4] != BLANK:
            raise Damage("length")
        return headers, begin, end

    while True:
        try:
            headers, begin, end = take()
            count += 1
            while len(held) == end + 4 and more():
                pass
            alone = count == 1 and len(held) == end + 4
            if not alone and not headers.get("warc-block-digest", "").lower().startswith("sha1:"):
                sound = _sound(data, start) if sound is None else sound
                if not sound:
                    raise Damage("member checksum")
            found: Record | Gap = _checked(here, read, headers, bytes(held[begin:end]))
            del held[: end + 4]
        except Unreadable:
            raise
        except Damage as damage:
            if not count and not held.startswith(b"WARC/1."):
                raise  # nothing of an archive
            count += 1
            at = held.find(b"WARC/1.", 1)
            while at < 0:
                del held[:-6]
                if not more():
                    at = len(held)
                    break
                at = held.find(b"WARC/1.")
            del held[:at]
            found = Gap(here, read, str(damage))
        here = read
        yield found
        while len(held) < 7 and more():
            pass
        if not held:
            return


def _plain_at(data: _Bytes, start: int) -> Record:
    """The record that stands at ``start`` without compression."""
    if not re.match(rb"WARC/1\.\d+\r\n", data.exactly(start, 32)):
        raise Damage("no version line")
    head, searched = bytearray(), 0
    while (length := head.find(BLANK, max(0, searched - 3))) < 0:
        searched = len(head)
        if not (part := data.read(start + searched, HEADER_CHUNK)):
            raise Damage("no end of headers")
        head += part
    headers = _parse(bytes(head[:length]))
    size, at = int(headers["content-length"]), start + length + 4
    if at + size + 4 > data.size:
        raise Damage("cut off")
    block = data.exactly(at, size + 4)
    if block[size:] != BLANK:
        raise Damage("length")
    return _checked(start, at + size + 4, headers, block[:size])


def salvage(source) -> Iterator[Record | Gap]:
    """All valid records of an archive, and the gaps between them. ``source`` is an open file that can seek."""
    data, at, gap = _Bytes(source), 0, None
    while at < data.size:
        try:
            opening = data.exactly(at, 7)
            if opening.startswith(GZIP_MAGIC):
                several = _member_at(data, at)
            elif opening == b"WARC/1.":
                several = iter((_plain_at(data, at),))
            else:
                raise Damage("neither member nor version line")
            for found in several:
                at = found.end
                if isinstance(found, Gap):
                    gap = gap or found
                    continue
                if gap:
                    gap.end = found.start
                    yield gap
                    gap = None
                yield found
        except Damage as damage:
            gap = gap or Gap(at, at, str(damage))
            at = data.find((GZIP_MAGIC, b"WARC/1."), at + 1)
    if gap:
        gap.end = data.size
        yield gap


# ---- tables


def revisits(pages: DataFrame, id_column: str = "page_id", payload_column: str = "html", min_bytes: int = 0) -> DataFrame:
    """(page, hash, refers_to) of the pages whose payload an earlier page has."""
    payload = F.coalesce(F.col(f"`{payload_column}`").cast("string"), F.lit("")).cast("binary")
    keyed = stored(pages.select(F.col(f"`{id_column}`").alias("page"), F.sha1(payload).alias("hash"), F.length(payload).alias("size")).where(F.col("size") >= min_bytes).drop("size"), "digests")
    groups = stored(keyed.groupBy("hash").agg(F.min("page").alias("refers_to"), F.count("*").alias("n")).where("n > 1").drop("n"), "groups")
    # Both sides are tables, so the adaptive join can split a payload that very many pages share.
    return keyed.join(groups, "hash").where("page > refers_to").distinct()


def write(pages: DataFrame, folder: str, id_column: str = "page_id", url_column: str = "url", payload_column: str = "html", min_bytes: int = 0) -> DataFrame:
    """Write archives under ``folder``; the manifest, a row per file."""
    ship_package(pages.sparkSession)
    payload = F.coalesce(F.col(f"`{payload_column}`").cast("string"), F.lit(""))
    given = pages.select(F.col(f"`{id_column}`").cast("long").alias("page"), F.col(f"`{url_column}`").cast("string").alias("url"), payload.alias("payload"))
    earlier = revisits(pages, id_column, payload_column, min_bytes)
    keyed = given.withColumn("hash", F.sha1(F.col("payload").cast("binary")))
    ready = keyed.join(earlier, ["page", "hash"], "left").select("page", "url", "payload", "refers_to")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stream, path, records, size, files = None, "", 0, 0, 0

        def closed() -> pa.RecordBatch:
            stream.close()
            columns = [TaskContext.get().partitionId() * 1_000_000 + files], [path], [records], [size]
            types = pa.int64(), pa.string(), pa.int64(), pa.int64()
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["part", "path", "records", "bytes"])

        for batch in batches:
            for page, url, text, refers_to in zip(*(batch.column(c) for c in ("page", "url", "payload", "refers_to")), strict=True):
                if stream is not None and size >= ROTATE_BYTES:
                    yield closed()
                    stream = None
                if stream is None:
                    path, records, size, files = f"{folder}/{uuid.uuid4().hex}.warc.gz", 0, 0, files + 1
                    system, at = file_system(path)
                    system.create_dir(at.rpartition("/")[0], recursive=True)
                    stream = system.open_output_stream(at, compression=None)
                packed = member(record(page.as_py(), url.as_py(), utf8(text.as_py()), refers_to.as_py()))
                stream.write(packed)
                records, size = records + 1, size + len(packed)
        if stream is not None:
            yield closed()

    return stored(ready.mapInArrow(run, "part long, path string, records long, bytes long"), "manifest")


def read(archives: DataFrame, payloads: bool = False) -> DataFrame:
    """Records and gaps of the archives whose ``path`` is given: file, start and end byte, ``gap`` (its reason; null for records), and what a record says."""
    ship_package(archives.sparkSession)
    named = archives.select("path")
    schema = "path string, start long, end long, gap string, page_id long, url string, record_type string, payload_bytes long, payload_digest string, refers_to long, payload binary"
    types = [{"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}[c.split()[1]] for c in schema.split(", ")]
    names = [c.split()[0] for c in schema.split(", ")]

    def page(uri: str | None) -> int | None:
        found = re.fullmatch(r"<urn:page:(-?\d+)>", uri or "")
        return int(found[1]) if found else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)

        for batch in batches:
            for path in batch.column("path").to_pylist():
                system, at = file_system(path)
                rows, held = [], 0
                with system.open_input_file(at) as source:
                    for found in salvage(source):
                        if isinstance(found, Gap):
                            rows.append((path, found.start, found.end, found.reason, *[None] * 7))
                            continue
                        h = found.headers
                        kept = found.payload if payloads else None
                        said = h.get("warc-payload-digest", "")[5:].upper()
                        rows.append((path, found.start, found.end, None, page(h["warc-record-id"]), h.get("warc-target-uri"), found.kind, found.payload_bytes, said, page(h.get("warc-refers-to")), kept))
                        held += len(kept or b"")
                        if len(rows) >= 5_000 or held >= 16 * CHUNK:
                            yield batch_of(rows)
                            rows, held = [], 0
                if rows:
                    yield batch_of(rows)

    # A task per file: adaptive execution would put the short list into one.
    return named.repartitionByRange(max(1, named.count()), "path").mapInArrow(run, schema)


def page_records(pages: DataFrame) -> DataFrame:
    """Every page's record, as read back from the archives."""
    manifest = write(pages, f"{scratch_dir(pages.sparkSession)}/warc")
    return read(manifest).where("gap is null").select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
