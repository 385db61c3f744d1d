"""WARC archives: pages written as records, one gzip member each, and a reader that splits archives by byte ranges.

Archives lie in the shared folder and are opened through Arrow's file systems, by the scheme of their path. A task
names its files anew at every attempt and returns them in its result, so the manifest that Spark commits holds the
archives of successful attempts only, and a lost executor costs no more than a file that nothing names.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from perilspark.operators.joins import broadcast_if_small
from perilspark.session import materialise

#: Bytes after which a task starts another archive, and bytes of a range that one task reads.
ARCHIVE_BYTES = 256 << 20
RANGE_BYTES = 32 << 20

#: Most tasks that ranges are dealt to.
READ_TASKS = 20_000

#: Bytes asked of the store at a time.
BLOCK = 1 << 20

# Fixed values of the formats.
MAGIC = b"\x1f\x8b\x08"
VERSION = b"WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

MANIFEST = "archive string, bytes long, records long"
RECORD = (
    "archive string, offset long, length long, record_type string, record_id string, refers_to string, target_uri string, "
    "payload_bytes long, payload_digest string, payload binary"
)
_MANIFEST = pa.schema([("archive", pa.string()), ("bytes", pa.int64()), ("records", pa.int64())])
_RECORD = pa.schema([
    ("archive", pa.string()), ("offset", pa.int64()), ("length", pa.int64()), ("record_type", pa.string()), ("record_id", pa.string()),
    ("refers_to", pa.string()), ("target_uri", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("payload", pa.binary()),
])


def digest(payload: bytes) -> str:
    """SHA-1 in upper-case base32."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def urn(key: int | None) -> str:
    return f"<urn:x-page:{'' if key is None else key}>"


def _header_value(text: str) -> str:
    """Blanks and control characters would end a header or split it."""
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", text)


def member(headers: list[tuple[str, str]], block: bytes, level: int = 6) -> bytes:
    """One record as a gzip member of its own."""
    lines = [VERSION.decode(), *(f"{k}: {v}" for k, v in headers), f"Content-Length: {len(block)}", "", ""]
    packer = zlib.compressobj(level, zlib.DEFLATED, 31)
    head = "\r\n".join(lines).encode()
    return packer.compress(head) + packer.compress(block) + packer.compress(b"\r\n\r\n") + packer.flush()


def page_record(key: int | None, url: str | None, payload: bytes, revisit: bool, first: int | None, date: str) -> bytes:
    headers = [("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", urn(key)), ("WARC-Date", date)]
    if url is not None:
        headers.append(("WARC-Target-URI", _header_value(url)))
    headers.append(("WARC-Payload-Digest", f"sha1:{digest(payload)}"))
    if revisit:
        headers += [("WARC-Refers-To", urn(first)), ("WARC-Profile", PROFILE)]
    headers.append(("Content-Type", "application/http;msgtype=response"))
    block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    return member(headers, block if revisit else block + payload)


def write_archives(
    pages: DataFrame, folder: str, key: str = "page_id", url: str = "url", payload: str = "html", least: int = 0,
    archive_bytes: int = ARCHIVE_BYTES, date: str = "2000-01-01T00:00:00Z",
) -> DataFrame:
    """Write a record per page under ``folder``; returns the manifest: archive, bytes, records.

    Of pages with equal payloads of at least ``least`` bytes the one with the smallest key is written whole
    (response), the others refer to it (revisit, without payload). Payloads are compared by SHA-256; a hot payload is
    a sum per task before it is shuffled, and its pages meet their first one by a broadcast of measured size, beyond
    which the join shuffles and Spark splits the hot key. Every archive starts with a warcinfo record.

    A null payload is empty, a null url gives no target. Pages with a null key revisit the first page that has one;
    without such a page each is a response. Rows of equal key and payload are alike: all response if they hold the smallest
    key, all revisit otherwise. A very long payload is one record and is held once in its task. Other columns are not
    read. An empty table gives an empty manifest.
    """
    content = F.coalesce(F.col(payload).cast("binary"), F.lit(b""))
    rows = pages.select(F.col(key).cast("long").alias("key"), F.col(url).alias("url"), content.alias("payload"))
    rows = rows.withColumn("sha", F.when(F.length("payload") >= least, F.unhex(F.sha2("payload", 256))))
    firsts = rows.where(F.col("sha").isNotNull()).groupBy("sha").agg(F.min("key").alias("first"), F.count("*").alias("n"))
    firsts = materialise(firsts.where("n > 1").drop("n"), "warc-firsts")
    rows = rows.join(broadcast_if_small(firsts), "sha", "left").drop("sha")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = fs.FileSystem.from_uri(folder)
        store.create_dir(base, recursive=True)
        out, name, size, records = None, "", 0, 0

        def done() -> pa.RecordBatch:
            out.close()
            return pa.RecordBatch.from_pydict({"archive": [f"{folder}/{name}"], "bytes": [size], "records": [records]}, _MANIFEST)

        for batch in batches:
            for i in range(batch.num_rows):
                if out is None:
                    name = f"part-{uuid.uuid4().hex}.warc.gz"
                    out = store.open_output_stream(f"{base}/{name}", compression=None)
                    data = member([("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid4()}>"), ("WARC-Date", date),
                                   ("WARC-Filename", name), ("Content-Type", "application/warc-fields")], b"format: WARC File Format 1.1\r\n")
                    out.write(data)
                    size, records = len(data), 1
                page, first = batch.column("key")[i].as_py(), batch.column("first")[i].as_py()
                revisit = first is not None and page != first
                data = page_record(page, batch.column("url")[i].as_py(), batch.column("payload")[i].as_py(), revisit, first, date)
                out.write(data)
                size, records = size + len(data), records + 1
                if size >= archive_bytes:
                    yield done()
                    out = None
        if out is not None:
            yield done()

    return materialise(rows.mapInArrow(write, MANIFEST), "warc-manifest")


class Stretch:
    """Bytes of a file from a moving position on, read block by block."""

    def __init__(self, file, size: int):
        self.file, self.size, self.start, self.held = file, size, 0, b""

    def block(self, at: int) -> bytes:
        """What is held from ``at`` on, some bytes at least; empty at the end of the file."""
        if not self.start <= at < self.start + len(self.held):
            self.start, self.held = at, self.file.read_at(min(BLOCK, max(0, self.size - at)), at)
        return self.held[at - self.start :]


def next_magic(file: Stretch, at: int, end: int) -> int | None:
    """First place of gzip's magic that starts in [at, end)."""
    while at < end:
        held = file.block(at)
        if len(held) < len(MAGIC):
            # Too near the end of what is held: read anew from here.
            held = file.file.read_at(min(BLOCK, max(0, file.size - at)), at)
            file.start, file.held = at, held
        found = held.find(MAGIC)
        if found >= 0:
            return at + found if at + found < end else None
        if at + len(held) >= file.size:
            return None
        at += max(1, len(held) - len(MAGIC) + 1)
    return None


def decode(file: Stretch, at: int) -> tuple[int, bytes] | None:
    """Compressed length and content of the member at a place; None if no WARC record starts there.

    The first bytes decide on nearly all false magics; a member must also end well, checksum included.
    """
    unpack, out, place, known = zlib.decompressobj(31), [], at, False
    try:
        while not unpack.eof:
            held = file.block(place)
            if not held:
                return None
            # A false start shows after a few bytes and must not cost a block.
            held = held if known else held[:512]
            out.append(unpack.decompress(held))
            place += len(held)
            if not known:
                begun = b"".join(out)
                if not VERSION[:5].startswith(begun[:5]):
                    return None
                known = len(begun) >= 5
    except zlib.error:
        return None
    return (place - len(unpack.unused_data) - at, b"".join(out)) if known else None


def fields(head: bytes) -> dict[str, str]:
    """Header lines by lower-case name; the first line is none of them."""
    pairs = (line.partition(":") for line in head.decode("utf-8", "replace").split("\r\n")[1:])
    return {k.strip().lower(): v.strip() for k, _, v in pairs}


def parse(content: bytes) -> dict | None:
    """A record's row; None if headers or lengths don't fit."""
    head, blank, rest = content.partition(b"\r\n\r\n")
    headers = fields(head)
    if not blank or not headers.get("content-length", "").isdigit() or len(rest) < int(headers["content-length"]):
        return None
    block = rest[: int(headers["content-length"])]
    row = {
        "record_type": headers.get("warc-type"), "record_id": headers.get("warc-record-id"), "refers_to": headers.get("warc-refers-to"),
        "target_uri": headers.get("warc-target-uri"), "payload": block,
    }
    told = headers.get("warc-payload-digest", "").removeprefix("sha1:") or None
    if headers.get("content-type", "").startswith("application/http"):
        http, _, row["payload"] = block.partition(b"\r\n\r\n")
        stated = fields(http).get("content-length", "")
    else:
        stated = ""
    if row["record_type"] == "revisit":
        return row | {"payload_bytes": int(stated) if stated.isdigit() else None, "payload_digest": told, "payload": None}
    return row | {"payload_bytes": len(row["payload"]), "payload_digest": digest(row["payload"])}


def range_records(file: Stretch, start: int, end: int) -> Iterator[dict]:
    """Records that start in [start, end); the last one is read beyond the end."""
    at = next_magic(file, start, end)
    while at is not None:
        found = decode(file, at)
        row = parse(found[1]) if found else None
        if row is None:
            at = next_magic(file, at + 1, end)
            continue
        yield {"offset": at, "length": found[0], **row}
        at = next_magic(file, at + found[0], end)


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for task in batch.to_pylist():
            store, path = fs.FileSystem.from_uri(task["archive"])
            with store.open_input_file(path) as raw:
                rows, size = [], 0
                for row in range_records(Stretch(raw, raw.size()), task["start"], task["end"]):
                    rows.append({"archive": task["archive"], **row})
                    size += len(row["payload"] or b"") + 500
                    if size >= 8 * BLOCK:
                        yield pa.RecordBatch.from_pylist(rows, _RECORD)
                        rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, _RECORD)


def read_archives(manifest: DataFrame, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """All records of the archives in a manifest (archive, bytes), read by byte ranges.

    A task scans its range for gzip's magic, takes a place for a record if the member there decodes to WARC headers and
    ends with a right checksum, and owns the records that start in its range. ``offset`` and ``length`` are the member's.
    Payload, its bytes and its digest are those read; a revisit has no payload, and what its headers say of bytes and
    digest. A range may hold no record; an empty manifest gives an empty table. A record is held whole in its task,
    others stream through.

    Text that holds a whole compressed record in stored form could be taken for one by a range that starts inside
    it; ``unsound`` tells, and such an archive is read right by one range (``range_bytes`` of its size or more).
    """
    ranges = manifest.where("bytes > 0").select("archive", F.col("bytes"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("bytes") - 1, F.lit(range_bytes).cast("long"))).alias("start"))
    ranges = ranges.select("archive", "start", F.least(F.col("start") + range_bytes, "bytes").alias("end"))
    tasks = manifest.agg(F.sum(F.ceil(F.col("bytes") / range_bytes))).first()[0] or 1
    return ranges.repartition(int(min(tasks, READ_TASKS))).mapInArrow(_read, RECORD)


def unsound(records: DataFrame, manifest: DataFrame) -> DataFrame:
    """Archives of the manifest whose records don't cover it byte for byte and record for record."""
    found = records.groupBy("archive").agg(F.sum("length").alias("found"), F.count("*").alias("n"))
    both = manifest.join(found, "archive", "left")
    return both.where(~(F.col("found").eqNullSafe(F.col("bytes")) & F.col("n").eqNullSafe(F.col("records")))).select(*manifest.columns)


def read_sound(manifest: DataFrame, columns: list[str], range_bytes: int = RANGE_BYTES) -> DataFrame:
    """Columns of all records, as a written table; archives that ranges could not tell apart are read from the start.

    Raises if an archive doesn't hold what its manifest says even then, so no record is lost unnoticed.
    """
    needed = list(dict.fromkeys(["archive", "length", *columns]))
    records = materialise(read_archives(manifest, range_bytes).select(*needed), "warc-records")
    bad = materialise(unsound(records, manifest), "warc-unsound")
    longest = bad.agg(F.max("bytes")).first()[0]
    if longest is None:
        return records.select(*columns)
    again = materialise(read_archives(bad, longest).select(*needed), "warc-again")
    broken = [r["archive"] for r in unsound(again, bad).limit(3).collect()]
    if broken:
        raise ValueError(f"damaged archives, among them {broken}")
    return records.join(bad.select("archive"), "archive", "left_anti").unionByName(again).select(*columns)


def page_key(column: str):
    """The key in a record's name; null where a record names no page."""
    return F.regexp_extract(column, r"^<urn:x-page:(-?[0-9]+)>$", 1).try_cast("long")


#: Twin of the query on the table ``pages``.
SQL = """
    with rows as (select page_id, coalesce(html, '') as html from pages),
    bits as (
        select *, cast(cast(unhex(sha1(html)) as bit) as varchar) as b, min(page_id) over (partition by html) as first from rows)
    select page_id, strlen(html) as payload_bytes,
           array_to_string(list_transform(range(32), lambda i:
               substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + cast(list_sum(list_transform(range(5), lambda j:
                   cast(substr(b, cast(5 * i + j + 1 as bigint), 1) as integer) * (1 << cast(4 - j as integer)))) as bigint), 1)), '') as payload_digest,
           case when page_id = first then 'response' else 'revisit' end as record_type,
           case when page_id <> first then first end as refers_to
    from bits"""
