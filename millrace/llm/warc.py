"""WARC archives: a writer for pages, and a salvage reader.

Writer: a record per page. Of pages with equal payloads of at least REVISIT_BYTES
bytes that with the smallest page_id is a response, the others are revisit records
that refer to it. Records are built as one column and written by Spark's own writer
to any file system Spark knows: a record ends with two line ends, which is the
writer's row separator, so a file is a sequence of records and nothing else. Records
are packed into files by their bytes, so one large page has a file of its own and
changes no other.

With gzip every record is a member of its own. Spark's writer puts one zero byte
after each, which readers of gzip take as padding.

Reader: files of any name are read whole by Spark (the writer keeps them near
FILE_BYTES) and walked record by record. Each record is checked: version line,
headers, length, separator, block digest. After a failed check the reader searches
for the next version line (or the next valid gzip member in compressed files), goes
on there and logs the bytes in between as a quarantined gap. A damaged record never
hides those that follow; of a broken member, records that it gave before its fault
and that pass their checks are kept.

Defined results: null html is an empty payload; a null page_id is written as
"null" and read back as null, and never is a response that others refer to; rows
that repeat the smallest page_id of a payload are responses too; other columns are
not read; an empty table gives no rows.
"""

from __future__ import annotations

import gzip
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from .store import cut, folder

REVISIT_BYTES = 100
FILE_BYTES = 32 << 20
#: A list of first copies of at most so many rows is broadcast; beyond that it is joined by a shuffle.
BROADCAST_ROWS = 200_000
STEP = 1 << 16  # bytes of a member that are inflated at once
VERSION = b"WARC/1.1\r\n"
RECORD = "path string, start long, page_id long, record_type string, uri string, payload_bytes long, payload_digest string, refers_to long, reason string, end long"


def with_types(pages: DataFrame) -> DataFrame:
    """pages (page_id, url, html) with payload, digest, n_bytes, record_type and refers_to."""
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    pages = pages.select("page_id", "url", payload.alias("payload"))
    pages = pages.withColumns({"digest": F.sha2("payload", 256), "n_bytes": F.octet_length("payload").cast("long")})
    first = pages.where(F.col("n_bytes") >= REVISIT_BYTES).groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n")).where("n > 1 AND first IS NOT NULL").select("digest", "first")
    first = cut(first)
    few = first.count() <= BROADCAST_ROWS
    joined = pages.join(F.broadcast(first) if few else first, "digest", "left")
    again = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    return joined.select("page_id", "url", "payload", "digest", "n_bytes", F.when(again, "revisit").otherwise("response").alias("record_type"), F.when(again, F.col("first")).alias("refers_to"))


def records(typed: DataFrame) -> DataFrame:
    """One column, value: the bytes of each record but its last separator."""
    line = lambda name, *x: F.concat(F.lit(f"{name}: "), *x, F.lit("\r\n"))
    id_ = F.coalesce(F.col("page_id").cast("string"), F.lit("null"))
    revisit = F.col("record_type") == "revisit"
    block = F.when(revisit, F.lit("").cast("binary")).otherwise(F.col("payload"))
    head = F.concat(
        F.lit(VERSION.decode()), line("WARC-Type", F.col("record_type")), line("WARC-Record-ID", F.lit("<urn:page:"), id_, F.lit(">")),
        line("WARC-Target-URI", F.regexp_replace(F.coalesce("url", F.lit("")), r"[\r\n]", " ")), line("WARC-Date", F.lit("1970-01-01T00:00:00Z")),
        line("WARC-Payload-Digest", F.lit("sha256:"), F.col("digest")), line("WARC-Block-Digest", F.lit("sha256:"), F.sha2(block, 256)),
        F.when(revisit, F.concat(line("WARC-Profile", F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")), line("WARC-Refers-To", F.lit("<urn:page:"), F.col("refers_to").cast("string"), F.lit(">")))).otherwise(""),
        line("X-Payload-Length", F.col("n_bytes").cast("string")), line("Content-Type", F.lit("text/html")), line("Content-Length", F.octet_length(block).cast("string")), F.lit("\r\n"),
    )
    return typed.select(F.concat(head.cast("binary"), block).cast("string").alias("value"))


def write(pages: DataFrame, path: str, compression: str = "none", file_bytes: int = FILE_BYTES) -> None:
    """Write archives of pages below path. compression: none, or gzip for one member a record.

    A task packs its records into files of file_bytes at most; a record that is larger has
    a file of its own, and a task's last file may be small.
    """
    member = compression == "gzip"
    end = b"\0" if member else b"\r\n\r\n"

    def packs(batches):
        held, size = [], 0
        for batch in batches:
            for value in batch["value"]:
                record = gzip.compress(value.as_py() + b"\r\n\r\n", 6, mtime=0) if member else value.as_py()
                if held and size + len(record) + len(end) > file_bytes:
                    yield pa.RecordBatch.from_arrays([pa.array([end.join(held)], pa.binary())], names=["value"])
                    held, size = [], 0
                held.append(record)
                size += len(record) + len(end)
        if held:
            yield pa.RecordBatch.from_arrays([pa.array([end.join(held)], pa.binary())], names=["value"])

    made = records(with_types(pages)).select(F.col("value").cast("binary").alias("value")).mapInArrow(packs, "value binary")
    made.select(F.col("value").cast("string").alias("value")).write.mode("errorifexists").option("lineSep", end.decode()).option("maxRecordsPerFile", 1).text(path)


@dataclass
class Found:
    """A record, or with a reason a quarantined gap."""

    start: int
    end: int
    headers: dict[str, str] = field(default_factory=dict)
    block: bytes = b""
    reason: str = ""


def salvage(data: bytes) -> Iterator[Found]:
    """The records of an archive's bytes, and the gaps between those that pass their checks.

    Of gzip archives the offsets are those of the members; from a member that doesn't
    end well up to the next one that does is a gap, and records that it gave before
    its fault have no extent.
    """
    if data[:2] == b"\x1f\x8b" or (b"\x1f\x8b\x08" in data and VERSION not in data):
        yield from _members(data)
    else:
        yield from _plain(data, 0, len(data))


def _inflated(data: memoryview, at: int) -> tuple[bytes, int, str]:
    """What the member at a place gives, where it ends, and why it is broken, if it is. Read in steps, so that no rest is copied for each member."""
    inflate, out, pos = zlib.decompressobj(31), [], at
    try:
        while pos < len(data) and not inflate.eof:
            out.append(inflate.decompress(data[pos : pos + STEP]))
            pos += STEP
    except zlib.error as e:
        return b"".join(out), at, str(e)
    if not inflate.eof:
        return b"".join(out), at, "member ends early"
    return b"".join(out), min(pos, len(data)) - len(inflate.unused_data), ""


def _members(data: bytes) -> Iterator[Found]:
    view = memoryview(data)
    at = gap = 0
    reason = ""
    while at < len(data):
        if gap == at and data[at] == 0:  # padding
            at = gap = at + 1
            continue
        text, end, why = _inflated(view, at)
        if not why:
            if gap < at:
                yield Found(gap, at, reason=reason or "lost bytes between members")
            for f in _plain(text, 0, len(text)):
                yield Found(at, end, f.headers, f.block, f.reason)
            at = gap = end
            reason = ""
            continue
        reason = reason or why
        for f in _plain(text, 0, len(text)):  # what it gave before its fault
            if not f.reason:
                yield Found(at, at, f.headers, f.block)
        at = data.find(b"\x1f\x8b\x08", at + 1)
        if at < 0:
            break
    if gap < len(data):
        yield Found(gap, len(data), reason=reason or "lost bytes between members")


def _plain(data: bytes, start: int, stop: int) -> Iterator[Found]:
    at = gap = start
    reason = ""
    while at < stop:
        found = _record(data, at, stop)
        if isinstance(found, Found):
            if gap < at:
                yield Found(gap, at, reason=reason or "no version line")
            yield found
            at = gap = found.end
            reason = ""
            continue
        reason = reason or found
        at = data.find(b"WARC/1.", at + 1, stop)
        if at < 0:
            break
    if gap < stop:
        yield Found(gap, stop, reason=reason or "no version line")


def _record(data: bytes, at: int, stop: int) -> Found | str:
    """The record at a place, or why there is none."""
    if not re.compile(rb"WARC/1\.[01]\r\n").match(data, at):
        return "no version line"
    head = data.find(b"\r\n\r\n", at, stop)
    if head < 0:
        return "headers don't end"
    headers = {}
    for line in data[at:head].split(b"\r\n")[1:]:
        name, colon, value = line.partition(b":")
        if not colon:
            return "a header without a colon"
        headers[name.decode("latin-1").strip().lower()] = value.decode("utf-8", "replace").strip()
    length = headers.get("content-length", "")
    if not length.isdigit() or not length.isascii():
        return "no content length"
    begin, end = head + 4, head + 4 + int(length)
    if end + 4 > stop or data[end : end + 4] != b"\r\n\r\n":
        return "the block doesn't end where its length says"
    block = data[begin:end]
    digest = headers.get("warc-block-digest")
    if digest and digest.startswith("sha256:") and digest[7:] != hashlib.sha256(block).hexdigest():
        return "the block's digest differs"
    return Found(at, end + 4, headers, block)


def _page(text: str) -> int | None:
    m = re.fullmatch(r"<urn:page:(-?\d+)>", text or "")
    return int(m[1]) if m else None


def read(spark: SparkSession, path: str) -> DataFrame:
    """Rows of RECORD for archives below path. Rows with a reason are quarantined gaps: bytes start to end of the file."""

    def walk(batches):
        for batch in batches:
            for name, content in zip(batch["path"].to_pylist(), batch["content"], strict=True):
                rows = []
                for f in salvage(content.as_py()):
                    h = f.headers
                    digest = h.get("warc-payload-digest", "").removeprefix("sha256:")
                    kind = h.get("warc-type")
                    if not f.reason and kind == "response":  # measured, not believed
                        digest, length = hashlib.sha256(f.block).hexdigest(), len(f.block)
                    else:
                        length = int(x) if not f.reason and (x := h.get("x-payload-length", "")).isascii() and x.isdigit() else None
                    rows.append((name, f.start, _page(h.get("warc-record-id")), kind, h.get("warc-target-uri"), length, digest or None, _page(h.get("warc-refers-to")), f.reason or None, f.end))
                kinds = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
                columns = list(zip(*rows, strict=True)) or [[]] * len(kinds)
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=[x.split()[0] for x in RECORD.split(", ")])

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInArrow(walk, RECORD)


def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write all pages as archives in the shared folder, and read them back."""
    path = f"{folder(spark)}/warc-{uuid.uuid4().hex}"
    write(spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html"), path)
    return read(spark, path).where("reason IS NULL").select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


SQL = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html, sha256(coalesce(html, '')) AS d, octet_length(encode(coalesce(html, ''))) AS n FROM pages
), f AS (
  SELECT d, min(page_id) AS first FROM p WHERE n >= 100 GROUP BY d HAVING count(*) > 1
)
SELECT page_id, n::BIGINT AS payload_bytes, p.d AS payload_digest, CASE WHEN first IS NOT NULL AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type, CASE WHEN page_id <> first THEN first END AS refers_to
FROM p LEFT JOIN f ON p.d = f.d
"""
