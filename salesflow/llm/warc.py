"""WARC archives: a writer with revisit records and a salvage reader.

Writing: one record per page. Of pages with equal payloads (by SHA-256 and size) of at least ``least_bytes``, the least page_id is a
``response`` and the others ``revisit`` it; smaller payloads are all responses. Records are made as text by Spark and written by its own
text writer, where the pages are read, so any store that Spark writes works and no payload is moved to balance files. Pages are written by class of
size, so that a few long pages cannot swell a file: one holds about ``ARCHIVE_BYTES``, never more than twice that, or one record.

Reading: an archive file is read whole by one task (Spark's binary source; at most 2 GB) and parsed record by record, in place, plain or as
gzip members. A record is checked: version line, header block of any length, Content-Length within the file, the two line ends after the
block, and the payload digest if there is one. After a failed check the reader searches for the next gzip member or version line from which
a record passes all checks, and logs the bytes in between as one ``gap`` row with the first reason. Nothing is dropped silently.

A member may hold many records. It is inflated piece by piece, and only the record at hand is held, whatever the member's size; a record that
claims more than ``MOST`` bytes, which no row can hold, is a gap. Bytes between records of an intact member are gaps too. Of a broken or truncated member every record
that passes its checks is recovered, up to the broken byte, and the member's bytes are a gap. ``offset`` and ``length`` count bytes of the
archive and cover it without overlap: the rows of one member share its offset and the last of them carries its length, records of a broken
one have length 0. ``inner_offset`` and ``inner_length`` count inflated bytes, null where the row is a plain record or a whole member.

Edge cases: null html is an empty payload; a null url has no target line; line ends in a url are percent-encoded; a null page_id gets
a record id without a number, is never a revisit's target unless the whole group has none, and reads back as null; rows with one
page_id and payload are all responses; a revisit whose response was lost has null payload_bytes; an empty archive or table gives no rows;
other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import math
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, replace

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from salesflow.llm.shared import stored, work_path

ID_PREFIX = "urn:page:"
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
BATCH_BYTES = 4 << 20
ARCHIVE_BYTES, HEAD_BYTES, CLASS_FACTOR = 64 << 20, 600, 8
CHUNK, PIECE, MOST = 64 << 10, 1 << 20, (1 << 31) - (1 << 20)
_VERSION = re.compile(rb"WARC/\d\.\d\r\n")
_VERSION_BYTES = 10
_CANDIDATE = re.compile(rb"WARC/\d\.\d\r\n|\x1f\x8b\x08")
_LINE_END, _BLANK_LINE = re.compile(rb"\r\n"), re.compile(rb"\r\n\r\n")
SCHEMA = ("kind string, archive string, offset long, length long, record_type string, record_id string, target_uri string, refers_to string, "
          "payload_digest string, payload_bytes long, payload binary, reason string, inner_offset long, inner_length long")


def base32_sha1(data: Column) -> Column:
    """SHA-1 in upper-case base32: five hexadecimal digits make four letters."""
    digits = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
    number = lambda at: F.conv(F.substring(F.sha1(data), at, 5), 16, 10).cast("int")
    return F.concat(*[F.substring(F.lit(digits), F.shiftright(number(at), shift).bitwiseAND(F.lit(31)) + 1, F.lit(1)) for at in range(1, 41, 5) for shift in (15, 10, 5, 0)])


def records(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """page_id, record: the bytes of each page's record as text, without its last line end; most_bytes: no record is longer."""
    page = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", F.coalesce("html", F.lit("")).alias("payload")).select(
        "*", F.octet_length("payload").cast("long").alias("size"), F.sha2(F.col("payload").cast("binary"), 256).alias("same"))
    groups = page.where(F.col("size") >= least_bytes).groupBy("same", "size").agg(F.min("page_id").alias("first_id"), F.count(F.lit(1)).alias("n"))
    several = stored(groups.where("n > 1").drop("n"), "payloads")
    joined = page.join(several, ["same", "size"], "left")
    revisit = F.col("first_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_id"))
    identifier = lambda c: F.concat(F.lit(f"<{ID_PREFIX}"), F.coalesce(c.cast("string"), F.lit("")), F.lit(">"))
    uri = F.regexp_replace(F.regexp_replace("url", "\r", "%0D"), "\n", "%0A")
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("size").cast("string"), F.lit("\r\n\r\n"))
    head = F.concat(
        F.lit("WARC/1.1\r\n"), line("WARC-Type", F.when(revisit, "revisit").otherwise("response")), line("WARC-Record-ID", identifier(F.col("page_id"))), line("WARC-Date", F.lit(DATE)),
        F.coalesce(line("WARC-Target-URI", uri), F.lit("")), line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), base32_sha1(F.col("payload").cast("binary")))))
    response = F.concat(line("Content-Type", F.lit("application/http;msgtype=response")), line("Content-Length", (F.col("size") + F.octet_length(http)).cast("string")), F.lit("\r\n"), http, F.col("payload"))
    again = F.concat(line("WARC-Profile", F.lit(PROFILE)), line("WARC-Refers-To", identifier(F.col("first_id"))), F.lit("Content-Length: 0\r\n\r\n"))
    # A line end in a url takes three bytes.
    most = F.col("size") + 3 * F.coalesce(F.octet_length("url"), F.lit(0)) + HEAD_BYTES
    return joined.select("page_id", F.concat(head, F.when(revisit, again).otherwise(response), F.lit("\r\n")).alias("record"), most.alias("most_bytes"))


def write_archives(pages: DataFrame, path: str, least_bytes: int = 0) -> int:
    """WARC files in a folder per class of size; the writer's line end completes each record. Returns the number of pages.

    Records of up to twice the mean size share a class, at least half of all; beyond, a class covers a ``CLASS_FACTOR`` of sizes and its
    files hold what fits at the greatest. Each class reads the pages once more.
    """
    made = records(pages, least_bytes)
    n, mean = made.agg(F.count(F.lit(1)), F.avg("most_bytes")).first()
    common = 2 * (mean or HEAD_BYTES)
    size_class = F.greatest(F.lit(0), F.ceil(F.log(F.col("most_bytes") / common) / math.log(CLASS_FACTOR))).cast("int")
    present = {0} | {r["c"] for r in made.select(size_class.alias("c")).distinct().collect()}  # a few classes
    for c in sorted(present):
        per_file = max(1, int(ARCHIVE_BYTES / (common * CLASS_FACTOR ** c if c else common / 2)))
        made.where(size_class == c).select("record").write.option("lineSep", "\r\n").option("maxRecordsPerFile", per_file).text(f"{path}/sizes-{c}")
    return n


@dataclass
class Record:
    offset: int
    length: int
    headers: dict[str, str]
    payload: memoryview
    inner_offset: int | None = None
    inner_length: int | None = None


# (offset, length, reason), within an intact member also (inner offset, inner length).
Gap = tuple


def parse_record(data: bytes | memoryview, at: int) -> tuple[Record | None, str]:
    """The record at ``at``, or None and the check that failed."""
    version = _VERSION.match(data, at)
    if not version:
        return None, "no version line"
    end = version.end()
    headers: dict[str, str] = {}
    while (line := _LINE_END.search(data, end)) is None or line.start() != end:
        if line is None:
            return None, "header without end"
        name, colon, value = bytes(data[end:line.start()]).partition(b":")
        if not colon or not name.strip():
            return None, "malformed header"
        headers[name.strip().decode("utf-8", "replace").lower()] = value.strip().decode("utf-8", "replace")
        end = line.end()
    if not re.fullmatch(r"[0-9]{1,18}", headers.get("content-length", ""), re.ASCII) or "warc-type" not in headers:
        return None, "missing length or type"
    start = end + 2
    stop = start + int(headers["content-length"])
    if stop - at > MOST:
        return None, "longer than a row"
    if stop + 4 > len(data):
        return None, "truncated"
    if data[stop:stop + 4] != b"\r\n\r\n":
        return None, "wrong length"
    if headers.get("content-type", "").startswith("application/http"):
        blank = _BLANK_LINE.search(data, start, stop)
        start = blank.end() if blank else stop
    payload = memoryview(data)[start:stop]
    named = headers.get("warc-payload-digest", "")
    if headers["warc-type"] != "revisit" and named.lower().startswith("sha1:") and base64.b32encode(hashlib.sha1(payload).digest()).decode() != named[5:].upper():
        return None, "wrong digest"
    return Record(at, stop + 4 - at, headers, payload), ""


class Member:
    """A gzip member, inflated in pieces; afterwards ``reason`` is empty if it is intact, and ``end`` is where it ends or breaks."""

    def __init__(self, data: memoryview, at: int):
        self.data, self.at, self.end, self.reason = data, at, len(data), "truncated member"

    def pieces(self) -> Iterator[bytes]:
        unpack, at, step, feed = zlib.decompressobj(31), self.at, CHUNK, b""
        while not unpack.eof:
            if not feed:
                feed = self.data[at:at + step]
                at += len(feed)
                if not feed:
                    yield unpack.flush()
                    return
            before = unpack.copy() if step > 1 else None
            try:
                out = unpack.decompress(feed, PIECE)
            except zlib.error:
                if before is None:
                    self.end, self.reason = at, "broken member"
                    return
                # Once more, byte by byte: what stands before the broken byte counts.
                unpack, at, step, feed = before, at - len(feed), 1, b""
                continue
            feed = unpack.unconsumed_tail
            if out:
                yield out
        self.end, self.reason = at - len(unpack.unused_data), ""


def _within(pieces: Iterator[bytes]) -> Iterator[tuple[int, int, Record | str]]:
    """(inner offset, inner length, record or the reason of a gap) for the inflated pieces of a member."""
    held, base, at, want, more = b"", 0, 0, PIECE, True
    lost, reason = -1, ""
    while True:
        if more and len(held) - at < want:
            parts, size = [held[at:]], len(held) - at
            while size < want and (piece := next(pieces, None)) is not None:
                parts.append(piece)
                size += len(piece)
            held, base, at, more = b"".join(parts), base + at, 0, size >= want
        if at >= len(held):
            break
        record, why = parse_record(held, at)
        if record:
            if lost >= 0:
                yield lost, base + at - lost, reason
                lost = -1
            yield base + at, record.length, record
            at, want = at + record.length, PIECE
            continue
        if more and why in ("truncated", "header without end") and want <= MOST:
            want *= 2
            continue
        if lost < 0:
            lost, reason = base + at, why
        found = _VERSION.search(held, at + 1)
        # Without a version line in sight one may still begin in the last bytes held.
        at = found.start() if found else max(at + 1, len(held) - _VERSION_BYTES + 1) if more else len(held)
        want = PIECE
    if lost >= 0:
        yield lost, base + len(held) - lost, reason


def _span(row: Record | Gap, length: int) -> Record | Gap:
    return replace(row, length=length) if isinstance(row, Record) else (row[0], length, *row[2:])


def salvage(data: bytes | memoryview) -> Iterator[Record | Gap]:
    """Records in order, and gaps for bytes that belong to no valid record."""
    data = memoryview(data)
    at, lost, reason = 0, -1, ""
    # Headers of records recovered from a broken member, which may stand uncompressed in its bytes up to ``broken_to``. A record of which
    # a block border there changes the headers is given again rather than risk to lose another.
    recovered: set[int] = set()
    broken_to = 0

    def known(record: Record) -> int:
        return hash(frozenset(record.headers.items()))

    while at < len(data):
        if data[at:at + 2] == b"\x1f\x8b":
            member, last, gaps, names = Member(data, at), None, [], set()
            for inner, length, x in _within(member.pieces()):
                if not isinstance(x, Record):
                    gaps.append((at, 0, x, inner, length))
                    continue
                if at < broken_to and known(x) in recovered:
                    continue
                names.add(known(x))
                if lost >= 0:
                    yield lost, at - lost, reason
                    lost = -1
                if last:
                    yield last
                last = Record(at, 0, x.headers, x.payload, inner, length)
            size = member.end - at
            if not member.reason:
                if lost >= 0:
                    yield lost, at - lost, reason
                    lost = -1
                rows = [*([last] if last else []), *gaps]
                if last and not gaps and last.inner_offset == 0:
                    rows = [replace(last, inner_offset=None, inner_length=None)]
                yield from rows[:-1]
                yield _span(rows[-1], size) if rows else (at, size, "empty member")
                at = member.end
                continue
            if last:
                yield last
            recovered = recovered | names if at < broken_to else names
            broken_to = max(broken_to, member.end)
            why = member.reason
        else:
            record, why = parse_record(data, at)
            if record and not (at < broken_to and known(record) in recovered):
                if lost >= 0:
                    yield lost, at - lost, reason
                    lost = -1
                yield record
                at += record.length
                continue
            why = why or "broken member"
        if lost < 0:
            lost, reason = at, why
        found = _CANDIDATE.search(data, at + 1)
        at = found.start() if found else len(data)
    if lost >= 0:
        yield lost, len(data) - lost, reason


def read_archives(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """Rows of SCHEMA: ``record`` rows, and ``gap`` rows for quarantined bytes; ``payloads=False`` leaves the payload column null."""
    names = ["kind", "archive", "offset", "length", "record_type", "record_id", "target_uri", "refers_to", "payload_digest", "payload_bytes", "payload", "reason", "inner_offset", "inner_length"]
    kinds = [pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.binary(), pa.string(), pa.int64(), pa.int64()]

    def row(archive: str, x) -> tuple:
        if not isinstance(x, Record):
            return "gap", archive, x[0], x[1], None, None, None, None, None, None, None, x[2], *(x[3:] or (None, None))
        h = x.headers
        kind = h["warc-type"]
        digest = h.get("warc-payload-digest", "").rpartition(":")[2] or None
        return ("record", archive, x.offset, x.length, kind, h.get("warc-record-id"), h.get("warc-target-uri"), h.get("warc-refers-to"), digest,
                None if kind == "revisit" else len(x.payload), bytes(x.payload) if payloads and kind != "revisit" else None, None, x.inner_offset, x.inner_length)

    def build(batches):
        for batch in batches:
            for archive, content in zip(batch.column(0), batch.column(1)):
                rows, size = [], 0
                for x in salvage(memoryview(content.as_buffer())):
                    rows.append(row(archive.as_py(), x))
                    size += 512 + len(rows[-1][10] or b"")
                    if size > BATCH_BYTES:
                        yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)], names=names)
                        rows, size = [], 0
                yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)], names=names)

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.select("path", "content").mapInArrow(build, SCHEMA)


def page_number(identifier: Column) -> Column:
    return F.nullif(F.regexp_extract(identifier, f"^<{ID_PREFIX}(-?[0-9]*)>$", 1), F.lit("")).cast("long")


def archived(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """Writes archives to the shared folder, reads them back: page_id, payload_bytes, payload_digest, record_type, refers_to.

    Fails if the number of records read is not that of the pages written.
    """
    spark = pages.sparkSession
    path = work_path(spark, "warc")
    written = write_archives(pages, path, least_bytes)
    found = read_archives(spark, path, payloads=False).where("kind = 'record'")
    read = stored(found.select(page_number(F.col("record_id")).alias("page_id"), "payload_bytes", "payload_digest", "record_type", page_number(F.col("refers_to")).alias("refers_to")), "read")
    if (n := read.count()) != written:
        raise RuntimeError(f"{n} records read of {written} pages written")
    responses = read.where("record_type = 'response'")
    # Rows with one page_id may hold different payloads; the digest tells which is meant. Equal rows are folded first.
    sizes = stored(responses.groupBy(F.col("page_id").alias("of"), F.col("payload_digest").alias("digest")).agg(F.max("payload_bytes").alias("bytes")), "responses")
    again = read.where("record_type = 'revisit'")
    met = again.join(sizes, (again["refers_to"] == sizes["of"]) & (again["payload_digest"] == sizes["digest"]), "left")
    return responses.unionByName(met.select("page_id", F.col("bytes").alias("payload_bytes"), "payload_digest", "record_type", "refers_to"))
