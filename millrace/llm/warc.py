"""WARC archives: a writer of one gzip member per record with revisits for equal payloads, and a salvage reader.

Archives are written and read by Spark's own sources, so they may lie in any store that Spark reaches and their commit
is that of any Spark job. A member ends with the top byte of its length, 0 below 16 MB (a larger record gets an empty
last member), and 0 is the separator that the text sink puts after each value.

The reader takes members and plain records alike. Where a check fails (member, version line, header, length, ending,
digest), it looks for the next byte from which a record can be read in full, recovers what follows, and reports the
bytes between as a gap.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm._common import scratch_path, table

VERSION = b"WARC/1.1"
#: Uncompressed bytes that an archive file should hold; a file is read by one task at a time.
FILE_BYTES = 32 << 20
#: Bytes of payload in a batch that the reader passes on.
BATCH_BYTES = 8 << 20
DATE = "2024-01-01T00:00:00Z"
#: Payloads from this size on become revisits when an equal one is kept.
REVISIT_BYTES = 1000
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def _digest(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def _one_line(value: str) -> str:
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", value)


def record_bytes(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, *, revisit: bool, date: str = DATE) -> bytes:
    """A record, uncompressed. The payload follows HTTP headers; a revisit has the headers alone."""
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload) + (b"" if revisit else payload)
    name = lambda n: f"<urn:page:{'none' if n is None else n}>"
    fields = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", name(page_id)),
        ("WARC-Date", date),
        ("WARC-Target-URI", _one_line(url or "urn:none")),
        ("Content-Type", "application/http; msgtype=response"),
        ("WARC-Payload-Digest", _digest(payload)),
        ("WARC-Block-Digest", _digest(block)),
        ("X-Payload-Length", str(len(payload))),
    ]
    if revisit:
        fields += [("WARC-Refers-To", name(refers_to)), ("WARC-Profile", _PROFILE)]
    head = "".join(f"{k}: {v}\r\n" for k, v in [*fields, ("Content-Length", str(len(block)))])
    return VERSION + b"\r\n" + head.encode() + b"\r\n" + block + b"\r\n\r\n"


def _gzip(data: bytes) -> bytes:
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def member(record: bytes) -> bytes:
    """The record as gzip, ending with a byte 0."""
    packed = _gzip(record)
    return packed if packed[-1] == 0 else packed + _gzip(b"")


def _members(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        page, url, html, keeper, revisit = batch.columns
        out, held = [], 0
        for k in range(batch.num_rows):
            payload = (html[k].as_py() or "").encode()
            out.append(member(record_bytes(page[k].as_py(), url[k].as_py(), payload, keeper[k].as_py(), revisit=revisit[k].as_py()))[:-1])
            held += len(out[-1])
            if held > BATCH_BYTES:
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["value"])
                out, held = [], 0
        yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["value"])


def plan_records(pages: DataFrame) -> DataFrame:
    """(page_id, url, html, keeper, revisit): among rows with equal payloads of REVISIT_BYTES or more, those of the
    largest page_id are responses and the others revisits of it."""
    rows = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"))
    rows = rows.withColumn("digest", F.when(F.octet_length("html") >= REVISIT_BYTES, F.unhex(F.sha1("html"))))
    shared = rows.where("digest IS NOT NULL").groupBy("digest").agg(F.count(F.lit(1)).alias("n"), F.max("page_id").alias("keeper")).where("n > 1").drop("n")
    joined = rows.join(shared, "digest", "left")
    return joined.select("page_id", "url", "html", "keeper", (F.col("keeper").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("keeper"))).alias("revisit"))


def write_warc(pages: DataFrame, path: str) -> None:
    """Writes a record per row of pages (page_id, url, html; other columns are ignored) into archives below path.

    A null html is an empty payload, a null url becomes urn:none, a null page_id is never the kept one of a group that
    has another; where all are null, or rows repeat the largest page_id, all of them are responses. An empty table
    gives archives without records.
    """
    per_file = pages.agg(F.avg(F.octet_length("html"))).first()[0] or 0.0
    (
        plan_records(pages)
        .mapInArrow(_members, "value binary")
        .select(F.col("value").cast("string").alias("value"))
        .write.option("lineSep", "\0")
        .option("maxRecordsPerFile", max(1, int(FILE_BYTES / (per_file + 600))))
        .text(path)
    )


@dataclass
class Item:
    """A record (reason is None) or a gap."""

    offset: int
    length: int
    reason: str | None
    headers: dict[str, str]
    block: bytes


_CANDIDATE = re.compile(rb"\x1f\x8b\x08|WARC/1\.[01]\r?\n")
_HEADER = re.compile(rb"WARC/1\.[01]\r?\n((?:[!-9;-~]+:[^\n]*\n)*)\r?\n")


class Damage(ValueError):
    pass


def parse_record(data: bytes, at: int) -> tuple[int, dict[str, str], bytes]:
    """The record at this byte: where it ends, its fields in lower case, its block. Raises Damage."""
    head = _HEADER.match(data, at)
    if not head:
        raise Damage("header")
    headers = {}
    try:
        fields = head[1].decode()
    except UnicodeDecodeError:
        raise Damage("header") from None
    for line in fields.splitlines():
        key, _, value = line.partition(":")
        headers[key.strip().lower()] = value.strip()
    length = headers.get("content-length", "")
    if not length.isdigit() or "warc-type" not in headers or "warc-record-id" not in headers:
        raise Damage("fields")
    end = head.end() + int(length)
    if data[end : end + 4] != b"\r\n\r\n":
        raise Damage("length")
    block = data[head.end() : end]
    stated = headers.get("warc-block-digest", "")
    if stated.startswith("sha1:") and stated != _digest(block):
        raise Damage("digest")
    return end + 4, headers, block


def _unpack(data: bytes, at: int) -> tuple[int | None, bytes, str]:
    """The gzip member at this byte: where it ends (None: it can't be read to its end), what could be inflated of it,
    and why no more."""
    reader, out = zlib.decompressobj(31), []
    end = at
    while not reader.eof:
        if end >= len(data):
            return None, b"".join(out), "cut member"
        piece = data[end : end + (1 << 16)]
        try:
            out.append(reader.decompress(piece))
        except zlib.error:
            # the piece once more, byte by byte: what comes before the bad one counts
            again, whole = zlib.decompressobj(31), data[at:end]
            out = [again.decompress(whole)]
            for k in range(len(piece)):
                try:
                    out.append(again.decompress(piece[k : k + 1]))
                except zlib.error:
                    break
            return None, b"".join(out), "member"
        end += len(piece)
    return end - len(reader.unused_data), b"".join(out), ""


def _plain_items(data: bytes, start: int, stop: int) -> Iterator[tuple[int, int, str | None, dict[str, str], bytes]]:
    """(from, to, reason, fields, block) of plain records and gaps between two bytes."""
    at, gap, reason = start, None, ""
    while at < stop:
        try:
            end, headers, block = parse_record(data, at)
        except Damage as why:
            if gap is None:
                gap, reason = at, str(why)
            found = data.find(VERSION[:7], at + 1, stop)
            at = stop if found < 0 else found
            continue
        if gap is not None:
            yield gap, at, reason, {}, b""
            gap = None
        yield at, end, None, headers, block
        at = end
    if gap is not None:
        yield gap, stop, reason, {}, b""


def salvage(data: bytes) -> Iterator[Item]:
    """Records and gaps of an archive, in order; together they cover every byte but empty members and line ends.

    Records of a member have the member's place. A gap inside a member has the member's place too, and its reason tells
    the inflated bytes; a member that can't be inflated to its end gives the records before the damage, and then a gap
    of the member's place up to the next record or member that can be read.
    """
    at, gap, reason = 0, None, ""
    while at < len(data):
        found: list[Item] = []
        end: int | None = None
        if data.startswith(b"\x1f\x8b\x08", at):
            end, raw, why = _unpack(data, at)
            parts = list(_plain_items(raw, 0, len(raw)))
            if end is not None:
                found = [Item(at, end - at, r and f"{r}: bytes {a} to {b} of the member", h, block) for a, b, r, h, block in parts]
                if parts and all(r for _, _, r, _, _ in parts):
                    found, end, why = [], None, parts[0][2]
            elif any(r is None for _, _, r, _, _ in parts):
                # a true member: what it gave counts, and its rest is a gap
                found = [Item(at, 0, None, h, block) for _, _, r, h, block in parts if r is None]
        elif data.startswith(b"WARC/1.", at):
            try:
                end, headers, block = parse_record(data, at)
                found = [Item(at, end - at, None, headers, block)]
            except Damage as damage:
                why = str(damage)
        else:
            why = "no record"
        if gap is not None and (found or end is not None):
            yield Item(gap, at - gap, reason, {}, b"")
            gap = None
        yield from found
        if end is not None:
            at = end
            continue
        if gap is None:
            gap, reason = at, why
        nxt = _CANDIDATE.search(data, at + 1)
        at = nxt.start() if nxt else len(data)
    if gap is not None:
        yield Item(gap, len(data) - gap, reason, {}, b"")


_FIELDS = (("path", pa.string()), ("offset", pa.int64()), ("length", pa.int64()), ("gap_reason", pa.string()), ("warc_type", pa.string()), ("record_id", pa.string()), ("target_uri", pa.string()), ("refers_to", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("payload", pa.binary()))
_READ = "path string, offset bigint, length bigint, gap_reason string, warc_type string, record_id string, target_uri string, refers_to string, payload_bytes bigint, payload_digest string, payload binary"


def _row(path: str, item: Item) -> tuple:
    if item.reason is not None:
        return (path, item.offset, item.length, item.reason, None, None, None, None, None, None, None)
    h = item.headers
    kind = h["warc-type"]
    payload = item.block.partition(b"\r\n\r\n")[2] if h.get("content-type", "").startswith("application/http") else item.block
    if kind == "revisit":
        stated = h.get("warc-payload-digest", "").removeprefix("sha1:")
        digest, size = base64.b32decode(stated).hex() if re.fullmatch("[A-Z2-7]{32}", stated) else None, h.get("x-payload-length")
        return (path, item.offset, item.length, None, kind, h["warc-record-id"], h.get("warc-target-uri"), h.get("warc-refers-to"), int(size) if size and size.isdigit() else None, digest, None)
    return (path, item.offset, item.length, None, kind, h["warc-record-id"], h.get("warc-target-uri"), h.get("warc-refers-to"), len(payload), hashlib.sha1(payload).hexdigest(), payload)


def _salvaged(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def batch(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kind) for k, (_, kind) in enumerate(_FIELDS)], names=[n for n, _ in _FIELDS])

    for files in batches:
        for path, content in zip(files.column(0), files.column(1)):
            rows, held = [], 0
            for item in salvage(content.as_py()):
                rows.append(_row(path.as_py(), item))
                held += len(item.block)
                if held > BATCH_BYTES or len(rows) >= 5000:
                    yield batch(rows)
                    rows, held = [], 0
            yield batch(rows)


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """Rows of records and gaps (gap_reason not null: bytes offset to offset + length of the file are quarantined).

    payload_bytes and payload_digest (lower-case hex SHA-1) are those of the full payload: read from the payload, or
    for revisits from the record's fields. Any file below path is taken as an archive.
    """
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", "content").mapInArrow(_salvaged, _READ)


def op6_warc(spark, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "warc")
    write_warc(table(spark, sf_dir, "pages"), path)
    page = lambda c: F.regexp_extract(c, "^<urn:page:(-?\\d+)>$", 1)
    number = lambda c: F.when(page(c) != "", page(c)).cast("bigint")
    # a gap, which archives just written should not have, is a row without a page
    kind = F.when(F.col("gap_reason").isNotNull(), F.concat(F.lit("gap: "), "gap_reason")).otherwise(F.col("warc_type"))
    return read_warc(spark, path).select(number("record_id").alias("page_id"), "payload_bytes", "payload_digest", kind.alias("record_type"), number("refers_to").alias("refers_to"))


OP6_SQL = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
g AS (SELECT h, max(page_id) AS keeper FROM p WHERE strlen(h) >= {REVISIT_BYTES} GROUP BY h HAVING max(page_id) IS NOT NULL)
SELECT p.page_id, CAST(strlen(p.h) AS BIGINT) AS payload_bytes, sha1(p.h) AS payload_digest,
       CASE WHEN g.keeper IS NULL OR p.page_id IS NOT DISTINCT FROM g.keeper THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN g.keeper IS NULL OR p.page_id IS NOT DISTINCT FROM g.keeper THEN NULL ELSE g.keeper END AS refers_to
FROM p LEFT JOIN g ON p.h = g.h"""
