"""Web archives: pages written as WARC records, and archives read back.

Long records are written as segments: a first record, and continuations that name it as their origin. Bodies have
chunked transfer framing. Pages that repeat an earlier payload become revisit records. The reader follows
``Content-Length`` from record to record, puts segments together in the order of their numbers, verifies the total
length, takes the chunks apart and verifies the payload's digest.

Records are written by Spark's text writer: the line separator is the two line ends that close a WARC record.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from furrow.llm.tables import values
from furrow.schemas import require_columns
from furrow.workspace import materialize

VERSION = "WARC/1.1"
END = b"\r\n"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
SEGMENT = 32_768  # bytes of a record's block
CHUNK = 8_192  # bytes of a chunk of a body
RECORDS_PER_FILE = 1_000  # so that a file is read at once
CAPTURED = "2024-01-01T00:00:00Z"

OK, DAMAGED, INCOMPLETE, WRONG_DIGEST = "ok", "damaged", "incomplete", "wrong digest"
READ = pa.schema(
    [
        ("record_id", pa.string()),
        ("record_type", pa.string()),
        ("page_id", pa.int64()),
        ("url", pa.string()),
        ("payload_digest", pa.string()),
        ("payload", pa.binary()),
        ("status", pa.string()),
    ]
)
READ_SCHEMA = (
    "record_id string, record_type string, page_id long, url string, payload_digest string, payload binary, status string"
)
SEGMENTS = pa.schema(
    [("origin", pa.string()), ("number", pa.int64()), ("total", pa.int64()), ("head", pa.string()), ("block", pa.binary())]
)
SEGMENTS_SCHEMA = "origin string, number long, total long, head string, block binary"


def payload_digest(payload: bytes) -> str:
    """SHA-1 in base 32, upper case."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


# Writing


def write_pages(
    pages: DataFrame,
    path: str,
    least_revisit: int = 0,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
    compression: str = "gzip",
) -> None:
    """Write a record per row: a response with the page as payload, or a revisit.

    Of equal payloads of at least ``least_revisit`` bytes the rows with the smallest page id are responses and the
    others revisits. A null page counts as empty. Rows without id are responses. An empty table gives an archive
    without records; other columns take no part.
    """
    require_columns(pages, [id_col, url_col, html_col])
    payload = F.coalesce(pages[html_col].cast("string"), F.lit("")).cast("binary")
    rows = pages.select(
        pages[id_col].cast("long").alias("page_id"), pages[url_col].cast("string").alias("url"), payload.alias("payload")
    )
    rows = rows.withColumn("key", F.sha2("payload", 256))
    firsts = rows.where((F.octet_length("payload") >= least_revisit) & F.col("page_id").isNotNull()).groupBy("key")
    firsts = firsts.agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("copies")).where("copies > 1")
    repeated = materialize(firsts.select("key", "first"), "repeated-payloads")
    revisit = F.coalesce(F.col("page_id") > F.col("first"), F.lit(False)).alias("revisit")
    marked = rows.join(repeated, "key", "left").select("page_id", "url", "payload", revisit)
    records = marked.mapInArrow(_records, "record binary").select(F.col("record").cast("string"))
    writer = records.write.option("lineSep", "\r\n\r\n").option("compression", compression)
    writer.option("maxRecordsPerFile", RECORDS_PER_FILE).text(path)


def _cuts(data: bytes, size: int) -> Iterator[bytes]:
    """Runs of at most ``size`` bytes that end between characters, for the text writer takes no broken ones."""
    at = 0
    while at < len(data):
        end = min(at + size, len(data))
        while end < len(data) and data[end] & 0xC0 == 0x80:
            end -= 1
        yield data[at:end]
        at = end


def chunked(body: bytes) -> bytes:
    """A body in chunked transfer framing."""
    return b"".join(b"%x\r\n%b\r\n" % (len(c), c) for c in _cuts(body, CHUNK)) + b"0\r\n\r\n"


def _record(fields: dict[str, str | int | None], block: bytes) -> bytes:
    fields = {**fields, "Content-Length": len(block)}
    lines = [VERSION, *(f"{name}: {value}" for name, value in fields.items() if value is not None)]
    return "\r\n".join(lines).encode("utf-8") + END + END + block


def page_records(page_id: int | None, url: str | None, payload: bytes, revisit: bool) -> Iterator[bytes]:
    """The records of one page: one, or as many as it has segments."""
    head = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"
    url = None if url is None else "".join(c if c.isprintable() and c != " " else f"%{ord(c):02X}" for c in url)
    identifier = f"<{uuid.uuid4().urn}>"
    fields = {
        "WARC-Type": "revisit" if revisit else "response",
        "WARC-Record-ID": identifier,
        "WARC-Date": CAPTURED,
        "WARC-Target-URI": url,
        "WARC-Page-ID": page_id,
        "WARC-Profile": REVISIT_PROFILE if revisit else None,
        "WARC-Payload-Digest": f"sha1:{payload_digest(payload)}",
        "Content-Type": "application/http; msgtype=response",
    }
    block = head if revisit else head + chunked(payload)
    parts = list(_cuts(block, SEGMENT))
    if len(parts) == 1:
        yield _record(fields, block)
        return
    yield _record({**fields, "WARC-Segment-Number": 1}, parts[0])
    for number, part in enumerate(parts[1:], 2):
        yield _record(
            {
                "WARC-Type": "continuation",
                "WARC-Record-ID": f"<{uuid.uuid4().urn}>",
                "WARC-Date": CAPTURED,
                "WARC-Segment-Origin-ID": identifier,
                "WARC-Segment-Number": number,
                "WARC-Segment-Total-Length": len(block) if number == len(parts) else None,
            },
            part,
        )


def _records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out, size = [], 0
        for row in zip(*map(values, batch.columns)):
            for record in page_records(*row):
                out.append(record)
                size += len(record)
            if size > 4_000_000:
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["record"])
                out, size = [], 0
        yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["record"])


# Reading


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """``(record_id, record_type, page_id, url, payload_digest, payload, status)`` of every response and revisit.

    Records in segments are grouped by their origin. ``status`` tells records that are not whole: ``incomplete`` if a
    segment or the total length is missing or does not agree, ``damaged`` if framing is broken, ``wrong digest``. A
    revisit has no payload of its own (null). The digest of a response is that of the payload as read, null without one;
    that of a revisit is the one it names. Plain and gzip files are read; each file is read at once.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("content")
    whole = files.mapInArrow(_whole, READ_SCHEMA)
    segments = files.mapInArrow(_segments, SEGMENTS_SCHEMA)
    return whole.unionByName(segments.groupBy("origin").applyInArrow(_joined, READ_SCHEMA))


def resolve_revisits(records: DataFrame) -> DataFrame:
    """``(page_id, record_type, payload_bytes, payload_digest, refers_to)``: revisits get the size of the payload they
    stand for and the smallest page id of a response with their digest. A record that is not ``ok`` fails the read."""
    fault = F.raise_error(F.concat_ws(" ", F.lit("WARC record"), "record_id", F.lit("is"), "status")).cast("string")
    digest = F.when(F.col("status") == OK, F.col("payload_digest")).otherwise(fault).alias("payload_digest")
    sized = records.select("page_id", "record_type", F.octet_length("payload").cast("long").alias("own_bytes"), digest)
    sized = materialize(sized, "archive-records")
    originals = sized.where("record_type = 'response'").groupBy("payload_digest")
    originals = originals.agg(F.min("page_id").alias("original"), F.first("own_bytes").alias("bytes"))
    wanted = sized.where("record_type = 'revisit'").select("payload_digest").distinct()
    originals = materialize(originals.join(wanted, "payload_digest"), "revisited")
    revisit = F.col("record_type") == "revisit"
    return sized.join(originals, "payload_digest", "left").select(
        "page_id",
        "record_type",
        F.when(revisit, F.col("bytes")).otherwise(F.col("own_bytes")).alias("payload_bytes"),
        "payload_digest",
        F.when(revisit, F.col("original")).alias("refers_to"),
    )


def records_of(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Named fields and block of every record in the bytes of an archive; a record that is cut off ends the run."""
    if data[:2] == b"\x1f\x8b":
        data = _unzipped(data)
    at = 0
    while (at := data.find(b"WARC/", at)) >= 0 and (end := data.find(END + END, at)) >= 0:
        lines = data[at:end].decode("utf-8", "replace").split("\r\n")[1:]
        fields = {name.strip().lower(): value.strip() for name, _, value in (line.partition(":") for line in lines)}
        length = fields.get("content-length", "")
        if not length.isdigit() or end + 4 + int(length) > len(data):
            return
        at = end + 4 + int(length)
        yield fields, data[end + 4 : at]


def _unzipped(data: bytes) -> bytes:
    out = []
    while data:
        member = zlib.decompressobj(wbits=31)
        out.append(member.decompress(data))
        data = member.unused_data
    return b"".join(out)


def unchunked(body: bytes) -> bytes | None:
    """The body without chunked transfer framing; null if the framing is broken."""
    out, at = [], 0
    while True:
        end = body.find(END, at)
        try:
            size = int(body[at:end].split(b";")[0], 16) if end >= 0 else -1
        except ValueError:
            size = -1
        if size < 0:
            return None
        if size == 0:
            return b"".join(out)
        at = end + 2 + size
        if body[at : at + 2] != END:
            return None
        out.append(body[end + 2 : at])
        at += 2


def http_payload(block: bytes) -> bytes | None:
    """Body of an HTTP response; null if it cannot be taken apart."""
    head, found, body = block.partition(END + END)
    if not found:
        return None
    return unchunked(body) if b"transfer-encoding: chunked" in head.lower() else body


def _decoded(fields: dict[str, str], block: bytes | None) -> tuple:
    """One row of :func:`read_archive`."""
    kind, page = fields.get("warc-type"), fields.get("warc-page-id")
    digest = fields.get("warc-payload-digest", "").removeprefix("sha1:") or None
    payload, status = None, INCOMPLETE if block is None else OK
    if kind == "response" and block is None:
        digest = None
    elif kind == "response":
        payload, said = http_payload(block), digest
        digest = None if payload is None else payload_digest(payload)
        status = DAMAGED if payload is None else OK if digest == said else WRONG_DIGEST
    page_id = int(page) if page and page.lstrip("-").isdigit() else None
    return fields.get("warc-record-id"), kind, page_id, fields.get("warc-target-uri"), digest, payload, status


def _table(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows) if rows else [[] for _ in schema]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def _whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for data in values(batch.column(0)):
            rows = [
                _decoded(fields, block)
                for fields, block in records_of(data)
                if fields.get("warc-type") in ("response", "revisit") and "warc-segment-number" not in fields
            ]
            yield _table(rows, READ)


def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for data in values(batch.column(0)):
            rows = []
            for fields, block in records_of(data):
                number = fields.get("warc-segment-number", "")
                if number.isdigit():
                    first = fields.get("warc-type") != "continuation"
                    origin = fields.get("warc-record-id" if first else "warc-segment-origin-id")
                    total = fields.get("warc-segment-total-length", "")
                    head = "\n".join(f"{k}:{v}" for k, v in fields.items()) if first else None
                    rows.append((origin, int(number), int(total) if total.isdigit() else None, head, block))
            yield _table(rows, SEGMENTS)


def _joined(table: pa.Table) -> pa.Table:
    """One record from its segments."""
    parts = {}
    fields, total = {}, None
    for number, length, head, block in zip(*(values(table.column(c)) for c in ("number", "total", "head", "block"))):
        parts[number] = block
        total = length if length is not None else total
        if head is not None:
            fields = dict(line.split(":", 1) for line in head.split("\n"))
    if not fields:  # continuations of a record that is not in the archive
        return READ.empty_table()
    block = b"".join(parts[number] for number in sorted(parts))
    whole = sorted(parts) == list(range(1, len(parts) + 1)) and len(block) == total
    return pa.Table.from_batches([_table([_decoded(fields, block if whole else None)], READ)])
