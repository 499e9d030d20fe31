"""WARC archives: writing, and reading with segment reassembly (operator 8).

Writing: every page becomes a ``response`` record (an HTTP response whose body has chunked
transfer framing) or, if an equal payload has a smaller page id, a ``revisit`` record that
refers to it. A block longer than ``segment_bytes`` is split into a first record and
``continuation`` records. Spark's text writer ends each record with the two line ends that
the format asks for, on any file system, into gzip files of a bounded number of records.

Reading: records are cut by their Content-Length. Continuation records are grouped by the
identifier of their origin, put in order by segment number, and checked: numbers without a gap,
the total length as stated, the payload's digest. Then the chunked framing is decoded. Whole
records never enter the shuffle.

Hot payloads: the smallest page id of a payload is found with salted aggregation. One group
of segments is one page.

Defined results: a null html is an empty payload. A row without a page id revisits the smallest
id of its payload, or is a response where there is none. Repeated rows with the smallest
id are all responses. Payloads below ``least`` bytes are all responses. An empty table gives
an empty result. Other columns are ignored. A damaged record gives a row whose ``problem`` says
what is wrong, with null payload columns.
"""

from __future__ import annotations

import base64
import hashlib
import zlib

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.common import Scratch, documents, keyed_min

SEGMENT_BYTES = 8192
CHUNK_BYTES = 4096
FILE_RECORDS = 2000
PIECE = 1 << 16                             # bytes that are inflated at once
CAPTURED = "1970-01-01T00:00:00Z"        # the tables have no capture time
END = b"\r\n"


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def chunked(payload: bytes, size: int = CHUNK_BYTES) -> bytes:
    """Chunked transfer framing of a payload."""
    parts = [payload[i:i + size] for i in range(0, len(payload), size)]
    return b"".join(b"%x\r\n%b\r\n" % (len(p), p) for p in parts) + b"0\r\n\r\n"


def unchunked(body: bytes) -> bytes:
    """The payload of a chunked body; chunk extensions and trailers are passed over."""
    out, i = [], 0
    while True:
        j = body.index(END, i)
        n = int(body[i:j].split(b";")[0], 16)
        if not n:
            return b"".join(out)
        part = body[j + 2:j + 2 + n]
        if len(part) < n or body[j + 2 + n:j + 4 + n] != END:
            raise ValueError("chunk cut short")
        out.append(part)
        i = j + 4 + n


def header(fields: list[tuple[str, object]], first: str = "WARC/1.1") -> bytes:
    clean = lambda v: str(v).replace("\r", "%0D").replace("\n", "%0A")
    return "".join(f"{x}\r\n" for x in [first, *(f"{k}: {clean(v)}" for k, v in fields if v is not None)]
                   ).encode() + END


def page_records(uid: str, page_id: str | None, url: str | None, payload: bytes, first: str | None,
                 segment_bytes: int = SEGMENT_BYTES) -> list[bytes]:
    """The records of one page, without the line ends that close them. ``first``: the page
    that this one revisits."""
    common = [("WARC-Date", CAPTURED), ("WARC-Target-URI", url), ("X-Page-ID", page_id)]
    kind = [("Content-Type", "application/http;msgtype=response"), ("WARC-Payload-Digest", f"sha1:{digest(payload)}")]
    name = f"<urn:page:{page_id}:{uid}"
    if first is not None:
        block = header([("Content-Type", "text/html;charset=utf-8"), ("Content-Length", len(payload))], "HTTP/1.1 200 OK")
        return [header([("WARC-Type", "revisit"), ("WARC-Record-ID", f"{name}>"), *common, *kind,
                        ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
                        ("WARC-Refers-To", f"<urn:page:{first}>"), ("Content-Length", len(block))]) + block]
    block = header([("Content-Type", "text/html;charset=utf-8"), ("Transfer-Encoding", "chunked")],
                   "HTTP/1.1 200 OK") + chunked(payload)
    parts = [block[i:i + segment_bytes] for i in range(0, len(block), segment_bytes)]
    many = len(parts) > 1
    out = [header([("WARC-Type", "response"), ("WARC-Record-ID", f"{name}>"), *common, *kind,
                   ("WARC-Segment-Number", 1 if many else None), ("Content-Length", len(parts[0]))]) + parts[0]]
    for i, part in enumerate(parts[1:], 2):
        out.append(header([("WARC-Type", "continuation"), ("WARC-Record-ID", f"{name}:{i}>"), *common,
                           ("WARC-Segment-Origin-ID", f"{name}>"), ("WARC-Segment-Number", i),
                           ("WARC-Segment-Total-Length", len(block) if i == len(parts) else None),
                           ("Content-Length", len(part))]) + part)
    return out


def write_archives(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url",
                   html_col: str = "html", least: int = 0, segment_bytes: int = SEGMENT_BYTES) -> None:
    """Writes the pages as gzipped WARC files under ``path``."""
    rows = pages.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{url_col}`").alias("url"),
                        F.coalesce(F.col(f"`{html_col}`").cast("binary"), F.lit(b"")).alias("payload"))
    key = F.when(F.length("payload") >= least, F.sha1("payload"))
    rows = keyed_min(rows.withColumn("sha", key), "sha", "id", "first")
    other = F.when(F.col("first").isNotNull() & ~F.col("id").eqNullSafe(F.col("first")), F.col("first"))
    rows = rows.select(F.col("id").cast("string").alias("id"), "url", "payload", other.cast("string").alias("first"))

    def run(batches):
        from pyspark import TaskContext

        part, n = TaskContext.get().partitionId(), 0
        for batch in batches:
            out = []
            for page, url, payload, first in zip(*(batch.column(c).to_pylist() for c in ("id", "url", "payload", "first"))):
                out += page_records(f"{part}.{n}", page, url, payload, first, segment_bytes)
                n += 1
            yield pa.record_batch([pa.array(out, pa.binary())], ["record"])

    made = rows.mapInArrow(run, "record binary")
    # text is bytes to the writer: a cast from binary does not look into them
    (made.select(F.col("record").cast("string").alias("value")).write
     .option("lineSep", "\r\n\r\n").option("compression", "gzip").option("maxRecordsPerFile", FILE_RECORDS)
     .text(path))


# ---------------------------------------------------------------- reading

def records(data: bytes):
    """(fields by lower-case name, block, problem or None) of every record of an uncompressed archive; after a
    damaged record the next one that can be found."""
    i = 0
    while (i := data.find(b"WARC/", i)) >= 0:
        j = data.find(b"\r\n\r\n", i)
        if j < 0:
            yield {}, b"", "header ends early"
            return
        fields = {}
        for line in data[i:j].split(END)[1:]:
            k, _, v = line.partition(b":")
            fields[k.strip().lower().decode("utf-8", "replace")] = v.strip().decode("utf-8", "replace")
        size = fields.get("content-length", "")
        if not (size.isascii() and size.isdigit()):
            yield fields, b"", "no content length"
            i = j + 4
            continue
        n = int(size)
        block = data[j + 4:j + 4 + n]
        yield fields, block, None if len(block) == n else f"block ends after {len(block)} of {n} bytes"
        i = j + 4 + n


def inflate(content: bytes) -> tuple[bytes, str | None]:
    """(all members of a gzip file, or the content as it is; problem): of a damaged file what comes before the damage."""
    out, at = [], 0
    while content[at:at + 2] == b"\x1f\x8b":
        d = zlib.decompressobj(31)
        try:
            while not d.eof and at < len(content):
                out.append(d.decompress(content[at:at + PIECE]))
                at = min(at + PIECE, len(content)) - len(d.unused_data)
        except zlib.error as e:
            return b"".join(out), f"damaged gzip file: {e}"
        if not d.eof:
            return b"".join(out), "gzip file ends early"
    return (b"".join(out) if at else content), None


def archive(content: bytes):
    """Like ``records``, of a file; a file that cannot be read to its end gives a record with the problem."""
    data, problem = inflate(content)
    yield from records(data)
    if problem:
        yield {}, b"", problem


def segment_number(fields: dict) -> int | None:
    """The number of a segment; None for a record that is no segment, or one whose numbers are damaged."""
    numbers = [fields.get(k) for k in ("warc-segment-number", "warc-segment-total-length")]
    origin = fields.get("warc-segment-origin-id") or fields.get("warc-record-id")
    good = numbers[0] is not None and origin is not None and all(x is None or x.isascii() and x.isdigit() for x in numbers)
    return int(numbers[0]) if good else None


ROW = "page_id string, record_type string, refers_to string, payload_digest string, payload_bytes long, problem string"


def page_row(fields: dict, block: bytes, problem: str | None = None) -> tuple:
    """The row of a page from the fields of its first record and its whole block."""
    kind, want = fields.get("warc-type"), fields.get("warc-payload-digest", "").removeprefix("sha1:")
    refers = fields.get("warc-refers-to", "").removeprefix("<urn:page:").removesuffix(">") or None
    size, got = None, None
    if problem is None:
        try:
            head, _, body = block.partition(b"\r\n\r\n")
            http = {k.strip().lower(): v.strip() for k, _, v in (x.partition(b":") for x in head.split(END)[1:])}
            if kind == "revisit":
                size, got = int(http[b"content-length"]), want
            else:
                payload = unchunked(body) if http.get(b"transfer-encoding") == b"chunked" else body
                size, got = len(payload), digest(payload)
                if got != want:
                    size, got, problem = None, None, "payload digest differs"
        except (ValueError, KeyError) as e:
            size, got, problem = None, None, f"damaged block: {e}"
    return fields.get("x-page-id") if fields.get("x-page-id") != "" else None, kind, refers, got, size, problem


def _batch(rows, schema):
    cols = list(zip(*rows)) if rows else [()] * len(schema)
    return pa.record_batch([pa.array(c, f.type) for c, f in zip(cols, schema)], schema=schema)


_ROW = pa.schema([("page_id", pa.string()), ("record_type", pa.string()), ("refers_to", pa.string()),
                  ("payload_digest", pa.string()), ("payload_bytes", pa.int64()), ("problem", pa.string())])
_SEGMENT = pa.schema([("origin", pa.string()), ("number", pa.int64()), ("total", pa.int64()),
                      ("digest", pa.string()), ("page", pa.string()), ("block", pa.binary())])


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """One row per page of the archives under ``path``, reassembled and verified."""
    files = spark.read.format("binaryFile").load(path).select("content")

    def whole(batches):
        for batch in batches:
            for content in batch.column("content"):
                yield _batch([page_row(f, b, p) for f, b, p in archive(content.as_py())
                              if p or segment_number(f) is None], _ROW)

    def segments(batches):
        for batch in batches:
            for content in batch.column("content"):
                rows = []
                for f, b, p in archive(content.as_py()):
                    if p or (n := segment_number(f)) is None:
                        continue
                    total = f.get("warc-segment-total-length")
                    rows.append((f.get("warc-segment-origin-id") or f["warc-record-id"], n, total and int(total),
                                 f.get("warc-payload-digest"), f.get("x-page-id"), b))
                yield _batch(rows, _SEGMENT)

    def assemble(batches):
        for batch in batches:
            rows = []
            for parts in batch.column("parts").to_pylist():
                parts.sort(key=lambda x: x["number"])
                block = b"".join(p["block"] for p in parts)
                total = parts[-1]["total"]
                problem = None
                if [p["number"] for p in parts] != list(range(1, len(parts) + 1)):
                    problem = "segments are missing or repeated"
                elif total != len(block):
                    problem = f"total length is {len(block)}, not {total}"
                first = {"warc-type": "response", "warc-payload-digest": parts[0]["digest"] or ""}
                if parts[0]["page"] is not None:
                    first["x-page-id"] = parts[0]["page"]
                rows.append(page_row(first, block, problem))
            yield _batch(rows, _ROW)

    split = files.mapInArrow(segments, "origin string, number long, total long, digest string, page string, block binary")
    grouped = split.groupBy("origin").agg(F.collect_list(F.struct("number", "total", "digest", "page", "block")).alias("parts"))
    return files.mapInArrow(whole, ROW).unionByName(grouped.select("parts").mapInArrow(assemble, ROW))


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = documents(spark, sf_dir, "pages")
    path = f"{Scratch(spark, 'warc').path}/archives"
    write_archives(pages, path)
    kind = pages.schema["page_id"].dataType
    read = read_archives(spark, path)
    return read.select(F.col("page_id").cast(kind).alias("page_id"), "payload_bytes", "payload_digest", "record_type",
                       F.col("refers_to").cast(kind).alias("refers_to"), "problem")
