"""WARC archives of pages: writing with segments and revisits, and reassembly.

A page's HTTP response is framed in chunks and, if long, cut over a response record and
continuation records that name it. Reading groups records by the identifier of their
origin, orders them by segment number, checks the total length, and decodes the chunks.

Archives are zipped files of whole records, written and read by Spark, so that any
store that it reaches will do. A file holds at most `RECORDS_PER_FILE` records of at most
`SEGMENT_BYTES` each (plus headers), so one fits in a task's memory.
"""

from __future__ import annotations

import gzip
import hashlib
import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradevigil.session import scratch_path

SEGMENT_BYTES, CHUNK_BYTES, RECORDS_PER_FILE = 8192, 4096, 2000
#: Payloads shorter than this are always stored; longer ones once.
REVISIT_BYTES = 100
DATE = "2024-01-01T00:00:00Z"
_SPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")  # name space of URLs, a fixed value


# ---- bytes -------------------------------------------------------------------


def chunked(payload: bytes, size: int = CHUNK_BYTES) -> bytes:
    """HTTP chunked transfer framing, in chunks of whole characters."""
    return b"".join(b"%x\r\n%b\r\n" % (len(p), p) for p in _cuts(payload, size) if p) + b"0\r\n\r\n"


def dechunked(body: bytes) -> bytes:
    """The payload of a chunked body; ValueError if its framing is broken."""
    parts, at = [], 0
    while True:
        end = body.find(b"\r\n", at)
        if end < 0:
            raise ValueError("chunk size is missing")
        size = int(body[at:end].split(b";")[0], 16)
        if not size:
            return b"".join(parts)
        part, at = body[end + 2 : end + 2 + size], end + 4 + size
        if len(part) != size or body[at - 2 : at] != b"\r\n":
            raise ValueError("chunk is cut short")
        parts.append(part)


def _cuts(block: bytes, size: int) -> list[bytes]:
    """Pieces of at most `size` bytes that end between characters of UTF-8, if they can."""
    parts, at = [], 0
    while at < len(block) or not parts:
        end = min(len(block), at + size)
        while at < end < len(block) and block[end] & 0xC0 == 0x80:
            end -= 1
        if end == at:
            end = min(len(block), at + size)
        parts.append(block[at:end])
        at = end
    return parts


def _record(kind: str, name: str, block: bytes, fields: dict) -> bytes:
    lines = [f"WARC-Type: {kind}", f"WARC-Record-ID: <{name}>", f"WARC-Date: {DATE}"]
    lines += [f"{k}: {v}" for k, v in fields.items() if v is not None]
    lines.append(f"Content-Length: {len(block)}")
    return b"WARC/1.0\r\n" + "\r\n".join(lines).encode() + b"\r\n\r\n" + block


def records(name: str, page_id, url: str, payload: bytes, revisit_of=None, segment: int = SEGMENT_BYTES) -> list[bytes]:
    """The records of one page, each without the blank lines that end it."""
    digest = hashlib.sha256(payload).hexdigest()
    fields = {
        "WARC-Target-URI": re.sub(r"[\x00-\x20]", "", url),
        "WARC-Payload-Digest": f"sha256:{digest}",
        "X-Page": "" if page_id is None else page_id,
        "X-Payload-Length": len(payload),
    }
    head = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"
    if revisit_of is not None:
        fields |= {"WARC-Profile": "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest", "X-Refers-To-Page": revisit_of}
        return [_record("revisit", name, head, fields)]
    block = head + chunked(payload)
    parts = _cuts(block, segment)
    if len(parts) == 1:
        return [_record("response", name, block, fields)]
    out = [_record("response", name, parts[0], fields | {"WARC-Segment-Number": 1})]
    for i, part in enumerate(parts[1:], 2):
        more = {"WARC-Segment-Origin-ID": f"<{name}>", "WARC-Segment-Number": i}
        if i == len(parts):
            more["WARC-Segment-Total-Length"] = len(block)
        out.append(_record("continuation", str(uuid.uuid5(_SPACE, f"{name} {i}")), part, more))
    return out


def parsed(archive: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields (names in lower case) and block of each record of an archive, zipped or not."""
    if archive[:2] == b"\x1f\x8b":
        archive = gzip.decompress(archive)
    at = 0
    while at < len(archive):
        end = archive.index(b"\r\n\r\n", at)
        lines = archive[at:end].decode("utf-8").split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"no record at byte {at}")
        fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
        size = int(fields["content-length"])
        block = archive[end + 4 : end + 4 + size]
        if len(block) != size:
            raise ValueError(f"record at byte {at} is cut short")
        yield fields, block
        at = end + 4 + size
        if archive[at : at + 4] != b"\r\n\r\n":
            raise ValueError(f"record at byte {at} does not end")
        at += 4


# ---- archives ----------------------------------------------------------------


def decided(pages: DataFrame) -> DataFrame:
    """`page_id`, `url`, `html` (NULL as empty) and `revisit_of` of each page.

    Of equal payloads of `REVISIT_BYTES` or more the smallest page_id is stored (all rows
    that have it, if ids repeat; a NULL id counts as the largest), the others revisit it. The
    smallest ids are found by an aggregate over digests with map-side combine; the join
    back is split by Spark where one payload fills a large part of the pages.
    """
    html = F.coalesce("html", F.lit(""))
    rows = pages.select("page_id", F.coalesce("url", F.lit("")).alias("url"), html.alias("html"), F.sha2(html, 256).alias("digest"))
    long_enough = F.octet_length(F.coalesce("html", F.lit(""))) >= REVISIT_BYTES
    first = pages.where(long_enough).groupBy(F.sha2(html, 256).alias("digest")).agg(
        F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n")
    )
    first = first.where("n > 1 AND first IS NOT NULL").select("digest", "first")
    revisit = F.when(~F.col("page_id").eqNullSafe(F.col("first")), F.col("first"))
    return rows.join(first, "digest", "left").select("page_id", "url", "html", revisit.alias("revisit_of"))


def write(pages: DataFrame, path: str, segment: int = SEGMENT_BYTES) -> None:
    """Archives of all pages below `path`; at most `RECORDS_PER_FILE` records a file."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for page_id, url, html, revisit_of, number in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                name = f"urn:uuid:{uuid.uuid5(_SPACE, f'{page_id} {number} {url}')}"
                out += records(name, page_id, url, html.encode("utf-8", "surrogatepass"), revisit_of, segment)
                if sum(map(len, out)) > 1 << 24:
                    yield pa.RecordBatch.from_arrays([pa.array([x.decode("utf-8", "surrogatepass") for x in out])], ["value"])
                    out = []
            yield pa.RecordBatch.from_arrays([pa.array([x.decode("utf-8", "surrogatepass") for x in out], pa.string())], ["value"])

    # tells repeated rows apart: unique among the rows of the one job that writes
    rows = decided(pages).withColumn("number", F.monotonically_increasing_id())
    text = rows.mapInArrow(run, "value string").write.option("lineSep", "\r\n\r\n")
    text.option("compression", "gzip").option("maxRecordsPerFile", RECORDS_PER_FILE).text(path)


_FIELDS = "kind string, origin string, number int, page_id string, url string, digest string, refers_to string, size bigint, total bigint"


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """One row per record; `origin` is the record's own id unless it continues another."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                out = []
                for f, block in parsed(content.as_py()):
                    total = f.get("warc-segment-total-length")
                    out.append(
                        {
                            "kind": f["warc-type"],
                            "origin": f.get("warc-segment-origin-id", f["warc-record-id"]),
                            "number": int(f.get("warc-segment-number", 0)),
                            "page_id": f.get("x-page"),
                            "url": f.get("warc-target-uri"),
                            "digest": f.get("warc-payload-digest", "").removeprefix("sha256:"),
                            "refers_to": f.get("x-refers-to-page"),
                            "size": int(f.get("x-payload-length", 0)),
                            "total": total and int(total),
                            "block": block,
                        }
                    )
                yield pa.RecordBatch.from_pylist(out, schema=shape)

    text, number = pa.string(), pa.int64()
    shape = pa.schema(
        [("kind", text), ("origin", text), ("number", pa.int32()), ("page_id", text), ("url", text), ("digest", text)]
        + [("refers_to", text), ("size", number), ("total", number), ("block", pa.binary())]
    )
    files = spark.read.format("binaryFile").load(path).select("content")
    return files.mapInArrow(run, f"{_FIELDS}, block binary")


def reassembled(found: DataFrame) -> DataFrame:
    """One row per origin: the fields of its first record, its whole `block`, and `error`.

    Records without a segment number pass by; segments are grouped by their origin, each
    group as large as its one response. `error` says what is missing: the first segment, one
    in between, or bytes of the stated total length; then `block` is NULL.
    """
    whole = found.where("number = 0").withColumn("error", F.lit(None).cast("string"))
    names = [c for c in found.columns if c not in ("number", "total", "block")]
    group = found.where("number > 0").groupBy("origin").agg(
        *[F.max(F.when(F.col("number") == 1, F.col(c))).alias(c) for c in names if c != "origin"],
        F.max("number").alias("last"),
        F.max("total").alias("total"),
        F.array_sort(F.collect_list(F.struct("number", "block"))).alias("parts"),
    )
    block = F.aggregate("parts", F.lit(b""), lambda done, p: F.concat(done, p["block"]))
    group = group.withColumn("whole", block)
    error = (
        F.when(F.col("kind").isNull(), F.lit("no first segment"))
        .when(F.col("parts.number") != F.sequence(F.lit(1), F.col("last")), F.lit("segments are missing or repeated"))
        .when(~F.col("total").eqNullSafe(F.octet_length("whole").cast("bigint")), F.lit("total length differs"))
    )
    group = group.withColumn("error", error)
    kept = F.when(F.col("error").isNull(), F.col("whole")).alias("block")
    return whole.select(*names, "block", "error").unionByName(group.select(*names, kept, "error"))


def read(spark: SparkSession, path: str) -> DataFrame:
    """One row per page: `page_id`, `url`, `record_type`, `payload` (NULL for revisits),
    `payload_bytes`, `payload_digest`, `refers_to`, `error`. Digests are checked."""
    rows = reassembled(read_records(spark, path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            payloads, errors = [], []
            for kind, digest, block, error in zip(*(batch.column(c).to_pylist() for c in ("kind", "digest", "block", "error")), strict=True):
                payload = None
                if kind == "response" and block is not None:
                    head, _, body = block.partition(b"\r\n\r\n")
                    try:
                        payload = dechunked(body) if b"\r\ntransfer-encoding: chunked" in head.lower() else body
                        if hashlib.sha256(payload).hexdigest() != digest:
                            payload, error = None, "digest differs"
                    except ValueError as e:
                        error = str(e)
                payloads.append(payload)
                errors.append(error)
            names = ["page_id", "url", "kind", "digest", "refers_to", "size"]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(n) for n in names), pa.array(payloads, pa.binary()), pa.array(errors, pa.string())], [*names, "payload", "error"]
            )

    shape = "page_id string, url string, kind string, digest string, refers_to string, size bigint, payload binary, error string"
    found = rows.mapInArrow(run, shape)
    measured = F.when(F.col("kind") == "response", F.octet_length("payload").cast("bigint")).otherwise(F.col("size"))
    return found.select(
        F.when(F.col("page_id") != "", F.col("page_id")).alias("page_id"),
        "url",
        F.col("kind").alias("record_type"),
        "payload",
        measured.alias("payload_bytes"),
        F.when(F.col("error").isNull(), F.col("digest")).alias("payload_digest"),
        "refers_to",
        "error",
    )


def report(pages: DataFrame) -> DataFrame:
    """The columns of `op2_warc_reassembly`: all pages written to archives, and read back."""
    path = scratch_path(pages.sparkSession, "warc")
    write(pages, path)
    kind = pages.schema["page_id"].dataType
    return read(pages.sparkSession, path).select(
        F.col("page_id").cast(kind).alias("page_id"), "payload_bytes", "payload_digest", "record_type", F.col("refers_to").cast(kind).alias("refers_to")
    )


REPORT_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html, strlen(coalesce(html, '')) AS bytes FROM pages),
d AS (SELECT page_id, bytes, sha256(html) AS digest FROM p),
f AS (SELECT *, CASE WHEN bytes >= 100 THEN min(page_id) OVER (PARTITION BY digest) END AS first FROM d)
SELECT page_id, bytes AS payload_bytes, digest AS payload_digest,
  CASE WHEN first IS NOT NULL AND first IS DISTINCT FROM page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN first IS DISTINCT FROM page_id THEN first END AS refers_to
FROM f
"""
