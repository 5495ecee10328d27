"""WARC archives: writing pages as records, reading archives back and reassembling segments.

A page is a ``response`` record whose block is an HTTP response in chunked transfer framing. A block longer than
``segment_bytes`` is split: the first part stays a response with segment number 1, the others are ``continuation``
records with the first one's identifier as origin; the last one states the total length. Of pages with equal payloads
the one with the largest id is the response, the others are ``revisit`` records without a payload.

Every record is a gzip member of its own. Members are packed to ``PACK_BYTES`` and at most ``PACKS_PER_FILE`` packs
go to a file, so that a file can be read in one piece. Spark's text writer puts the files into the shared file
system: its line separator is the zero byte that ends every pack.

Reading takes any archive of such files, compressed by record or not at all. Records in one piece are decoded where
they are read; segments are grouped by origin identifier, ordered by number, checked for gaps and for the total length,
joined and then decoded.

Defined results: a null payload or url is empty. Rows that share the largest id of their payload are all responses.
A null id is larger than none: it is a response only if all pages with that payload have null ids. Repeated rows are
records of their own. Damaged records are kept with ``problem`` set and no payload. Extra columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from termfold.session import scratch_path, stored

PACK_BYTES = 4 << 20
PACKS_PER_FILE = 8
CHUNK_BYTES = 8 << 10
SEGMENT_BYTES = 16 << 10
DATE = "2026-01-01T00:00:00Z"
_END = b"\r\n\r\n"
_FED = 64 << 10

# Fixed values of the format.
_VERSION = b"WARC/1.1\r\n"
_REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"


# --- writing ---------------------------------------------------------------------


def digest(payload: bytes) -> str:
    """SHA-1 in base 32, as in payload digest fields."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def chunked(payload: bytes, size: int = CHUNK_BYTES) -> bytes:
    parts = [b"%x\r\n%b\r\n" % (len(p), p) for p in (payload[i : i + size] for i in range(0, len(payload), size))]
    return b"".join(parts) + b"0\r\n\r\n"


def record(fields: dict[str, str], block: bytes) -> bytes:
    """One record as a gzip member."""
    lines = "".join(f"{name}: {value}\r\n" for name, value in fields.items() if value is not None)
    head = _VERSION + lines.encode("utf-8", "replace") + b"Content-Length: %d\r\n\r\n" % len(block)
    packer = zlib.compressobj(1, zlib.DEFLATED, 31)
    return packer.compress(head + block + _END) + packer.flush()


def page_records(
    page_id: int | None, url: str | None, payload: bytes, keeper: int | None, name: str, segment_bytes: int
) -> Iterator[bytes]:
    """The records of one page; ``keeper``: the page it repeats, or null."""
    identifier = f"<urn:page:{'null' if page_id is None else page_id}#{name}>"
    common = {
        "WARC-Target-URI": re.sub(r"[\x00-\x20\x7f]+", "%20", url or ""),
        "WARC-Date": DATE,
        "WARC-Payload-Digest": f"sha1:{digest(payload)}",
    }
    http = {"Content-Type": "application/http; msgtype=response"}
    if keeper is not None:
        kind = {"WARC-Type": "revisit", "WARC-Record-ID": identifier, "WARC-Refers-To": f"<urn:page:{keeper}>"}
        yield record(kind | common | {"WARC-Profile": _REVISIT_PROFILE} | http, _HTTP)
        return
    block = _HTTP + chunked(payload)
    parts = [block[i : i + segment_bytes] for i in range(0, len(block), segment_bytes)]
    first = {"WARC-Type": "response", "WARC-Record-ID": identifier} | common | http
    if len(parts) > 1:
        first["WARC-Segment-Number"] = "1"
    yield record(first, parts[0])
    for number, part in enumerate(parts[1:], 2):
        fields = {
            "WARC-Type": "continuation",
            "WARC-Record-ID": f"{identifier[:-1]}.{number}>",
            "WARC-Segment-Origin-ID": identifier,
            "WARC-Segment-Number": str(number),
            "WARC-Segment-Total-Length": str(len(block)) if number == len(parts) else None,
        }
        yield record(fields | common, part)


def with_keepers(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """``page_id, url, payload`` with ``keeper``: for a revisit the page it refers to, else null.

    Only payloads that occur more than once are looked up; they are stored first, so that the join broadcasts them
    when they are few and can split a payload that very many pages share when they are not.
    """
    sized = pages.withColumn("_sha", F.when(F.length("payload") >= least_bytes, F.sha1("payload")))
    keepers = sized.where("_sha is not null").groupBy("_sha").agg(F.max("page_id").alias("_keeper"), F.count("*").alias("_n"))
    keepers = stored(keepers.where("_n > 1 and _keeper is not null").drop("_n"), "payload_keepers")
    # Rows without a digest would meet under one key.
    key = F.coalesce("_sha", F.xxhash64("page_id", "url").cast("string"))
    joined = sized.withColumn("_sha", key).join(keepers, "_sha", "left")
    own = F.col("page_id").eqNullSafe(F.col("_keeper"))
    return joined.select("page_id", "url", "payload", F.when(~own, F.col("_keeper")).alias("keeper"))


def write_archives(pages: DataFrame, path: str, segment_bytes: int = SEGMENT_BYTES, least_bytes: int = 0) -> None:
    """Write ``page_id, url, payload`` (bytes) as archives below ``path``."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        pack, size, count = [], 0, 0

        def packed() -> pa.RecordBatch:
            data = b"".join(pack)
            if data[-1] != 0:  # the length field of a very large record; an empty member ends in zero
                data += zlib.compressobj(1, zlib.DEFLATED, 31).flush()
            return pa.record_batch([pa.array([data[:-1]], pa.binary())], ["pack"])

        for batch in batches:
            for row in zip(*(column.to_pylist() for column in batch.columns)):
                page_id, url, payload, keeper = row
                for member in page_records(page_id, url, payload, keeper, f"{part}.{count}", segment_bytes):
                    pack.append(member)
                    size += len(member)
                    if size >= PACK_BYTES:
                        yield packed()
                        pack, size = [], 0
                count += 1
        if pack:
            yield packed()

    clean = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        F.coalesce(F.col("payload").cast("binary"), F.lit(b"")).alias("payload"),
    )
    packs = with_keepers(clean, least_bytes).mapInArrow(task, "pack binary").select(F.col("pack").cast("string"))
    packs.write.option("lineSep", "\0").option("maxRecordsPerFile", PACKS_PER_FILE).text(path)


# --- reading ----------------------------------------------------------------------


def members(content: bytes) -> Iterator[bytes]:
    """The unpacked gzip members of an archive, or the whole of one that is not compressed."""
    if not content.startswith(b"\x1f\x8b"):
        yield content
        return
    view, at = memoryview(content), 0
    while at < len(content):
        unpacker, parts = zlib.decompressobj(31), []
        while not unpacker.eof and at < len(content):
            fed = view[at : at + _FED]
            parts.append(unpacker.decompress(fed))
            at += len(fed) - len(unpacker.unused_data)
        yield b"".join(parts)


def records(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields (names in lower case) and blocks of the records in ``data``."""
    at = 0
    while (start := data.find(b"WARC/", at)) >= 0:
        end = data.find(b"\r\n\r\n", start)
        if end < 0:
            return
        lines = data[start:end].decode("utf-8", "replace").split("\r\n")[1:]
        fields = {name.strip().lower(): value.strip() for name, _, value in (line.partition(":") for line in lines)}
        length = _number(fields.get("content-length")) or 0
        yield fields, data[end + 4 : end + 4 + length]
        at = end + 4 + length


def _number(text: str | None) -> int | None:
    return int(text) if text and text.isdigit() else None


def unchunked(body: bytes) -> bytes:
    """The payload in chunked transfer framing; ValueError if the framing is broken."""
    parts, at = [], 0
    while True:
        end = body.find(b"\r\n", at)
        if end < 0:
            raise ValueError("chunk without a size line")
        size = int(body[at:end].split(b";")[0], 16)
        if size == 0:
            return b"".join(parts)
        chunk = body[end + 2 : end + 2 + size]
        if len(chunk) < size or body[end + 2 + size : end + 4 + size] != b"\r\n":
            raise ValueError("chunk cut short")
        parts.append(chunk)
        at = end + 4 + size


def payload_of(block: bytes) -> bytes:
    """The payload of an HTTP response."""
    head, found, body = block.partition(b"\r\n\r\n")
    if not found:
        raise ValueError("response without an end of its header")
    framed = re.search(rb"(?im)^transfer-encoding:[^\r\n]*\bchunked\b", head)
    return unchunked(body) if framed else body


_FIELDS = "page_id long, record_type string, refers_to long, segment int, origin string, total long, stated string, block binary"
_SEEN = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, problem string, payload binary"
_ROWS = f"{_SEEN}, segment int, origin string, total long, stated string, block binary"


def _page_of(identifier: str | None) -> int | None:
    found = re.match(r"<urn:page:(-?\d+)[#>]", identifier or "")
    return int(found[1]) if found else None


def _decoded(block: bytes, stated: str | None, keep_payload: bool) -> dict:
    try:
        payload = payload_of(block)
    except ValueError as error:
        return {"problem": str(error)}
    found = digest(payload)
    problem = "digest differs" if stated and stated != found else None
    return {
        "payload_bytes": len(payload),
        "payload_digest": found,
        "problem": problem,
        "payload": payload if keep_payload and not problem else None,
    }


def read_archives(spark: SparkSession, path: str, keep_payload: bool = True) -> DataFrame:
    """A row for each response and revisit below ``path``.

    ``page_id, payload_bytes, payload_digest, record_type, refers_to, problem, payload``. Revisits have the size of
    the response they refer to, and no payload of their own.
    """
    schema = spark.createDataFrame([], _ROWS).schema
    arrow = pa.schema([(f.name, _ARROW[f.dataType.simpleString()]) for f in schema])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0).to_pylist():
                rows, size = [], 0
                for fields, block in (r for member in members(content) for r in records(member)):
                    row = _row(fields, block, keep_payload)
                    if row:
                        rows.append(row)
                        size += len(row.get("block") or b"") + len(row.get("payload") or b"") + 200
                    if size > PACK_BYTES:
                        yield pa.RecordBatch.from_pylist(rows, schema=arrow)
                        rows, size = [], 0
                yield pa.RecordBatch.from_pylist(rows, schema=arrow)

    files = spark.read.format("binaryFile").load(path).select("content")
    rows = stored(files.mapInArrow(task, _ROWS), "archive_rows")
    seen = [name.split()[0] for name in _SEEN.split(", ")]
    whole = rows.where("segment is null").select(seen)
    joined = stored(_reassembled(rows.where("segment is not null"), keep_payload), "reassembled")
    return _resolved(whole.unionByName(joined))


_ARROW = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary()}


def _row(fields: dict[str, str], block: bytes, keep_payload: bool) -> dict | None:
    kind, segment = fields.get("warc-type"), _number(fields.get("warc-segment-number"))
    identifier = fields.get("warc-record-id")
    stated = fields.get("warc-payload-digest", "").removeprefix("sha1:") or None
    row = {"page_id": _page_of(identifier), "record_type": kind, "stated": stated}
    if kind == "revisit":
        return row | {"refers_to": _page_of(fields.get("warc-refers-to")), "payload_digest": stated}
    if kind == "continuation" or (kind == "response" and segment is not None):
        return row | {
            "segment": segment or 0,
            "origin": fields.get("warc-segment-origin-id") or identifier,
            "total": _number(fields.get("warc-segment-total-length")),
            "block": block,
        }
    if kind == "response":
        return row | _decoded(block, stated, keep_payload)
    return None


def _reassembled(segments: DataFrame, keep_payload: bool) -> DataFrame:
    """Whole records from segments: grouped by origin, one record a group."""
    part = F.struct("segment", "record_type", "page_id", "total", "stated", "block")
    grouped = segments.groupBy("origin").agg(F.sort_array(F.collect_list(part)).alias("parts"))
    arrow = pa.schema([(n, _ARROW[{"long": "bigint"}.get(k, k)]) for n, k in (x.split() for x in _SEEN.split(", "))])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for parts in batch.column(0):
                yield pa.RecordBatch.from_pylist([_joined(parts.as_py(), keep_payload)], schema=arrow)

    return grouped.select("parts").mapInArrow(task, _SEEN)


def _joined(parts: list[dict], keep_payload: bool) -> dict:
    row = {"page_id": parts[0]["page_id"], "record_type": "response"}
    if [p["segment"] for p in parts] != list(range(1, len(parts) + 1)) or parts[0]["record_type"] != "response":
        return row | {"problem": "segments missing or repeated"}
    block = b"".join(p["block"] for p in parts)
    if parts[-1]["total"] is None or parts[-1]["total"] != len(block):
        return row | {"problem": "total length differs"}
    return row | _decoded(block, parts[0]["stated"], keep_payload)


def _resolved(found: DataFrame) -> DataFrame:
    """Give revisits the payload size of the response they refer to."""
    revisits = found.where("record_type = 'revisit'").drop("payload_bytes")
    responses = found.where("record_type = 'response' and problem is null")
    sizes = responses.groupBy(F.col("page_id").alias("refers_to"), "payload_digest").agg(F.max("payload_bytes").alias("payload_bytes"))
    referred = revisits.select("refers_to", "payload_digest").distinct()
    sizes = stored(sizes.join(referred, ["refers_to", "payload_digest"], "left_semi"), "revisited_sizes")
    resolved = revisits.join(sizes, ["refers_to", "payload_digest"], "left")
    missing = F.when(F.col("payload_bytes").isNull(), F.lit("no response to refer to"))
    resolved = resolved.withColumn("problem", F.coalesce("problem", missing))
    return found.where("record_type = 'response'").unionByName(resolved.select(found.columns))


def op2_warc(spark, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    path = scratch_path(spark, "warc")
    payload: Column = F.col("html").cast("binary").alias("payload")
    write_archives(pages.select("page_id", "url", payload), path)
    return read_archives(spark, path, keep_payload=False).drop("payload")


#: DuckDB has no SHA-1 in base 32; its hexadecimal digits are turned five bits at a time.
OP2_SQL = """
WITH p AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS h FROM pages
), k AS (SELECT h, max(page_id) AS keeper FROM p GROUP BY h)
SELECT page_id, payload_bytes,
  list_aggregate(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + CAST(
    (CAST('0x' || substr(h, 1 + 5 * (i // 4), 5) AS BIGINT) >> (15 - 5 * (i % 4))) & 31 AS INTEGER), 1)), 'string_agg', '')
    AS payload_digest,
  CASE WHEN page_id = keeper THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> keeper THEN keeper END AS refers_to,
  CAST(NULL AS VARCHAR) AS problem
FROM p JOIN k USING (h)
"""
