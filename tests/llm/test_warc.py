import hashlib
import base64

from pyspark.sql import functions as F

from termfold.llm import warc
from termfold.session import scratch_path

SCHEMA = "page_id long, url string, html string, payload_digest string, problem string"


def write_and_read(spark, rows, **options):
    pages = spark.createDataFrame([(*row, "x", "y") for row in rows], SCHEMA).repartition(2)
    path = scratch_path(spark, "archives")
    warc.write_archives(pages.select("page_id", "url", F.col("html").cast("binary").alias("payload")), path, **options)
    return path, warc.read_archives(spark, path).collect()


def test_round_trip_of_odd_pages(spark):
    long = "<p>é\r\n\r\n0\r\nWARC/1.1\r\n" * 20_000
    rows = [
        (1, "http://a/", "one"), (2, "http://b/\r\nX: y", "one"), (3, None, None), (4, "", ""), (5, "u", long),
        (6, "u", "one"), (6, "u", "one"), (7, "u", "7\r\n" * 5000), (None, "u", "null id"), (None, "u", "one"), (8, "u" * 100_000, "x"),
    ]
    path, found = write_and_read(spark, rows)
    assert len(found) == len(rows) and all(r.problem is None for r in found)
    by_payload = {}
    for page, _, html in rows:
        by_payload.setdefault(html or "", []).append(page)
    expected = []
    for page, _, html in rows:
        data = (html or "").encode()
        keeper = max((p for p in by_payload[html or ""] if p is not None), default=None)
        refers = keeper if page != keeper else None
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        expected.append((page, len(data), digest, "response" if refers is None else "revisit", refers))
    key = lambda x: tuple((v is not None, v) for v in x)
    assert sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in found), key=key) == sorted(expected, key=key)
    for r in found:
        if r.record_type == "response":
            assert digest_of(r.payload) == r.payload_digest


def digest_of(payload):
    return base64.b32encode(hashlib.sha1(bytes(payload)).digest()).decode()


def test_small_payloads_may_stay_responses(spark):
    _, found = write_and_read(spark, [(1, "u", "ab"), (2, "u", "ab"), (3, "u", "long enough"), (4, "u", "long enough")], least_bytes=5)
    assert sorted((r.page_id, r.record_type) for r in found) == [(1, "response"), (2, "response"), (3, "revisit"), (4, "response")]


def test_empty_table(spark):
    assert write_and_read(spark, [])[1] == []


def test_files_are_archives_of_gzip_members(spark):
    path, _ = write_and_read(spark, [(i, f"http://{i}/", "text " * i) for i in range(50)])
    kinds, ids = [], []
    for row in spark.read.format("binaryFile").load(path).collect():
        content = bytes(row.content)
        assert not content or content.endswith(b"\0")
        for member in warc.members(content):
            (fields, block), = warc.records(member)
            kinds.append(fields["warc-type"])
            ids.append(fields["warc-record-id"])
            assert len(block) == int(fields["content-length"]) and member.endswith(b"\r\n\r\n")
    assert kinds.count("response") == 50 and len(set(ids)) == len(ids)


def archive(spark, *records_, compressed=True):
    data = b"".join(r if compressed else next(warc.members(r)) for r in records_)
    path = scratch_path(spark, "made")
    spark.createDataFrame([(data[:-1],)], "v binary").select(F.col("v").cast("string")).coalesce(1).write.option(
        "lineSep", chr(data[-1])
    ).text(path)
    return warc.read_archives(spark, path).collect()


def test_damaged_segments_are_told(spark):
    payload = b"x" * 5000
    parts = list(warc.page_records(1, "u", payload, None, "a", 1000))
    other = list(warc.page_records(2, "u", payload, None, "b", 1000))
    assert len(parts) == 6
    found = {r.page_id: r for r in archive(spark, *reversed(parts), *other[:2], *other[3:])}
    assert bytes(found[1].payload) == payload and found[1].problem is None
    assert found[2].payload is None and "segments" in found[2].problem
    found, = archive(spark, *parts[:-1])
    assert "length" in found.problem


def test_uncompressed_archive_and_plain_bodies(spark):
    plain = warc.record({"WARC-Type": "response", "WARC-Record-ID": "<urn:page:5>"}, b"HTTP/1.1 200 OK\r\n\r\nbody")
    info = warc.record({"WARC-Type": "warcinfo"}, b"software: x")
    broken = warc.record({"WARC-Type": "response", "WARC-Record-ID": "<urn:page:6>"}, warc._HTTP + b"zz\r\nbody")
    found = {r.page_id: r for r in archive(spark, info, plain, broken, compressed=False)}
    assert bytes(found[5].payload) == b"body" and found[6].problem and len(found) == 2


def test_chunks():
    assert warc.unchunked(warc.chunked(b"abc" * 10_000)) == b"abc" * 10_000
    assert warc.unchunked(b"3;name=value\r\nabc\r\n0\r\nTrailer: x\r\n\r\n") == b"abc"
