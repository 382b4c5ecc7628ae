"""Archives of any make: other record types, other digests, damaged and cut off records, long headers."""

import base64
import gzip
import hashlib

import pytest
from pyspark.sql import functions as F

from vigil.llm import warc

END = b"\r\n\r\n"
BODIES = [b"<p>page %d</p>" % n * 40 for n in range(6)]


def other(kind, block, content_type="application/warc-fields", extra=()):
    lines = [b"WARC/1.0", b"WARC-Type: " + kind.encode(), b"Content-Type: " + content_type.encode(), *extra, b"Content-Length: %d" % len(block)]
    return b"\r\n".join(lines) + END + block + END


def response(body, digest):
    block = b"HTTP/1.1 200 OK\r\nServer: x\r\n\r\n" + body
    extra = (b"WARC-Target-URI: http://a/b", b"WARC-Payload-Digest: " + digest.encode())
    return other("response", block, "application/http; msgtype=response", extra)


def sha1(body):
    return "sha1:" + base64.b32encode(hashlib.sha1(body).digest()).decode()


def crawl():
    """A file as crawlers write it, and the records expected of it."""
    inner = warc.record(77, "http://inside", b"inside " * 30, "0" * 64, None)
    bodies = [*BODIES, inner * 3, b""]
    records = [other("warcinfo", b"software: x\r\n")]
    for body in bodies:
        records += [other("request", b"GET / HTTP/1.1\r\n\r\n", "application/http; msgtype=request"), response(body, sha1(body)), other("metadata", b"a: b")]
    return records, bodies


def scan(spark, folder, split=700):
    found = warc.scan_archives(warc.listed(spark, str(folder)), split)
    return found.records.collect(), [(r.offset, r.length) for r in found.broken.collect()]


def write(folder, name, records, packed):
    folder.mkdir(exist_ok=True)
    (folder / name).write_bytes(b"".join(gzip.compress(r) if packed else r for r in records))


@pytest.mark.parametrize("packed", [True, False])
def test_reads_records_of_any_type_and_digest(spark, tmp_path, packed):
    records, bodies = crawl()
    write(tmp_path / "w", "a.warc" + ".gz" * packed, records, packed)
    rows, broken = scan(spark, tmp_path / "w")
    assert broken == [] and len(rows) == len(records) and all(r.intact for r in rows)
    found = sorted((r.payload_bytes, r.payload_digest, r.url) for r in rows if r.record_type == "response")
    assert found == sorted((len(b), hashlib.sha256(b).hexdigest(), "http://a/b") for b in bodies)
    assert sorted({r.record_type for r in rows}) == ["metadata", "request", "response", "warcinfo"]


def test_a_damaged_payload_is_marked_and_later_records_are_read(spark, tmp_path):
    records = [response(b, sha1(b)) for b in BODIES]
    records[2] = records[2].replace(b"page 2", b"pagE 2")
    write(tmp_path / "w", "a.warc", records, False)
    rows, broken = scan(spark, tmp_path / "w")
    assert broken == [] and len(rows) == len(BODIES) and sum(not r.intact for r in rows) == 1


def test_where_no_record_can_be_read_is_reported(spark, tmp_path):
    records = [gzip.compress(response(b, sha1(b))) for b in BODIES]
    at = len(records[0]) + len(records[1])
    damaged = records[2][:20] + bytes(x ^ 255 for x in records[2][20:24]) + records[2][24:]
    whole, cut = b"".join(records), b"".join(records)[:-5]
    (tmp_path / "w").mkdir()
    (tmp_path / "w" / "good.warc.gz").write_bytes(whole)
    (tmp_path / "w" / "bad.warc.gz").write_bytes(b"".join([*records[:2], damaged, *records[3:]]))
    (tmp_path / "w" / "cut.warc.gz").write_bytes(cut)
    (tmp_path / "w" / "none.warc.gz").write_bytes(b"")
    (tmp_path / "w" / "other.warc").write_bytes(b"no archive at all")
    rows, broken = scan(spark, tmp_path / "w")
    assert sorted(broken) == sorted([(at, len(whole)), (len(whole) - len(records[-1]), len(cut)), (0, 17)])
    assert len(rows) == len(BODIES) + 2 + len(BODIES) - 1


def test_headers_of_any_length(spark, tmp_path):
    long = other("metadata", b"x", extra=(b"X-Long: " + b"y" * 300_000,))
    write(tmp_path / "w", "a.warc", [other("warcinfo", b"i"), long, response(b"z", sha1(b"z"))], False)
    rows, broken = scan(spark, tmp_path / "w")
    assert broken == [] and sorted(r.record_type for r in rows) == ["metadata", "response", "warcinfo"]


@pytest.mark.parametrize("packed", [True, False])
def test_reading_back_fails_where_an_archive_is_damaged(spark, tmp_path, packed):
    pages = spark.createDataFrame([(n, f"http://x/{n}", "text " * 40 + str(n)) for n in range(20)], "page_id long, url string, html string")
    folder = warc.write_archives(pages.coalesce(1), str(tmp_path / "w"), compress=packed)
    assert warc.read_archives(spark, folder).count() == 20
    (name,) = (r.file for r in spark.read.parquet(f"{folder}/manifest").collect())
    data = bytearray(open(name, "rb").read())
    for i in range(len(data) // 2, len(data) // 2 + 400):
        data[i] = 0
    open(name, "wb").write(data)
    with pytest.raises(ValueError, match="no record at"):
        warc.read_archives(spark, folder)


def test_clashing_columns_and_odd_pages(spark):
    rows = [(1, "u", "a" * 200), (2, None, "a" * 200), (2, "u", "a" * 200), (None, "u", "a" * 200), (3, "u", None), (4, "u\r\nX: y", "")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    for name in ("file", "offset", "digest", "record_type", "refers_to", "part", "n"):
        pages = pages.withColumn(name, F.lit("z"))
    found = sorted((tuple(r) for r in warc.archive(pages).select("page_id", "payload_bytes", "record_type", "refers_to").collect()), key=str)
    assert found == sorted(
        [(1, 200, "response", None), (2, 200, "revisit", 1), (2, 200, "revisit", 1), (None, 200, "response", None), (3, 0, "response", None), (4, 0, "response", None)],
        key=str,
    )
