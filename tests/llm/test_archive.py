"""The WARC archive: exact records, and damage that is not passed over."""

import base64
import hashlib

import pytest

from simmart.llm import archive
from simmart.llm.common import new_folder

PAGES = "page_id bigint, url string, html string, extra string, address string"


@pytest.fixture(scope="module")
def pages(spark):
    rows = [
        (5, "http://a", "<p>é</p>", "x", "y"),
        (2, "http://b", "<p>é</p>", "x", "y"),
        (2, "http://b", "<p>é</p>", "x", "y"),
        (9, None, None, None, None),
        (8, "http://c\r\nWARC-Type: other", "", "x", "y"),
        (None, "http://d", "<p>é</p>", "x", "y"),
        (None, "http://e", "only", "x", "y"),
        (1, "http://f", "WARC/1.1\r\n\r\nx" * 20_000, "x", "y"),
    ]
    return spark.createDataFrame(rows, PAGES)


def digest(html):
    return base64.b32encode(hashlib.sha1((html or "").encode()).digest()).decode()


def test_pages_come_back(pages):
    found = sorted(archive.archived(pages).collect(), key=str)
    texts = [(r.page_id, r.html or "") for r in pages.collect()]
    first = {}
    for k, t in texts:
        if k is not None:
            first[t] = min(k, first.get(t, k))
    expected = sorted(
        (
            (k, len(t.encode()), digest(t), *(("response", None) if first.get(t) in (None, k) else ("revisit", first[t])))
            for k, t in texts
        ),
        key=str,
    )
    assert sorted((tuple(r[:5]) for r in found), key=str) == expected


def test_records_are_exact(spark, pages):
    path = new_folder(spark, "test")
    archive.write_archive(pages, path)
    assert spark.read.parquet(f"{path}/payloads").count() == 4
    rows = archive.records(spark, path).collect()
    assert len(rows) == pages.count()
    texts = {(r.page_id, (r.html or "").encode()) for r in pages.collect()}
    for r in rows:
        head, _, rest = bytes(r.record).partition(b"\r\n\r\n")
        fields = dict(line.split(b": ", 1) for line in head.split(b"\r\n")[1:])
        length = int(fields[b"Content-Length"])
        assert rest[length:] == b"\r\n\r\n" and (r.page_id, bytes(r.payload)) in texts
        http, _, body = rest[:length].partition(b"\r\n\r\n")
        assert body == (bytes(r.payload) if fields[b"WARC-Type"] == b"response" else b"")
        assert fields[b"WARC-Payload-Digest"] == b"sha1:" + digest(bytes(r.payload).decode()).encode()
        assert f"Content-Length: {len(r.payload)}".encode() in http


def test_damage_fails_the_read(spark, pages):
    path = new_folder(spark, "test")
    archive.write_archive(pages, path)
    damaged = new_folder(spark, "test")
    spark.read.parquet(f"{path}/records").write.parquet(f"{damaged}/records")
    spark.read.parquet(f"{path}/payloads").selectExpr(
        "address", "first_id", "payload_digest", "payload_bytes", "case when payload_bytes = 9 then encode('x', 'UTF-8') else payload end payload"
    ).write.parquet(f"{damaged}/payloads")
    with pytest.raises(Exception, match="damaged payload"):
        archive.read_archive(spark, damaged).collect()
    lost = new_folder(spark, "test")
    spark.read.parquet(f"{path}/records").write.parquet(f"{lost}/records")
    spark.read.parquet(f"{path}/payloads").where("payload_bytes <> 9").write.parquet(f"{lost}/payloads")
    with pytest.raises(Exception, match="without its payload"):
        archive.read_archive(spark, lost).collect()


def test_no_pages(spark):
    assert archive.archived(spark.createDataFrame([], PAGES)).count() == 0
