import base64
import gzip
import hashlib
import io
import os

import pytest
from pyspark.sql import functions as F

from maskcorpus.llm import warc as W


def digest(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


def expected(rows, min_bytes=0):
    out = []
    for page_id, url, html in rows:
        data = (html or "").encode()
        same = [p for p, _, h in rows if (h or "").encode() == data and p is not None]
        first = max(same, default=None) if len(data) >= min_bytes else page_id
        out.append((page_id, len(data), digest(html), "response" if first == page_id else "revisit", None if first == page_id else first))
    return sorted(out, key=str)


ROWS = ([(i, f"http://h.example/{i}", f"<p>page {i}</p>") for i in range(40)]
        + [(100 + i, "http://h.example/é x\r\n", "<p>same é</p>") for i in range(30)]
        + [(200, None, None), (201, "", ""), (202, "u", "WARC/1.1\r\n\r\nContent-Length: 5\r\n\r\n"), (203, "u", "x" * 3_000_000),
           (204, "u", "\r\n\r\n"), (205, "u", "tie"), (205, "u", "tie"), (-3, "u", "tie"), (None, "u", "tie"), (None, "u", "no id"), (300, "u", "x" * 3_000_000)])


@pytest.mark.parametrize("min_bytes,archive", [(0, W.ARCHIVE_BYTES), (8, 2000)])
def test_round_trip(spark, min_bytes, archive):
    df = spark.createDataFrame([(*r, "x") for r in ROWS], "page_id long, url string, html string, digest string").repartition(3)
    listing = W.write_archives(df, min_bytes=min_bytes, archive_bytes=archive)
    got = W.read_archives(listing).collect()
    assert all(r.fault is None for r in got)
    assert sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got), key=str) == expected(ROWS, min_bytes)
    texts = {(p, digest(h)): (h or "").encode() for p, _, h in ROWS}
    for r in got:
        assert r.payload == (texts[r.page_id, r.payload_digest] if r.record_type == "response" else None)
    assert listing.agg({"records": "sum"}).first()[0] == len(ROWS)
    if archive == 2000:
        assert listing.count() > 3
    assert all(r.payload is None for r in W.read_archives(listing, payloads=False).collect())


def test_empty_table(spark):
    df = spark.createDataFrame([], "page_id long, url string, html string")
    listing = W.write_archives(df)
    assert listing.collect() == [] and W.read_archives(listing).collect() == []


def test_members_are_plain_gzip():
    one, two = W.page_record(1, "http://a/", b"abc", None), W.page_record(2, "http://b/", b"abc", 1)
    text = gzip.decompress(one + two)
    assert text.count(b"WARC/1.1\r\n") == 2 and b"WARC-Refers-To: <urn:page:1>" in text
    found = list(W.records(io.BytesIO(one + two)))
    assert [r.offset for r in found] == [0, len(one)]
    assert W._page(found[1])[3:] == (3, digest("abc"), "revisit", 1, None)


def test_faults_are_named(spark, tmp_dir):
    good = W.page_record(1, "http://a/", b"abc" * 50, None)
    body = gzip.decompress(W.page_record(2, "http://a/", b"abc" * 50, None))
    files = {
        "cut": good + good[: len(good) // 2],
        "junk": good + b"not gzip at all",
        "digest": gzip.compress(body.replace(b"abcabc", b"abcabd", 1)),
        "length": gzip.compress(body.replace(b"Content-Length: ", b"Content-Length: 9", 1)),
        "none": gzip.compress(b"hello\r\n\r\n"),
        "good": good,
    }
    for name, data in files.items():
        with open(os.path.join(tmp_dir, name), "wb") as f:
            f.write(data)
    paths = spark.createDataFrame([(f"file:{tmp_dir}/{n}",) for n in files], "path string")
    got = {}
    for r in W.read_archives(paths).collect():
        got.setdefault(os.path.basename(r.path), []).append((r.page_id, r.fault))
    assert got["good"] == [(1, None)]
    assert got["cut"] == [(1, None), (None, "the archive ends inside a record")]
    assert got["junk"][0] == (1, None) and got["junk"][1][1].startswith("not a gzip member")
    assert got["digest"] == [(2, "block digest differs")]
    assert "not the length" in got["length"][0][1] and "no WARC record" in got["none"][0][1]


def test_long_records_stream():
    big = bytes(range(256)) * 40_000
    data = W.page_record(7, "u", big, None) + W.page_record(8, "u", b"", None)
    found = list(W.records(io.BytesIO(data)))
    assert W._page(found[0])[2] == big and W._page(found[1])[2] == b""


def test_archives_are_dealt_over_tasks(spark, tmp_dir):
    paths = []
    for k in range(24):
        paths.append(os.path.join(tmp_dir, f"a{k}.warc.gz"))
        with open(paths[-1], "wb") as f:
            f.write(W.page_record(k, "http://a/", b"abc %d" % k, None))
    listing = spark.createDataFrame([(p, 10, "x") for p in paths], "path string, bytes long, offset string")
    out = W.read_archives(listing)
    by_task = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
    assert len(by_task) >= min(8, spark.sparkContext.defaultParallelism) and max(by_task) <= 6 and sum(by_task) == 24
    assert W.reading_tasks(spark, 10_000, 160 * 2 ** 30) == -(-160 * 2 ** 30 // W.TASK_BYTES)


def test_missing_archives_are_faults(spark, tmp_dir):
    good = os.path.join(tmp_dir, "a.warc.gz")
    with open(good, "wb") as f:
        f.write(W.page_record(1, "http://a/", b"abc", None))
    listing = spark.createDataFrame([(good,), (None,), (good + ".gone",), (good,)], "path string")
    got = sorted(((r.page_id, r.fault, r.path) for r in W.read_archives(listing).collect()), key=str)
    assert got == sorted([(1, None, good), (1, None, good), (None, "no path", None), (None, "no such file", good + ".gone")], key=str)
