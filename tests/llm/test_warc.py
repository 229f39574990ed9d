"""WARC round trips, segment reassembly and chunked framing."""

import base64
import gzip
import hashlib
import random

import pytest
from pyspark.sql import functions as F

from surveylake.llm import warc
from surveylake.session import scratch_path


def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("digest", F.lit(1)).withColumn(
        "payload", F.lit(2))


def digest(text):
    return base64.b32encode(hashlib.sha1(text.encode()).digest()).decode()


def round_trip(spark, rows, **options):
    path = scratch_path(spark, "warc-test")
    warc.write_archives(pages(spark, rows), path, **options)
    return path, warc.read_pages(spark, path).withColumn("own", warc.sha1_base32(F.col("payload"))).collect()


def test_round_trip(spark):
    rng = random.Random(1)
    long = "".join(rng.choice("aé\U0001f600\r\n<0123456789abcdef") for _ in range(90_000))
    rows = [(1, "http://a/b c", "x"), (2, None, "x"), (3, "u", long), (4, "u", long), (5, "u\r\nWARC-Type: fake", ""),
            (6, "u", None), (7, "u", "\r\n\r\nWARC/1.1\r\n\r\n0\r\n\r\n"), (None, "u", "n"), (None, "v", "n"), (None, "u", "x"),
            (8, "u", "same"), (8, "u", "same"), (8, "u", "other"), (9, "u", long + "!"), (9, "u", long + "!")]
    path, got = round_trip(spark, rows, segment_bytes=1000)
    assert len(got) == len(rows) and not [r.error for r in got if r.error]
    least = {}
    for i, _, t in rows:
        if i is not None:
            least[t or ""] = min(i, least.get(t or "", i))
    want = sorted(((i, "response" if (f := least.get(t or "")) in (None, i) else "revisit", None if f in (None, i) else f,
                    digest(t or "")) for i, _, t in rows), key=str)
    assert sorted(((r.page_id, r.type, r.refers_to, r.digest) for r in got), key=str) == want
    texts = {digest(t or ""): (t or "").encode() for _, _, t in rows}
    for r in got:
        if r.type == "response":
            assert bytes(r.payload) == texts[r.digest] and r.own == r.digest
        else:
            assert r.payload is None and r.payload_bytes == len(texts[r.digest])
    parts = warc.read_records(spark, path, segmented=True)
    assert parts.groupBy("origin").count().count() == 2 and parts.filter("type = 'continuation'").count() > 100


def test_small_payloads_are_not_revisits(spark):
    _, got = round_trip(spark, [(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abc"), (4, "u", "abc")], min_revisit_bytes=3)
    assert sorted((r.page_id, r.type) for r in got) == [(1, "response"), (2, "response"), (3, "response"), (4, "revisit")]


def test_empty(spark):
    assert round_trip(spark, [])[1] == []


def record(kind, name, block, **more):
    fields = {"WARC-Type": kind, "WARC-Record-ID": name, **more, "Content-Length": len(block)}
    return ("WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields.items()) + "\r\n").encode() + block + b"\r\n\r\n"


def test_foreign_archives(spark, tmp):
    """Segments out of order and over files, gzipped by record; damage is told."""
    body = b"HTTP/1.1 200 OK\r\nTransfer-Encoding: chunked\r\n\r\n3;x=y\r\nabc\r\n2\r\nde\r\n0\r\n\r\n"
    cut = lambda a, b, n, **k: record("continuation" if n > 1 else "response", f"<{a}{n}>", body[b], **{
        "WARC-Segment-Number": n} | ({"WARC-Segment-Origin-ID": f"<{a}1>"} if n > 1 else {"X-Page-ID": k.pop("page")}) | k)
    total = {"WARC-Segment-Total-Length": len(body)}
    good = [cut("a", slice(0, 10), 1, page=1), cut("a", slice(10, 50), 2), cut("a", slice(50, None), 3, **total)]
    lost = [cut("b", slice(0, 10), 1, page=2), cut("b", slice(50, None), 3, **total)]
    short = [cut("c", slice(0, 10), 1, page=3), cut("c", slice(10, 50), 2, **total)]
    plain = record("response", "<d>", b"HTTP/1.1 200 OK\r\n\r\nplain", **{"X-Page-ID": 4})
    broken = record("response", "<e>", body.replace(b"3;x", b"4;x"), **{"X-Page-ID": 5})
    with open(f"{tmp}/one.warc.gz", "wb") as f:
        f.write(b"".join(map(gzip.compress, [good[2], lost[0], short[1], plain])))
    with open(f"{tmp}/two.warc", "wb") as f:
        f.write(b"".join([good[1], lost[1], broken, short[0], good[0]]))
    got = {r.page_id: r for r in warc.read_pages(spark, tmp).collect()}
    assert bytes(got[1].payload) == b"abcde" and bytes(got[4].payload) == b"plain"
    assert all(got[i].payload is None and got[i].error for i in (2, 3, 5))
    with pytest.raises(ValueError):
        list(warc.parse(plain.replace(b"Content-Length: 24", b"Content-Length: 23")))
