import base64
import gzip
import hashlib
import io

import pytest
from pyspark.sql import functions as F

from snapweave.llm import warc
from snapweave.llm.shared import scratch_path

ROWS = [(5, "http://a/5", "<p>x</p>"), (2, "http://a/2", "<p>x</p>"), (9, "http://a/9", None), (7, None, ""), (1, "http://a/é\r\nInjected: 1", "é" * 5000 + "WARC/1.1\r\n\r\n"), (3, "u", "<p>x</p>"), (5, "http://a/5", "<p>x</p>"), (None, "u", "only")]


def brute(rows):
    out = []
    for i, _, h in rows:
        raw = (h or "").encode()
        first = min((j for j, _, g in rows if j is not None and (g or "").encode() == raw), default=None)
        out.append((i, len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(), "response" if i == first else "revisit", None if i == first else first))
    return sorted(out, key=repr)


def test_round_trip(spark):
    pages = spark.createDataFrame([(*r, "x", 1) for r in ROWS], "page_id long, url string, html string, payload string, digest int").repartition(3)
    path = scratch_path(spark, "warc")
    warc.archive(pages, path, file_bytes=300)
    got = sorted(((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in warc.page_rows(spark, path).collect()), key=repr)
    assert got == brute(ROWS)
    df = warc.read(spark, path)
    assert df.where("record_type = 'response'").count() + df.where("record_type in ('revisit', 'x')").count() == len(ROWS)
    assert df.where("payload_digest = 'none'").count() == 0
    assert warc.read(spark, path, payload=False).where("payload is not null").count() == 0
    html = {r["record_id"]: bytes(r["payload"]).decode() for r in df.where("record_type = 'response'").collect()}
    assert html["urn:page:1"] == ROWS[4][2]


def test_empty_table(spark):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    path = scratch_path(spark, "warc")
    warc.archive(pages, path)
    assert warc.page_rows(spark, path).count() == 0


@pytest.mark.parametrize("kind", ["plain", "gzip", "own"])
def test_records_of_any_writer(kind):
    raw = [warc.record_bytes("response", f"<urn:page:{k}>", "u", None, b"p" * (k * 40000)) for k in range(4)]
    if kind == "plain":
        stream = io.BytesIO(b"".join(raw))
    else:
        stream = io.BytesIO(b"".join(map(gzip.compress if kind == "gzip" else warc.member, raw)))
    for payload in (True, False):
        stream.seek(0)
        got = list(warc.records(stream, kind != "plain", lambda h: h["warc-record-id"] != "<urn:page:2>", payload))
        assert [(h["warc-record-id"], n, p) for _, h, n, p in got] == [(f"<urn:page:{k}>", k * 40000, b"p" * (k * 40000) if payload else None) for k in (0, 1, 3)]


def test_pushed_predicates():
    from pyspark.sql.datasource import EqualTo, GreaterThan, In

    reader = warc.WarcReader({"path": "/x"})
    rest = list(reader.pushFilters([EqualTo(("record_type",), "response"), In(("record_id",), ("a", "b")), GreaterThan(("offset",), 3), EqualTo(("offset",), 3)]))
    assert len(rest) == 2 and dict(reader.wanted) == {"record_type": {"response"}, "record_id": {"a", "b"}}


def test_base32(spark):
    rows = spark.range(50).select(F.sha1(F.col("id").cast("string")).alias("h")).select("h", warc.base32(F.unhex("h")).alias("b")).collect()
    assert all(base64.b32encode(bytes.fromhex(r["h"])).decode() == r["b"] for r in rows)
