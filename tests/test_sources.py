"""CSV contracts, daily files, capacity documents, HTML and matrix tables, fetching."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from snapweave.operators import profiling
from snapweave.sources import documents, tables


def test_csv_round_trip(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([("é", '{"a": "x, y"}', "", "extra")], "a string, j string, e string, x string")
    tables.write_csv(df, path, ["j", "a", "e", "missing"])
    back = tables.read_csv(spark, path, ["a", "j", "missing", "e", "none"])
    assert [tuple(r) for r in back.collect()] == [("é", '{"a": "x, y"}', "", "", "")]
    assert tables.read_csv(spark, str(tmp_path / "absent"), ["a"]).count() == 0
    with pytest.raises(FileNotFoundError):
        tables.read_required(spark, str(tmp_path / "absent"), ["a"])
    with pytest.raises(ValueError, match="missing columns"):
        tables.read_required(spark, path, ["zz"])


def test_daily_files(spark, tmp_path):
    for name, body in (("2026/08/2026-08-01.csv", "﻿a,b\n1,\n"), ("2026/08/2026-08-03.csv", "a,b\n2,x\n3,y\n"), ("2026/08/notes.csv", "a,b\n9,9\n"), ("2026/08/2026-13-01.csv", "a,b\n8,8\n")):
        os.makedirs(os.path.dirname(tmp_path / name), exist_ok=True)
        (tmp_path / name).write_text(body, encoding="utf-8")
    assert [r["day"] for r in tables.daily_files(spark, str(tmp_path)).collect()] == [dt.date(2026, 8, 1), dt.date(2026, 8, 3)]
    rows = tables.read_daily(spark, str(tmp_path), ["a", "b"])
    assert sorted((r["day"], r["a"], r["b"]) for r in rows.collect()) == [(dt.date(2026, 8, 1), "1", ""), (dt.date(2026, 8, 3), "2", "x"), (dt.date(2026, 8, 3), "3", "y")]
    assert tables.previous_day(rows, F.lit("2026-08-03").cast("date")).first()[0] == dt.date(2026, 8, 1)
    assert tables.latest_view(rows, "day").count() == 2


def test_partition_overwrite(spark, tmp_path):
    path = str(tmp_path / "p")
    write = lambda rows: tables.write_partitioned(spark.createDataFrame(rows, "d string, v int"), path, "d")
    write([("1", 1), ("2", 2)])
    write([("2", 3)])
    assert sorted(map(tuple, spark.read.parquet(path).select(F.col("d").cast("string"), "v").collect())) == [("1", 1), ("2", 3)]


def test_write_suppression(spark, tmp_path):
    report = spark.createDataFrame([(1, "t1")], "n int, at string")
    path = str(tmp_path / "r")
    assert tables.write_if_changed(report, path, ["at"]) and not tables.write_if_changed(report.withColumn("at", F.lit("t2")), path, ["at"])
    assert tables.write_if_changed(report.withColumn("n", F.lit(2)), path, ["at"])


def test_capacity_document(spark, tmp_path):
    (tmp_path / "c.json").write_text('{"total": 3, "items": [{"facilityId": "1", "name": "Ａ", "capacity": 120, "latitude": "32.5", "municipalityName": "熊本県八代市"}, {"facilityId": "2", "name": "B", "capacity": 0}, {"facilityId": "2", "name": "C", "capacity": null}]}')
    items = tables.capacity_items(spark, str(tmp_path / "c.json"))
    rows = tables.capacity_rows(items, "now", "url").orderBy("_ord").collect()
    assert [(r["shelter_name"], r["portal_capacity_persons"], r["capacity_parse_status"]) for r in rows] == [("A", 120, "parsed"), ("B", None, "missing_zero"), ("C", None, "missing")]
    assert {r["rule"]: r["n_violations"] for r in tables.capacity_contract(items, 2).collect()} == {"min_rows": 0, "unique_ids": 1, "blank_ids": 0, "min_parsed": 0, "total_equals_count": 0}


def test_headers_and_rows(spark):
    assert [tables.canonical_header(h) for h in ("市町村", " 避難所 名", "混雑状態", "開設状況", "状態", "other")] == ["municipality", "shelter_name", "congestion_status", "opening_status", "opening_status", None]
    df = tables.canonical_columns(spark.createDataFrame([(1, 2, 3)], "`避難所名` int, `施設名` int, `zz` int"))
    assert df.columns == ["shelter_name"] and df.first()[0] == 1
    raw = spark.createDataFrame([(1, ["a", ""], ["x"]), (2, ["a", ""], ["x", "", "cut"]), (3, ["a"], [" "]), (4, ["a"], ["条件に一致するデータが存在しません。"]), (5, ["b", "a", "b"], ["1", " 2 ", "３"])], "_ord int, headers array<string>, cells array<string>")
    assert [(r["_ord"], r["row"]) for r in tables.clean_rows(raw).orderBy("_ord").collect()] == [(1, {"a": "x", "column_2": ""}), (5, {"a": "2", "b": "3"})]


PAGE = """<table><tr><th>other</th></tr></table><table><tr><th>避難所名</th><th>住所</th><th>避難者数</th></tr>
<tr><td>A館</td><td>町1</td><td>1,200</td></tr><tr><td>B館</td><td></td><td>-</td></tr><tr><td>C館</td><td>町3</td><td>5</td></tr><tr><td>合 計</td><td></td><td>1,205</td></tr></table>"""


def test_evacuee_html(spark):
    assert documents.evacuees_from_html(PAGE).records == [("A館", "町1", 1200), ("C館", "町3", 5)]
    with pytest.raises(ValueError, match="published 1206"):
        documents.evacuees_from_html(PAGE.replace("1,205", "1,206"))
    assert documents.evacuees_from_html(PAGE.replace("<tr><td>合 計</td><td></td><td>1,205</td></tr>", "") + "<p>合計 1,205人</p>").total == 1205
    with pytest.raises(ValueError, match="no published total"):
        documents.evacuees_from_html(PAGE.replace("合 計", "その他").replace("1,205", "-"))
    pages = spark.createDataFrame([(1, PAGE), (2, "<p>none"), (3, None)], "k int, html string")
    got = sorted(map(tuple, documents.evacuee_records(pages, "k", "html").collect()), key=repr)
    assert got == [(1, "A館", "町1", 1200, 1205, None), (1, "C館", "町3", 5, 1205, None), (2, None, None, None, None, "no evacuee table"), (3, None, None, None, None, "no evacuee table")]
    cells = documents.html_tables(pages, "k", "html")
    assert sorted(map(tuple, profiling.table_dimensions(cells, ["k", "table_idx"]).collect())) == [(1, 0, 1, 1), (1, 1, 5, 3)]


def test_matrix_layouts():
    old = [["No.避難者数", "名", "住所", "区", "定員", "世帯", "人", "x"], ["1", "A", "八代市甲", "d", "50", "2", "7", "○"], ["2", "B", "八代市乙", "d", "50", "1", "1,000", "△"], ["2", "B", "八代市乙", "d", "50", "1", "1,000", "△"], ["合計", "", "", "", "", "", "1,007", ""]]
    t = documents.evacuees_from_matrix([[["x"]], old])
    assert t.records == [("A", "八代市甲", 7), ("B", "八代市乙", 1000)] and t.method == "marker_boundary"
    new = [["No.", "名", "区", "定員", "世帯", "避難者数"], ["1", "A", "d", "50", "2", "7"], ["合計", "", "", "", "", "7"]]
    assert documents.detect_schema(new) == documents.MatrixSchema(1, None, 5, "header")
    assert documents.detect_schema([["1", "A", "d", "50", "2", "7"]]).method == "layout"
    with pytest.raises(ValueError):
        documents.evacuees_from_matrix([[["合計", "5"]]])
    assert documents.evacuees_from_lines(["1 A館 12", "2 B 館 3", "2 B 館 3", "合計 15"]).records == [("A館", "", 12), ("B 館", "", 3)]
    documents.register_adapter("upper", lambda v: documents.evacuees_from_lines(v.upper().split("\n")))
    assert documents.parse_source("upper", "1 a 2\n合計 2").records == [("A", "", 2)]


def test_fetching(spark, tmp_path):
    calls = []

    def get(url):
        calls.append(url)
        if url == "down":
            raise OSError
        return b"%PDF-1.7" if url == "good" and len(calls) > 4 else b"<html>"

    assert documents.first_pdf(["down", "page", "good"], get, sleep=lambda s: None) == ("good", b"%PDF-1.7")
    with pytest.raises(ValueError):
        documents.first_pdf(["down"], get, attempts=2, sleep=lambda s: None)
    (tmp_path / "x.bin").write_bytes(b"%PDF x")
    spark.dataSource.register(documents.HttpSource)
    df = spark.read.format("http_bytes").option("urls", f"file://{tmp_path}/x.bin").load()
    assert df.select(documents.is_pdf(F.col("content"))).first()[0] and [documents.backoff(n) for n in (1, 9)] == [2.0, 15.0]


def test_link_ranking(spark):
    page = """<a href="/f/list.pdf">避難所 開設</a><a href='page.html'>x.pdf here</a><a href="javascript:x('.pdf')">n</a><div data="other.pdf?v=1"></div><a href="/f/list.pdf">again</a>"""
    df = profiling.rank_links(spark.createDataFrame([(1, "https://h.example/a/b.html", page)], "k int, url string, html string").withColumnRenamed("url", "base"), "k", "html", "base", ".pdf", {"避難所": 25, "開設": 20})
    assert [(r["url"], r["score"]) for r in df.collect()] == [("https://h.example/f/list.pdf", 150), ("https://h.example/a/other.pdf?v=1", 100), ("https://h.example/a/page.html", 85)]


def test_json_profile(spark):
    df = spark.createDataFrame([('{"a": 1, "b": [{"c": "x"}, {"c": null}]}',), ('{"a": 2}',), ("bad{",), (None,)], "j string")
    got = {(r["path"], r["type"]): (r["n"], r["n_docs"]) for r in profiling.json_keys(df, "j").collect()}
    assert got[("$.a", "bigint")] == (2, 2) and got[("$.b", "array")] == (1, 1) and got[("$.b[].c", "string")] == (1, 1)
    assert [tuple(r) for r in profiling.object_shapes(df, "j").collect()] == [("a", 1), ("a,b", 1)]
