"""Pure functions against tables of cases and golden values."""

import datetime as dt
import difflib
import hashlib
import unicodedata

import pytest
from pyspark.sql import functions as F

from snapweave.functions import scalars, text


def column(spark, values, kind, f):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r["o"] for r in df.select("i", f(F.col("v")).alias("o")).orderBy("i").collect()]


def test_text_normalisation(spark):
    values = ["  ＡＢＣ　ｶﾅ  \n x ", None, "&lt;a&gt;&amp;", "①②", "a b"]
    assert column(spark, values, "string", text.normalize_text) == ["ABC カナ x", "", "<a>&", "12", "a b"]
    assert column(spark, values, "string", text.clean_text) == ["ABC カナ x", "", "&lt;a&gt;&amp;", "12", "a b"]
    assert column(spark, [" a ", None], "string", text.trimmed) == ["a", ""]


def test_name_keys(spark):
    names = ["高田コミュニティーセンター", "（A）・Ｂ－C", "八代市立 第二 武道場 2F", "熊本県宇城市立松橋［北］", None]
    assert column(spark, names, "string", text.name_key_reference)[:2] == ["高田コミュニティセンタ", "(a)bc"]
    assert column(spark, names, "string", text.name_key_capacity)[:2] == ["高田コミュニティセンタ", "abc"]
    assert column(spark, names, "string", text.name_key_municipal) == ["高田コミュニティセンタ", "abc", "第二武道館2階", "松橋北", ""]


def test_name_variants(spark):
    assert column(spark, ["第一体育館", "体育館", "総合体育館東", ""], "string", text.name_variants) == [["第一", "第一体育館"], ["体育館"], ["東", "総合体育館東"], []]


def test_address_keys(spark):
    values = ["熊本県八代市大字本野町 505番地", "本野町５０５ー１号", "宇城市松橋町 1丁目2番", None]
    assert column(spark, values, "string", text.address_key) == ["八代市本野町505", "本野町505-1", "宇城市松橋町1丁目2", ""]
    assert column(spark, values, "string", text.address_key_municipal) == ["本野町505", "本野町5051", "松橋町12", ""]
    assert column(spark, ["熊本県 八代市", None], "string", text.municipality_key) == ["八代市", ""]


def test_infer_municipality(spark):
    assert column(spark, ["熊本県八代市本野町505", "八代郡氷川町島地", "東京", ""], "string", text.infer_municipality) == ["八代市", "八代郡氷川町", "", ""]


def test_similarity_is_the_block_ratio(spark):
    pairs = [("tide", "diet"), ("diet", "tide"), ("高田小学校", "高田小"), ("", ""), ("a", None), ("abcd" * 60, "bcda" * 60)]
    df = spark.createDataFrame([(i, *p) for i, p in enumerate(pairs)], "i int, a string, b string")
    got = [r["s"] for r in df.select("i", text.similarity("a", "b").alias("s")).orderBy("i").collect()]
    want = [None if b is None else 1.0 if a == b else difflib.SequenceMatcher(None, a, b).ratio() for a, b in pairs]
    assert got == want and got[:2] == [0.25, 0.5]


def test_lists_and_contexts(spark):
    assert column(spark, [[" b ", "a", "b", None, ""]], "array<string>", text.unique_join) == ["b | a"]
    assert column(spark, ["b; a;;b ", None], "string", text.split_list) == [["a", "b", "b"], []]
    body = "x" * 30 + "KEY" + "y" * 30 + "KEY" + "z" * 5
    assert column(spark, [body, "none"], "string", lambda c: text.keyword_contexts(c, "KEY", 5, 10, 2)) == [[body[25:40], body[58:73]], []]
    assert column(spark, [body, "none"], "string", lambda c: text.keyword_count(c, "KEY")) == [2, 0]


def test_decode_bytes(spark):
    values = ["é".encode(), "日本".encode("cp932"), b"\xef\xbb\xbfbom", b"\xff\xfe\xfa", None]
    got = column(spark, values, "binary", text.decode_bytes)
    assert got[:3] == ["é", "日本", "bom"] and got[4] is None and isinstance(got[3], str)


def test_identity_hashes(spark):
    row = spark.createDataFrame([("八代市", "高田コミュニティセンター", "八代市本野町505", None)], "m string, n string, a string, x string")
    got = row.select(scalars.stable_id(F.col("m"), F.col("n"), F.col("a")).alias("i"), scalars.record_hash([F.col("m"), F.col("x"), F.col("a")]).alias("h")).first()
    assert got["i"] == hashlib.sha256("八代市|高田コミュニティセンター|八代市本野町505".encode()).hexdigest()[:20]
    assert got["h"] == hashlib.sha256("八代市||八代市本野町505".encode()).hexdigest()


def test_tracking_id(spark):
    df = spark.createDataFrame([(1, ["b"]), (2, ["b", "a"]), (3, []), (4, None), (5, ["", "c", "c"])], "i int, ids array<string>")
    got = [r["t"] for r in df.select("i", scalars.tracking_id(F.col("ids"), F.lit("w")).alias("t")).orderBy("i").collect()]
    assert got == ["ref:b", "refgroup:" + hashlib.sha256(b"a|b").hexdigest()[:20], "web:w", "web:w", "ref:c"]


def test_numbers(spark):
    assert column(spark, ["1,234人", "-5", "---", "-", "不明", "", None, "x", "12 34", "99999999999999999999"], "string", scalars.parse_int) == [1234, -5, None, None, None, None, None, None, 12, None]
    got = column(spark, ["1,200", "0", "-1", "abc", "", None], "string", scalars.parse_capacity)
    assert [tuple(x) for x in got] == [(1200, "1,200", "parsed"), (None, "0", "missing_zero"), (None, "-1", "invalid_negative"), (None, "abc", "invalid"), (None, "", "missing"), (None, "", "missing")]
    assert column(spark, ["32.5", "1d", "1_0", " 33 ", "40", "", None, "3.2e1"], "string", lambda c: scalars.parse_coordinate(c, 31, 34)) == [32.5, None, None, 33.0, None, None, None, 32.0]
    assert column(spark, [0.0625, 0.7615, 0.5005, 0.9995, 0.0, None, 1.0], "double", scalars.score_text) == [f"{0.0625:.3f}", f"{0.7615:.3f}", f"{0.5005:.3f}", f"{0.9995:.3f}", "", "", "1.000"]
    with pytest.raises(Exception, match="not an integer"):
        column(spark, ["1x"], "string", scalars.parse_integer)
    assert column(spark, ["1,234"], "string", scalars.parse_integer) == [1234]


def test_haversine(spark):
    df = spark.createDataFrame([(32.5, 130.6, 32.5, 130.6), (0.0, 0.0, 0.0, 180.0), (32.0, 130.0, 32.00225, 130.0)], "a double, b double, c double, d double")
    got = [r["m"] for r in df.select(scalars.haversine_m(F.col("a"), F.col("b"), F.col("c"), F.col("d")).alias("m")).collect()]
    assert got[0] == 0 and abs(got[1] - 20015114.4) < 1 and abs(got[2] - 250.19) < 0.1


def test_datetimes(spark):
    d = dt.datetime
    values = ["2026/8/9 0:05", "26/08/09 00:05 現在", "2026年8月9日8時5分", "2026/13/1 1:00", "", None, "2026/2/30 1:00"]
    assert column(spark, values, "string", lambda c: scalars.parse_datetime(c).cast("timestamp_ntz")) == [d(2026, 8, 9, 0, 5), d(2026, 8, 9, 0, 5), d(2026, 8, 9, 8, 5), None, None, None, None]
    values = ["令和8年8月8日 12時00分", "8月8日 午後3時30分現在", "2025年8月8日 午前12時5分", "8月8日（土）15時0分", "none"]
    got = column(spark, values, "string", lambda c: scalars.era_datetime(c, F.lit(2026)).cast("timestamp_ntz"))
    assert got == [d(2026, 8, 8, 12), d(2026, 8, 8, 15, 30), d(2025, 8, 8, 0, 5), d(2026, 8, 8, 15), None]
    assert column(spark, ["2026/8/9", "2026-08-09", "x", "2026-13-01"], "string", scalars.parse_date) == [dt.date(2026, 8, 9), dt.date(2026, 8, 9), None, None]


def test_states_and_labels(spark):
    values = ["開設", "閉鎖", "未開設", "---", "-", "", None, "不明", "未入力", "開所中", "開設（解除）", "other"]
    assert column(spark, values, "string", scalars.open_state) == [True, False, False, False, False, None, None, None, None, True, False, None]
    df = spark.createDataFrame([(1, True, "混雑"), (2, True, "---"), (3, True, None), (4, False, "x"), (5, None, "x"), (6, True, "未入力")], "i int, s boolean, c string")
    rows = df.select("i", scalars.status_label(F.col("s"), F.col("c")).alias("a"), scalars.congestion_label(F.col("s"), F.col("c")).alias("b"), scalars.open_flag(F.col("s")).alias("f")).orderBy("i").collect()
    assert [r["a"] for r in rows] == ["開設（混雑）", "開設（不明）", "開設（不明）", "未開設", "状態不明", "開設（不明）"]
    assert [r["b"] for r in rows] == ["混雑", "不明", "不明", "未開設", "状態不明", "不明"] and [r["f"] for r in rows] == [1, 1, 1, 0, None, 1]
    assert column(spark, ["x", "web:x", "", None], "string", scalars.web_prefixed) == ["web:x", "web:x", "", ""]


def test_nfkc_matches_python(spark):
    values = ["ﬁ", "Å", "가", "½", "㍿"]
    assert column(spark, values, "string", text.nfkc) == [unicodedata.normalize("NFKC", v) for v in values]
