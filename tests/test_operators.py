"""Operators on literal tables: tie-breaks, diffs, upserts, revisions, pivots, linkage tiers and rules."""

import datetime as dt
import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from snapweave.operators import linkage, picks, quality, revisions, snapshot, spatial, timeseries, upsert

D = dt.date


def rows(df, *columns):
    return sorted(map(tuple, df.select(*columns).collect()), key=repr)


def test_ties_first_and_last(spark):
    df = spark.createDataFrame([("a", 1, 10), ("a", 1, 11), ("a", 0, 9), ("b", 2, 5)], "k string, p int, o int")
    assert rows(picks.first_wins(df, ["k"], [F.col("p")], "o"), "k", "o") == [("a", 10), ("b", 5)]
    assert rows(picks.last_wins(df, ["k"], "o"), "k", "o") == [("a", 11), ("b", 5)]
    assert rows(picks.max_rows(df, ["k"], "p"), "k", "o") == [("a", 10), ("a", 11), ("b", 5)]
    assert rows(picks.top_with_margin(df, ["k"], "p", "o"), "k", "o", "runner_up", "margin") == [("a", 10, 1.0, 0.0), ("b", 5, 0.0, 2.0)]


def test_row_priorities(spark):
    df = spark.createDataFrame([(1, None, "matched", None, None), (2, True, None, None, None), (3, False, "matched", "matched", "complete"), (4, True, "matched_multiple", "x", "complete")], "o int, s boolean, r string, c string, g string").withColumn("k", F.lit(1))
    order = picks.row_priorities(F.col("s"), F.col("r"), F.col("c"), F.col("g"))
    assert rows(picks.first_wins(df, ["k"], order, "o"), "o") == [(4,)]


def test_streaks(spark):
    df = spark.createDataFrame([("a", D(2026, 8, d)) for d in (1, 2, 3, 5, 5, 6)], "k string, d date")
    assert rows(picks.open_streaks(df, ["k"], "d"), "first_day", "days") == [(D(2026, 8, 1), 3), (D(2026, 8, 5), 2)]


SNAP = "shelter_id string, is_open boolean, opening_status string, congestion_status string, evacuee_count int, address string"


def test_diff_labels_and_details(spark):
    old = spark.createDataFrame([("a", False, "未開設", "", None, "x"), ("b", True, "開設", "空き", 3, "x"), ("c", True, "開設", "空き", 3, "x"), ("d", None, "", "", None, "x"), ("gone", True, "開設", "", 1, "x")], SNAP)
    new = spark.createDataFrame([("a", True, "開設", "", None, "x"), ("b", False, "閉鎖", "混雑", 3, "y"), ("c", True, "開設", " 空き ", 3, "x"), ("d", True, "開設", "", None, "x"), ("e", True, "開設", "", 5, "x")], SNAP)
    got = {r["shelter_id"]: (r["change_type"], r["change_details"]) for r in snapshot.diff(new, old).collect()}
    assert got["a"] == ("opened;opening_status_changed", "未開設または閉鎖から開設へ変化 / 開設状況: 未開設 -> 開設")
    assert got["b"] == ("closed;opening_status_changed;congestion_changed;address_changed", "開設から未開設または閉鎖へ変化 / 開設状況: 開設 -> 閉鎖 / 混雑状況: 空き -> 混雑 / 住所: x -> y")
    assert got["c"] == ("unchanged", "")
    assert got["d"] == ("open_state_changed;opening_status_changed", "is_open: unknown -> true / 開設状況: (空欄) -> 開設")
    assert got["e"] == ("new", "前回スナップショットに同一避難所なし")
    feed = snapshot.changes(new, old, overrides={"opening_status": F.lit("掲載なし")})
    assert rows(feed.where("shelter_id = 'gone'"), "change_type", "opening_status", "is_open", "evacuee_count") == [("removed_from_listing", "掲載なし", True, 1)]
    assert feed.where("shelter_id = 'c'").count() == 0


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.dictionaries(st.sampled_from("abcdef"), st.sampled_from(["x", "y"])), st.dictionaries(st.sampled_from("abcdef"), st.sampled_from(["x", "y"])))
def test_diff_partitions_both_days(spark, old, new):
    make = lambda m: spark.createDataFrame([(k, True, v, "", None, "") for k, v in m.items()], SNAP)
    kinds = {r["shelter_id"]: r["change_type"] for r in snapshot.diff(make(new), make(old)).collect()}
    assert kinds == {k: "new" if k not in old else "unchanged" if old[k] == v else "opening_status_changed" for k, v in new.items()}
    assert {r["shelter_id"] for r in snapshot.removed(make(new), make(old)).collect()} == set(old) - set(new)


def test_overlay(spark):
    population = spark.createDataFrame([("a",), ("b",)], "k string")
    listed = spark.createDataFrame([("a", "old", 1), ("a", "new", 2), ("z", "odd", 3)], "k string, v string, o int")
    assert rows(snapshot.overlay(population, listed, "k", {"v": F.lit("none")}, "o"), "k", "v", "source") == [("a", "new", "listed"), ("b", "none", "default"), ("z", "odd", "unmatched")]


MASTER = "id string, key string, capacity int, status string, name string, o int"


def test_merge_master(spark):
    old = spark.createDataFrame([("1", "k1", 10, "parsed", "a", 1), ("2", "", 20, "parsed", "b", 2), ("", "k3", 30, "preserved_previous_parsed", "c", 3), ("4", "", None, "missing", "d", 4), ("", "", 9, "parsed", "nokey", 5), ("1", "k1", 11, "parsed", "a2", 6)], MASTER)
    new = spark.createDataFrame([("1", "k1", None, "missing", "A", 1), ("2", "", 25, "parsed", "B", 2), ("", "k3", None, "invalid", "C", 3), ("5", "", None, "missing", "E", 4)], MASTER)
    got = rows(upsert.merge_master(old, new, ["id", "key"], ["capacity"], "status", "o"), "name", "capacity", "status")
    assert got == [("A", 11, "preserved_previous_parsed"), ("B", 25, "parsed"), ("C", 30, "preserved_previous_parsed"), ("E", None, "missing"), ("d", None, "missing")]
    again = upsert.merge_master(upsert.merge_master(old, new, ["id", "key"], ["capacity"], "status", "o"), new.drop("o"), ["id", "key"], ["capacity"], "status")
    assert rows(again, "name", "capacity", "status") == got
    once = upsert.merge_master(old, new, ["id", "key"], ["capacity"], "status", "o", keep_preserved=False)
    assert ("C", None, "invalid") in rows(once, "name", "capacity", "status")
    assert rows(upsert.not_smaller(old, new), "n_violations") == [(2,)]


def test_log_upsert(spark):
    a = spark.createDataFrame([("d1", "t1", 1), ("d1", "t2", 2)], "d string, t string, v int")
    b = spark.createDataFrame([("d1", "t2", 9), ("d2", "t0", 3)], "d string, t string, v int")
    assert [tuple(r) for r in upsert.upsert_log(a, b, ["d", "t"], ["d", "t"]).collect()] == [("d1", "t1", 1), ("d1", "t2", 9), ("d2", "t0", 3)]


OBS = "s string, t string, h string, o int"


def test_revisions(spark):
    log = spark.createDataFrame([("x", "t1", "A", 1, 1), ("x", "t1", "B", 2, 2)], OBS + ", revision int")
    new = spark.createDataFrame([("x", "t1", "A", 3), ("x", "t1", "C", 4), ("x", "t1", "C", 5), ("x", "t1", "D", 6), ("y", "t1", "A", 7)], OBS)
    assert rows(revisions.assign_revisions(new, log, "s", "t", "h", "o"), "s", "h", "revision") == [("x", "C", 3), ("x", "D", 4), ("y", "A", 1)]
    back = revisions.assign_revisions(new, log, "s", "t", "h", "o", against_latest=True)  # A again counts, as B is current
    assert rows(back, "s", "h", "revision") == [("x", "A", 3), ("x", "C", 4), ("x", "D", 5), ("y", "A", 1)]
    assert rows(revisions.latest_revision(log, "s", "t"), "h") == [("B",)]


def test_best_of_day(spark):
    log = spark.createDataFrame([("a", "d", "09:00", 1, 1, 5), ("a", "d", "12:00", 1, 2, 6), ("a", "d", "12:00", 2, 3, 0), ("a", "d", "12:00", 2, 4, 8)], "k string, d string, t string, revision int, o int, n int")
    assert rows(revisions.best_of_day(log, "k", "d", "t", "o"), "n") == [(0,)]


def test_wide_tables(spark):
    long = spark.createDataFrame([("a", "2026-08-01", 3), ("a", "2026-08-03", 0), ("b", "2026-08-02", 1)], "k string, d string, n int")
    dates = timeseries.date_columns(long, column="d")
    assert dates == ["2026-08-01", "2026-08-02", "2026-08-03"]
    people = spark.createDataFrame([("a",), ("c",)], "k string")
    assert rows(timeseries.wide_counts(people, long, "k", "d", "n", dates), "*") == [("a", 3, None, 0), ("c", None, None, None)]
    wide = timeseries.pivot_dates(long, ["k"], "d", F.col("n").cast("string"), dates, "-")
    assert rows(wide, "*") == [("a", "3", "-", "0"), ("b", "-", "1", "-")]
    back = timeseries.unpivot_dates(wide, ["k"], dates, "d", "n").where("n <> '-'")
    assert rows(back, "k", "d", F.col("n").cast("int")) == rows(long, "*")
    assert timeseries.changed_cells(wide, wide, ["k"], dates).count() == 0
    assert timeseries.wide_schema_errors(["k", *dates], ["k"]) == [] and timeseries.wide_schema_errors(["k", "x", "2026-08-02", "2026-08-01"], ["i"]) == ["fixed columns differ", "not a date: x", "dates not ascending"]


def test_last_non_blank(spark):
    df = spark.createDataFrame([("a", 1, "x", "1"), ("a", 2, "y", " "), ("a", 3, None, ""), ("b", 1, "", None)], "k string, d int, v string, w string")
    assert rows(timeseries.last_non_blank(df, ["k"], ["v", "w"], ["d"]), "k", "v", "w") == [("a", "y", "1"), ("b", None, None)]


REF = [("R1", "八代市", "高田コミュニティセンター", "八代市本野町505"), ("R2", "八代市", "代陽小学校", "八代市北の丸町1"), ("R3", "八代市", "代陽小学校", "八代市北の丸町1"), ("R4", "宇城市", "松橋体育館", "宇城市松橋町1"), ("R5", "八代市", "松橋体育館", "八代市松江町9"), ("R6", "八代市", "中央公民館", "八代市甲1"), ("R7", "八代市", "中央公民館", "八代市乙2"), ("R8", "宇土市", "宇土市総合福祉センター別館", "宇土市浦田町44")]
SRC = "row_id int, municipality string, shelter_name string, address string"


def test_reference_cascade(spark):
    master = spark.createDataFrame(REF, "common_id string, municipality string, shelter_name string, address string")
    source = spark.createDataFrame([(1, "八代市", "高田コミュニティーセンター", "熊本県八代市本野町 505"), (2, "八代市", "代陽小学校", "八代市北の丸町１"), (3, "宇城市", "松橋体育館", "違う住所"), (4, "八代市", "中央公民館", ""), (5, "美里町", "高田コミュニティセンター", ""), (6, "八代市", "", "x"), (7, "宇土市", "宇土市総合福祉センタ別舘", "宇土市浦田町44"), (8, "八代市", "まったく別の施設", "y"), (9, "美里町", "代陽小学校", "")], SRC)
    got = {r["row_id"]: (r["status"], r["method"], round(r["score"], 3), r["matches"]) for r in linkage.match_reference(source, master).collect()}
    assert got[1] == ("matched", "exact_name_address", 1.0, ["R1"])
    assert got[2] == ("matched_multiple", "exact_name_address", 1.0, ["R2", "R3"])
    assert got[3] == ("matched", "exact_name_municipality", 0.99, ["R4"])
    assert got[4] == ("ambiguous", "exact_name_multiple_addresses", 0.0, [])
    assert got[5] == ("unmatched", "exact_name_municipality_conflict", 0.0, [])
    assert got[6] == ("unmatched", "missing_name", 0.0, [])
    assert got[7][1] in ("high_confidence_fuzzy", "fuzzy_below_threshold") and got[7][2] > 0.9
    assert got[8] == ("unmatched", "no_candidate", 0.0, [])
    assert got[9] == ("matched_multiple", "exact_name_same_address", 0.97, ["R2", "R3"])
    enriched = linkage.enrich_reference(linkage.match_reference(source, master), master, attributes=["shelter_name"])
    assert rows(enriched.where("row_id = 2"), "reference_common_id", "reference_match_count") == [("R2", 2)]


def test_fuzzy_limits(spark):
    pairs = spark.createDataFrame([(1, "m1", "abcdefghijklmnopqrst", "", "abcdefghijklmnopqrsx", ""), (2, "m1", "abcdefghij", "", "abcdefghix", ""), (3, "m1", "abcdefghijklmnopqrst", "", "abcdefghijklmnopqrsx", ""), (3, "m2", "abcdefghijklmnopqrst", "", "abcdefghijklmnopqrsy", ""), (4, "m1", "abcdefghijklmnopqrst", "zzzz", "abcdefghijklmnopqrsx", "aaaa"), (5, "m1", "abc", "", "xyz", "")], "row_id int, m_id string, s_name string, s_addr string, m_name string, m_addr string")
    got = {r["row_id"]: (r["status"], r["method"], round(r["score"], 3), r["candidates"]) for r in linkage.fuzzy_tier(pairs, "row_id", "m_id", linkage.REFERENCE_FUZZY).collect()}
    assert got == {1: ("matched", "high_confidence_fuzzy", 0.95, ["m1"]), 2: ("unmatched", "fuzzy_below_threshold", 0.9, ["m1"]), 3: ("unmatched", "fuzzy_below_threshold", 0.95, ["m1", "m2"]), 4: ("unmatched", "fuzzy_below_threshold", 0.779, ["m1"])}


def test_radius_join_equals_all_pairs(spark):
    r = random.Random(1)
    a = [(k, 32 + r.random() * 0.05, 130 + r.random() * 0.05) for k in range(60)] + [(99, None, 130.0)]
    b = [(k, 32 + r.random() * 0.05, 130 + r.random() * 0.05) for k in range(60)]
    left, right = spark.createDataFrame(a, "i int, la double, lo double"), spark.createDataFrame(b, "j int, lb double, ob double")
    from snapweave.functions.scalars import haversine_m

    want = rows(left.crossJoin(right).where(haversine_m(F.col("la"), F.col("lo"), F.col("lb"), F.col("ob")) <= 600), "i", "j")
    for spread in (1, 3):
        assert rows(spatial.radius_join(left, right, 600, "la", "lo", "lb", "ob", 34.0, spread=spread), "i", "j") == want and want


def test_nearest_acceptance(spark):
    df = spark.createDataFrame([(1, "a", 10.0, 0.56, 0.0), (2, "a", 10.0, 0.5, 1.0), (3, "a", 70.0, 0.73, 0.36), (4, "a", 70.0, 0.73, 0.3), (5, "a", 70.0, 0.91, 0.0), (6, "a", 199.0, 0.95, 0.56), (7, "a", 199.0, 0.95, 0.5), (8, "a", 10.0, 0.9, 0.9), (8, "b", 21.0, 0.87, 0.9), (9, "a", 10.0, 0.9, 0.9), (9, "b", 22.0, 0.9, 0.9), (10, "a", 200.5, 1.0, 1.0)], "k int, target_id string, distance_m double, name_score double, address_score double")
    got = {r["k"]: r["status"] for r in spatial.accept_nearest(df, "k").collect()}
    assert got == {1: "matched", 2: None, 3: "matched", 4: None, 5: "matched", 6: "matched", 7: None, 8: "ambiguous", 9: "matched", 10: None}
    scores = {r["k"]: r["score"] for r in spatial.accept_nearest(df, "k").collect()}
    assert scores[1] == 0.80 and scores[9] == pytest.approx(min(0.999, 0.58 * 0.9 + 0.17 * 0.9 + 0.25 * (1 - 10 / 250) + 0.08))


def test_nearest_acceptance_with_other_tiers(spark):
    df = spark.createDataFrame([(1, "a", 90.0, 0.5, 0.0), (2, "a", 90.0, 0.9, 0.0), (3, "a", 300.0, 0.9, 0.0), (4, "a", 301.0, 1.0, 1.0)], "k int, target_id string, distance_m double, name_score double, address_score double")
    tiers = ((100.0, 0.8, 0.0, 0.0), (300.0, 0.4, 0.0, 0.0))
    got = lambda **named: rows(spatial.accept_nearest(df, "k", rules=spatial.Acceptance(tiers=tiers, **named)), "k", "status", "method")
    assert got() == [(1, "matched", "coordinate_300m"), (2, "matched", "coordinate_100m"), (3, "matched", "coordinate_300m"), (4, None, None)]
    assert got(methods=("near", "far"))[:2] == [(1, "matched", "far"), (2, "matched", "near")]
    with pytest.raises(ValueError, match="2 tiers, but 1 methods"):
        got(methods=("near",))


def test_first_targets_hold_the_nearest(spark):
    r = random.Random(2)
    a = [(k, 32 + r.randint(0, 9) * 0.001, 130.0) for k in range(8)]
    b = [(j, 32 + r.randint(0, 9) * 0.001, 130.0) for j in range(90)]
    left, right = spark.createDataFrame(a, "i int, la double, lo double"), spark.createDataFrame(b, "j int, lb double, ob double")
    few = spatial.first_targets(right, ["lb", "ob"], "j")
    assert few.groupBy("lb", "ob").count().agg(F.max("count")).first()[0] == 2
    nearest = lambda targets: rows(spatial.accept_nearest(spatial.radius_join(left, targets, 600, "la", "lo", "lb", "ob", 34.0).withColumns({"name_score": F.lit(1.0), "address_score": F.lit(1.0)}), "i", tie="j"), "i", "j", "status")
    assert nearest(few) == nearest(right) and nearest(few)


CAP = "portal_shelter_id string, municipality string, shelter_name string, address string, portal_latitude string, portal_longitude string, portal_capacity_persons int, portal_capacity_raw string, capacity_source string, capacity_acquired_at_jst string"


def test_capacity_cascade(spark):
    c = lambda i, m, n, a, la="", lo="", p=10: (i, m, n, a, la, lo, p, str(p), "s", "t")
    master = spark.createDataFrame([c("P1", "八代市", "A小学校", "本野町1"), c("P2", "八代市", "B公民館", "北町22"), c("P3", "八代市", "C会館", "x1"), c("P4", "八代市", "C会館", "x1"), c("P5", "八代市", "D体育館", "", "32.5000", "130.6000"), c("P6", "八代市", "", "z")], CAP)
    source = spark.createDataFrame([(1, "八代市", "A小学校", "本野町1", "", None, None), (2, "八代市", "B公民館", "", "", None, None), (3, "八代市", "B公民館", "まったく違う", "", None, None), (4, "八代市", "C会館", "x1", "", None, None), (5, "八代市", "D体育舘", "q", "", "32.50005", "130.60005"), (6, "八代市", "zz", "", "P2", None, None), (7, "宇城市", "zz", "", "nope", None, None)], SRC + ", portal_shelter_id string, latitude string, longitude string")
    decisions = linkage.match_capacity(source, master)
    got = {r["row_id"]: (r["status"], r["method"], r["matches"]) for r in decisions.collect()}
    assert got[1] == ("matched", "exact_municipality_name_address", ["P1"]) and got[2] == ("matched", "exact_name_municipality", ["P2"])
    assert got[3][0] == "unmatched" and got[4] == ("ambiguous", "duplicate_exact_key", [])
    assert got[5] == ("matched", "coordinate_with_name_20m", ["P5"]) and got[6] == ("matched", "portal_shelter_id", ["P2"]) and got[7] == ("unmatched", "no_candidate", [])
    enriched = linkage.enrich_capacity(source, decisions, master)
    assert rows(enriched.where("row_id in (1, 3)"), "row_id", "portal_capacity_persons", "capacity_match_status") == [(1, 10, "matched"), (3, None, "unmatched")]


def test_manual_coordinates(spark):
    manual = spark.createDataFrame([("ref:1", "八代市", "a", "x"), ("web:w2", "八代市", "b", "x"), ("web:w3", "八代市", "c", "x"), ("i4", "八代市", "d", "x"), ("i5", "八代市", "d", "x")], "shelter_id string, municipality string, shelter_name string, address string")
    source = spark.createDataFrame([(1, "八代市", "q", "", "ref:1", ""), (2, "八代市", "q", "", "s", "web:w2"), (3, "八代市", "q", "", "s", "w3"), (4, "八代市", "d", "x", "s", ""), (5, "八代市", "a", "x", None, None), (6, "八代市", "none", "", "s", "s")], SRC + ", shelter_id string, web_shelter_id string")
    got = {r["row_id"]: (r["status"], r["method"], r["matches"]) for r in linkage.match_manual(source, manual).collect()}
    assert got == {1: ("matched", "manual_shelter_id", ["ref:1"]), 2: ("matched", "manual_web_shelter_id", ["web:w2"]), 3: ("matched", "manual_web_shelter_id", ["web:w3"]), 4: ("ambiguous", "manual_duplicate_identity", []), 5: ("matched", "manual_exact_identity", ["ref:1"]), 6: ("unmatched", "manual_no_match", [])}


def test_municipal_cascade(spark):
    master = spark.createDataFrame([("s1", "八代市", "第一体育館", "甲町1番", True, "10"), ("s2", "八代市", "第二公民館", "乙町2番", False, "0"), ("s3", "八代市", "第三会館", "丙町3番", True, "5"), ("s4", "八代市", "第三会館", "丁町4番", False, "5"), ("web:5", "八代市", "第五会館", "戊町五丁目123", False, "9"), ("s6", "八代市", "第五会館", "己町6番", False, "9")], "shelter_id string, municipality string, shelter_name string, address string, is_open boolean, capacity string")
    aliases = spark.createDataFrame([("八代市", "別名", "", "s2", 1), ("八代市", "別名", "庚町7", "s1", 2), ("八代市", "無効", "", "nope", 3)], "municipality string, source_shelter_name string, source_address string, shelter_id string, _ord int")
    source = spark.createDataFrame([(1, "八代市", "別名", "庚町7"), (2, "八代市", "無効", ""), (3, "宇城市", "x", "y"), (4, "八代市", "第一体育館", "八代市甲町1番"), (5, "八代市", "第二公民館", ""), (6, "八代市", "第三会館", ""), (7, "八代市", "第五会館", ""), (8, "八代市", "無関係な名前です", "どこか")], SRC)
    got = {r["row_id"]: (r["status"], r["method"], r["matches"]) for r in linkage.match_municipal(source, master, aliases).collect()}
    assert got[1] == ("matched", "manual_alias", ["s1"]) and got[2] == ("unmatched", "alias_target_missing", []) and got[3] == ("unmatched", "municipality_not_found", [])
    assert got[4][:1] + got[4][2:] == ("matched", ["s1"]) and got[5] == ("matched", "exact_normalized_name_without_source_address", ["s2"])
    assert got[6] == ("matched", "exact_normalized_name_open_priority_without_source_address", ["s3"]) and got[7] == ("matched", "exact_name_web_master_quality_without_source_address", ["web:5"])
    assert got[8][0] == "unmatched"


def test_rules_and_gate(spark):
    df = spark.createDataFrame([(1, "a", 5), (2, "b", None), (2, "c", -1)], "i int, k string, n int")
    report = quality.check_rows(df, {"positive": F.col("n") < 0, "filled": F.col("n").isNull()}, "k").unionByName(quality.unique(df, ["i"], "unique_i")).unionByName(quality.least(df, "rows", F.count("*"), 4))
    assert rows(report, "rule", "n_violations", "example") == [("filled", 1, "b"), ("positive", 1, "c"), ("rows", 1, "3"), ("unique_i", 1, "2")]
    with pytest.raises(ValueError, match="filled, positive, rows, unique_i"):
        quality.gate(report)
    with pytest.raises(ValueError, match="missing columns"):
        quality.require(df, ["i", "zz"])
    assert quality.gate(quality.foreign_key(df, df, "k", "k", "self")).count() == 1
    assert quality.same_content(df.withColumn("t", F.lit(1)), df.withColumn("t", F.lit(2)), ["t"]) and not quality.same_content(df, df.limit(2))
    near = spark.createDataFrame([(1, 1.0)], "i int, x double")
    assert quality.cell_differences(near, near.withColumn("x", F.col("x") + 1e-12), ["i"], ["x"], 1e-10).count() == 0
