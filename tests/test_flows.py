"""The daily flows over literal tables."""

import pytest
from pyspark.sql import functions as F

from snapweave.operators import quality
from snapweave.plans import shelters

HEADERS = ["市町村", "避難所名", "開設状況", "混雑状況", "住所", "ルート検索"]
RAW = "_ord int, headers array<string>, cells array<string>"
REFERENCE = [("R1", "高田コミュニティセンター", "熊本県八代市本野町505"), ("R2", "代陽小学校", "熊本県八代市北の丸町1"), ("R3", "松橋体育館", "熊本県宇城市松橋町1")]


def reference(spark):
    return spark.createDataFrame(REFERENCE, "common_id string, shelter_name string, address string")


def day(spark, cells, previous, date):
    raw = spark.createDataFrame([(k, HEADERS, c) for k, c in enumerate(cells)], RAW)
    return shelters.daily_snapshot(raw, reference(spark), previous, date, min_rows=1)


@pytest.fixture(scope="module")
def two_days(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("flow")
    first = day(spark, [["八代市", "高田コミュニティセンター", "開設", "---", "八代市本野町505", "検索"], ["八代市", "謎の施設", "開設", "空き", "八代市どこか", "検索"]], None, "2026-08-01")
    first.tables["snapshot"].write.parquet(f"{root}/1")
    before = spark.read.parquet(f"{root}/1")
    second = day(spark, [["八代市", "高田コミュニティセンター", "開設", "混雑", "八代市本野町505", "検索"], ["宇城市", "松橋体育館", "開設", "", "宇城市松橋町1", "検索"]], before, "2026-08-02")
    second.tables["snapshot"].write.parquet(f"{root}/2")
    return first, before, second, spark.read.parquet(f"{root}/2")


def test_snapshots_and_changes(two_days):
    first, before, second, after = two_days
    assert {(r["shelter_id"][:5], r["opening_status"], r["change_type"]) for r in before.collect()} == {("ref:R", "開設", "new"), ("ref:R", shelters.NOT_LISTED, "new"), ("web:" + before.where("source = 'unmatched'").first()["shelter_id"][4], "開設", "new")}
    feed = {r["shelter_id"]: r["change_type"] for r in second.tables["changes"].collect()}
    assert feed["ref:R1"] == "congestion_changed" and feed["ref:R3"] == "opened;opening_status_changed;address_changed" and "removed_from_listing" in feed.values() and "ref:R2" not in feed
    assert after.count() == 3 and [r["shelter_name"] for r in first.tables["issues"].collect()] == ["謎の施設"]
    assert {r["rule"]: r["n_violations"] for r in first.report.collect()} == {"min_rows": 0, "named_rows": 0, "match_rate": 1, "unique_shelter_id": 0}
    quality.gate(second.report)


def test_enrichment(spark, two_days):
    capacity = spark.createDataFrame([("P1", "八代市", "高田コミュニティセンター", "八代市本野町505", "32.4871", "130.6168", 120, "120", "s", "t"), ("P2", "宇城市", "松橋体育館", "宇城市松橋町1", "32.6", "130.7", 80, "80", "s", "t")], "portal_shelter_id string, municipality string, shelter_name string, address string, portal_latitude string, portal_longitude string, portal_capacity_persons int, portal_capacity_raw string, capacity_source string, capacity_acquired_at_jst string")
    manual = spark.createDataFrame([("ref:R3", "宇城市", "松橋体育館", "", "32.61", "130.71")], "shelter_id string, municipality string, shelter_name string, address string, manual_latitude string, manual_longitude string")
    flow = shelters.enrich(two_days[3], capacity, manual)
    got = {r["shelter_id"]: (r["portal_capacity_persons"], r["capacity_match_method"], r["latitude"], r["coordinate_source"]) for r in flow.tables["enriched"].collect()}
    assert got == {"ref:R1": (120, "exact_municipality_name_address", "32.4871", "portal"), "ref:R2": (None, "no_candidate", None, None), "ref:R3": (80, "exact_municipality_name_address", "32.61", "manual")}
    quality.gate(flow.report)


def test_wide_series(two_days):
    history = two_days[1].unionByName(two_days[3])
    flow = shelters.wide_series(history)
    rows = {r["shelter_id"]: (r["2026-08-01"], r["2026-08-02"]) for r in flow.tables["status_by_date"].collect()}
    assert rows["ref:R1"] == ("開設（不明）", "開設（混雑）") and rows["ref:R2"] == ("未開設", "未開設") and rows["ref:R3"] == ("未開設", "開設（不明）")
    again = shelters.wide_series(history.withColumn("is_open", F.when(F.col("snapshot_date") == "2026-08-01", False).otherwise(F.col("is_open"))), {"open_by_date": flow.tables["open_by_date"]})
    assert {r["rule"]: r["n_violations"] for r in again.report.collect()}["past_cells_of_open_by_date"] == 2
    quality.gate(shelters.wide_series(history, {"open_by_date": flow.tables["open_by_date"]}).report)


def test_municipal_counts(spark):
    people = "municipality string, observed_at timestamp, shelter_name string, address string, evacuee_count int, _ord int"
    make = lambda rows: spark.createDataFrame(rows, people.replace("timestamp", "string")).withColumn("observed_at", F.col("observed_at").cast("timestamp"))
    masters = spark.createDataFrame([("s1", "八代市", "第一体育館", "甲町1", True, "10"), ("s2", "八代市", "第二公民館", "乙町2", False, "5")], "shelter_id string, municipality string, shelter_name string, address string, is_open boolean, capacity string")
    aliases = spark.createDataFrame([], "municipality string, source_shelter_name string, source_address string, shelter_id string, _ord int")
    empty = spark.createDataFrame([], people + ", shelter_id string, content_hash string, revision int")
    first = shelters.municipal_counts(make([("八代市", "2026-08-01 08:00", "第一体育館", "", 7, 1), ("八代市", "2026-08-01 08:00", "謎", "", 1, 2)]), empty, masters, aliases)
    log = spark.createDataFrame(first.tables["log"].toPandas(), first.tables["log"].schema)
    assert {r["rule"]: r["n_violations"] for r in first.report.collect()} == {"all_matched": 1, "one_record_a_shelter": 0}
    second = shelters.municipal_counts(make([("八代市", "2026-08-01 08:00", "第一体育館", "", 0, 1), ("八代市", "2026-08-02 08:00", "第二公民館", "", 3, 1)]), log, masters, aliases)
    assert sorted((r["shelter_id"], r["revision"]) for r in second.tables["new"].collect()) == [("s1", 2), ("s2", 1)]
    assert sorted(map(tuple, second.tables["evacuee_count_by_date"].collect())) == [("s1", 0, None), ("s2", None, 3)]
    same = shelters.municipal_counts(make([("八代市", "2026-08-01 08:00", "第一体育館", "", 7, 1), ("八代市", "2026-08-01 08:00", "謎", "", 1, 2)]), log, masters, aliases)
    assert same.tables["new"].count() == 0
