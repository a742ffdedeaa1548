"""The four daily flows, end to end: snapshot, capacity and coordinates, wide series, municipal counts.

Each takes and returns DataFrames; nothing is written here, so a flow can be checked before its sinks run.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapweave.functions import scalars, text
from snapweave.operators import linkage, picks, quality, revisions, snapshot, timeseries
from snapweave.sources.tables import clean_rows

NOT_LISTED = "未開設（Web開設一覧に掲載なし）"
REMOVED = "Web開設一覧から削除"
#: Columns of the compact wide tables, before the dates.
STATUS_COLUMNS = ["shelter_id", "municipality", "shelter_name", "address", "portal_capacity_persons", "latitude", "longitude", "coordinate_source", "reference_common_id", "capacity_match_status", "coordinate_status"]


@dataclass
class Flow:
    tables: dict[str, DataFrame] = field(default_factory=dict)
    report: DataFrame | None = None


def _normalise(rows: DataFrame) -> DataFrame:
    """Scraped maps as records with their identity."""
    from snapweave.sources.tables import HEADER_ALIASES, canonical_header

    keys = [r["k"] for r in rows.select(F.explode(F.map_keys("row")).alias("k")).distinct().collect()]  # header words of one page
    place = {}
    for k in sorted(keys):
        place.setdefault(canonical_header(k), k)
    columns = {c: text.normalize_text(F.col("row")[place[c]]) if c in place else F.lit("") for c in HEADER_ALIASES}
    out = rows.select("_ord", *(v.alias(c) for c, v in columns.items()), F.to_json("row").alias("raw_row_json"))
    fold = lambda c: text.casefold(F.col(c))
    return out.withColumns({"is_open": scalars.open_state(F.col("opening_status")), "evacuee_count": scalars.parse_int(F.col("evacuee_count")).cast("int"), "web_shelter_id": scalars.stable_id(fold("municipality"), fold("shelter_name"), fold("address"))})


def daily_snapshot(raw: DataFrame, reference: DataFrame, previous: DataFrame | None, day: str, min_rows: int = 100, min_match_rate: float = 0.75) -> Flow:
    """Scraped rows (headers, cells, _ord) to the day's full population, its changes, and rows for review.

    reference: common_id, shelter_name, address. The report gates rows, names and match rate; review rows are
    in the result whatever the report says.
    """
    records = _normalise(clean_rows(raw)).withColumn("row_id", F.col("_ord"))
    decisions = linkage.match_reference(records.select("row_id", "municipality", "shelter_name", "address"), reference)
    enriched = linkage.enrich_reference(decisions, reference).select("row_id", F.col("status").alias("reference_match_status"), F.col("method").alias("reference_match_method"), F.col("score").alias("reference_match_score"), "reference_match_count", "reference_common_id", "reference_common_ids")
    listed = records.join(enriched, "row_id", "left")
    listed = listed.withColumn("shelter_id", scalars.tracking_id(F.col("reference_common_ids"), F.col("web_shelter_id")))
    groups = reference.withColumns({"_n": text.name_key_reference(F.col("shelter_name")), "_a": text.address_key(F.col("address"))}).groupBy("_n", "_a").agg(F.array_sort(F.collect_list(F.col("common_id").cast("string"))).alias("reference_common_ids"), F.min_by("shelter_name", "common_id").alias("shelter_name"), F.min_by("address", "common_id").alias("address"), F.min("common_id").cast("string").alias("reference_common_id"))
    population = groups.withColumns({"shelter_id": scalars.tracking_id(F.col("reference_common_ids"), F.lit("")), "municipality": text.infer_municipality(F.col("address"))})
    web = listed.select("shelter_id", "opening_status", "congestion_status", "evacuee_count", "is_open", "municipality", "shelter_name", "address", "route_search", "web_shelter_id", "raw_row_json", "reference_match_status", "reference_match_method", "reference_match_score", "_ord")
    dense = snapshot.overlay(population, web, "shelter_id", {"opening_status": F.lit(NOT_LISTED), "is_open": F.lit(False), "reference_match_status": F.lit("matched"), "reference_match_method": F.lit("population_default"), "reference_match_score": F.lit(1.0)}, "_ord")
    named = population.select("shelter_id", *(F.col(c).alias(f"_{c}") for c in ("municipality", "shelter_name", "address", "reference_common_id", "reference_common_ids")))
    full = dense.join(named, "shelter_id", "left").withColumns({c: F.coalesce(c, f"_{c}") for c in ("municipality", "shelter_name", "address")}).withColumns({"reference_common_id": F.col("_reference_common_id"), "reference_common_ids": F.array_join(F.coalesce("_reference_common_ids", F.array()), ";")}).drop("_municipality", "_shelter_name", "_address", "_reference_common_id", "_reference_common_ids")
    full = full.withColumns({"snapshot_date": F.to_date(F.lit(day)), "record_hash": scalars.record_hash([F.col(c) for c in ("municipality", "shelter_name", "opening_status", "congestion_status", "evacuee_count", "address", "reference_common_ids")])})
    old = previous if previous is not None else full.limit(0)
    today = snapshot.diff(full, old)
    feed = today.where("change_type <> 'unchanged'").unionByName(snapshot.removed(full, old, overrides={"opening_status": F.lit(REMOVED), "snapshot_date": F.to_date(F.lit(day))}), allowMissingColumns=True)
    matched = F.col("reference_match_status").isin("matched", "matched_multiple")
    report = quality.least(listed, "min_rows", F.count("*"), min_rows).unionByName(quality.least(listed, "named_rows", F.count_if(F.col("shelter_name") != ""), 1)).unionByName(quality.least(listed, "match_rate", F.try_divide(F.count_if(matched), F.count("*")), min_match_rate)).unionByName(quality.unique(today, ["shelter_id"], "unique_shelter_id"))
    return Flow({"snapshot": today.orderBy("municipality", "shelter_name", "address", "shelter_id"), "changes": feed.orderBy("municipality", "shelter_name", "change_type"), "issues": listed.where(F.col("reference_match_status").isin("ambiguous", "unmatched"))}, report)


def enrich(snapshots: DataFrame, capacity: DataFrame, manual: DataFrame) -> Flow:
    """Capacity first, then coordinates, from rows that weren't enriched before."""
    base = snapshots.withColumn("row_id", F.xxhash64("shelter_id", "snapshot_date"))
    reference = scalars.valid_pair(F.col("reference_latitude"), F.col("reference_longitude")) if "reference_latitude" in base.columns else F.lit(None).cast("struct<latitude:string,longitude:string>")
    known = base.withColumn("_ref", reference).withColumns({"latitude": F.col("_ref.latitude"), "longitude": F.col("_ref.longitude")})
    decisions = linkage.match_capacity(known.drop("portal_shelter_id"), capacity)
    out = linkage.enrich_capacity(known, decisions, capacity)
    places = linkage.match_manual(base.select("row_id", "shelter_id", "web_shelter_id", "municipality", "shelter_name", "address"), manual)
    found = places.select("row_id", F.col("status").alias("manual_geocode_status"), F.col("method").alias("manual_geocode_method"), F.get("matches", 0).alias("_m")).join(manual.select(F.col("shelter_id").alias("_m"), "manual_latitude", "manual_longitude"), "_m", "left").drop("_m")
    out = out.drop("latitude", "longitude").join(found, "row_id", "left")
    pair = lambda a, b: scalars.valid_pair(F.col(a), F.col(b))
    chosen = linkage.choose_coordinates([("reference", F.col("_ref")), ("manual", pair("manual_latitude", "manual_longitude")), ("portal", pair("portal_latitude", "portal_longitude"))])
    out = out.select("*", *chosen).drop("_ref")
    report = quality.check_rows(out, {"capacity_source_available": F.col("capacity_match_status") == "master_unavailable", "pair_is_whole": F.col("latitude").isNull() != F.col("longitude").isNull(), "manual_before_portal": (F.col("coordinate_source") == "portal") & pair("manual_latitude", "manual_longitude").isNotNull()}, "shelter_id").unionByName(quality.foreign_key(out, capacity, "portal_shelter_id", "portal_shelter_id", "known_portal_id"))
    return Flow({"enriched": out, "issues": out.where("capacity_match_status <> 'matched'")}, report)


def wide_series(history: DataFrame, old: dict[str, DataFrame] | None = None) -> Flow:
    """Status, open flag and congestion by date, one best row for each shelter and day, metadata from its last non-blank values."""
    have = lambda c: F.col(c) if c in history.columns else F.lit(None).cast("string")
    order = picks.row_priorities(F.col("is_open"), have("reference_match_status"), have("capacity_match_status"), have("coordinate_status"))
    ordered = history.where(F.trim(F.coalesce("shelter_id", F.lit(""))) != "")
    ordered = ordered if "_ord" in ordered.columns else ordered.withColumn("_ord", F.monotonically_increasing_id())
    best = picks.first_wins(ordered, ["snapshot_date", "shelter_id"], order, "_ord").withColumn("day", F.date_format("snapshot_date", "yyyy-MM-dd"))
    dates = timeseries.date_columns(best, column="snapshot_date")
    fixed = [c for c in STATUS_COLUMNS if c in best.columns]
    meta = timeseries.last_non_blank(best, ["shelter_id"], [c for c in fixed if c != "shelter_id"], ["snapshot_date"])
    state, crowd = F.col("is_open"), have("congestion_status")
    tables = {}
    for name, value, default in (("status_by_date", scalars.status_label(state, crowd), "未開設"), ("open_by_date", F.coalesce(scalars.open_flag(state).cast("string"), F.lit("")), "0"), ("congestion_by_date", scalars.congestion_label(state, crowd), "未開設")):
        wide = timeseries.pivot_dates(best, ["shelter_id"], "day", value, dates, default)
        tables[name] = meta.join(wide, "shelter_id").select(*fixed, *dates).orderBy(*(c for c in ("municipality", "shelter_name", "shelter_id") if c in fixed))
    report = quality.unique(best, ["snapshot_date", "shelter_id"], "one_row_a_day")
    for name, before in (old or {}).items():
        past = [d for d in before.columns if d in dates and d != dates[-1]]
        cells = timeseries.changed_cells(before.select("shelter_id", *past), tables[name].join(before.select("shelter_id"), "shelter_id", "left_semi").select("shelter_id", *past), ["shelter_id"], past)
        report = report.unionByName(quality.check_rows(cells, {f"past_cells_of_{name}": F.lit(True)}, "shelter_id"))
    return Flow(tables, report)


def municipal_counts(sources: DataFrame, log: DataFrame, shelters: DataFrame, aliases: DataFrame) -> Flow:
    """Records of municipal sources to revisioned observations and the counts of each day.

    sources: municipality, observed_at, shelter_name, address, evacuee_count, _ord. log: those with shelter_id,
    content_hash and revision. A content known at an observed time is ignored; a changed one is a new revision.
    """
    keyed = sources.withColumns({"_n": text.name_key_municipal(F.col("shelter_name")), "_a": text.address_key_municipal(F.col("address"))})
    hashes = revisions.snapshot_hash(keyed, ["municipality", "observed_at"], ["municipality", "_n", "_a"], ["municipality", "shelter_name", "address", "evacuee_count"])
    fresh = revisions.assign_revisions(hashes.withColumn("_ord", F.lit(0)), log, "municipality", "observed_at", "content_hash", "_ord").drop("_ord")
    rows = sources.join(fresh, ["municipality", "observed_at"]).withColumn("row_id", F.xxhash64("municipality", "observed_at", "_ord"))
    decisions = linkage.match_municipal(rows.select("row_id", "municipality", "shelter_name", "address"), shelters, aliases)
    new = rows.join(decisions, "row_id").select("municipality", "observed_at", "shelter_name", "address", "evacuee_count", F.get("matches", 0).alias("shelter_id"), F.col("status").alias("match_status"), F.col("method").alias("match_method"), F.col("score").alias("match_score"), F.get("candidates", 0).alias("candidate_1"), F.get("candidates", 1).alias("candidate_2"), "content_hash", "revision", "_ord")
    everything = log.unionByName(new, allowMissingColumns=True)
    current = revisions.latest_revision(everything, "municipality", "observed_at").where("shelter_id is not null")
    daily = revisions.best_of_day(current.withColumn("day", F.date_format("observed_at", "yyyy-MM-dd")), "shelter_id", "day", "observed_at", "_ord")
    dates = timeseries.date_columns(current, column="observed_at")
    wide = timeseries.wide_counts(shelters.select("shelter_id"), daily, "shelter_id", "day", "evacuee_count", dates)
    report = quality.check_rows(new, {"all_matched": F.col("match_status") != "matched"}, "shelter_name").unionByName(quality.unique(new.where("shelter_id is not null"), ["municipality", "observed_at", "revision", "shelter_id"], "one_record_a_shelter"))
    return Flow({"log": everything, "new": new, "latest": revisions.latest_observation(everything, "municipality", "observed_at"), "evacuee_count_by_date": wide, "issues": new.where("match_status <> 'matched'")}, report)
