"""Explainable record linkage: exact, spatial and high-confidence fuzzy tiers that end in one decision a record.

Every tier is a join on keys; similarity is computed only for candidates of one block (municipality). A
cascade takes tiers in order, each on what the tiers before left undecided; an ambiguous outcome decides too.
Master tables are dimensions: Spark broadcasts a side under its size limit and sorts or hashes beyond it.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from snapweave.functions.scalars import parse_coordinate
from snapweave.functions.text import address_key, address_key_municipal, best_similarity, clean_text, infer_municipality, municipality_key, name_key_capacity, name_key_municipal, name_key_reference, name_variants, similarity
from snapweave.operators.lineage import cut_lineage
from snapweave.operators.spatial import Acceptance, Weights, accept_nearest, first_targets, radius_join

DECISION = ["status", "method", "score", "matches", "candidates"]
_NONE = "array<string>"
Tier = Callable[[DataFrame], DataFrame]


def decision(status: Column | str, method: Column | str, score: Column | float, matches: Column | None = None, candidates: Column | None = None) -> list[Column]:
    lit = lambda x: x if isinstance(x, Column) else F.lit(x)
    none = F.array().cast(_NONE)
    return [lit(status).alias("status"), lit(method).alias("method"), lit(score).cast("double").alias("score"), (matches if matches is not None else none).alias("matches"), (candidates if candidates is not None else none).alias("candidates")]


def cascade(source: DataFrame, key: str, tiers: Sequence[Tier], otherwise: tuple[str, str] = ("unmatched", "no_candidate")) -> DataFrame:
    """key and decision of every source row. A tier returns key and decision of the rows it decides.

    What a tier leaves is read by all later ones, so each remainder is a table of its own: plans stay small and
    no tier runs twice.
    """
    rest, decided = cut_lineage(source), []
    for tier in tiers:
        found = cut_lineage(tier(rest).select(key, *DECISION))
        decided.append(found)
        rest = cut_lineage(rest.join(found.select(key), key, "left_anti"))
    out = rest.select(key, *decision(*otherwise, 0.0))
    for d in decided:
        out = out.unionByName(d)
    return out


def each(rest: DataFrame, key: str, columns: Sequence[str], decide: Callable[[DataFrame, str], DataFrame]) -> DataFrame:
    """key and decision of the rows whose distinct `columns` are decided by decide(texts, name of their key)."""
    text, name = F.struct(*columns), "_text" if key != "_text" else "_part"
    texts = rest.select(*columns).distinct().withColumn(name, text)
    return rest.select(key, text.alias(name)).join(decide(texts, name).select(name, *DECISION), name).drop(name)


def each_numbered(rest: DataFrame, key: str, columns: Sequence[str], decide: Callable[[DataFrame, str], DataFrame]) -> DataFrame:
    """`each` with a number as the texts' key, which sorts faster than the texts; no column may be null."""
    name = "_number" if key != "_number" else "_part"
    texts = cut_lineage(rest.select(*columns).distinct().withColumn(name, F.monotonically_increasing_id()))
    decided = texts.join(decide(texts, name).select(name, *DECISION), name).drop(name)
    return rest.select(key, *columns).join(decided, list(columns)).select(key, *DECISION)


def dealt(pairs: DataFrame, column: str) -> DataFrame:
    """Distinct pairs over all cores: few bytes, but costly to compare, so Spark's own partitions would be too few."""
    spark = pairs.sparkSession
    return pairs.distinct().repartition(max(int(spark.conf.get("spark.sql.shuffle.partitions")), 2 * spark.sparkContext.defaultParallelism), column).sortWithinPartitions(column)


def unique_or_ambiguous(source: DataFrame, master: DataFrame, keys: Sequence[str], master_id: str) -> DataFrame:
    """Exact match on keys: the id if one master row has them, `ambiguous` if several, else unmatched."""
    groups = master.groupBy(*keys).agg(F.count("*").alias("_n"), F.min(master_id).alias("_id"))
    joined = source.join(groups, list(keys), "left")
    return joined.select(*source.columns, F.when(F.col("_n") == 1, "matched").when(F.col("_n") > 1, "ambiguous").otherwise("unmatched").alias("status"), F.when(F.col("_n") == 1, F.col("_id")).alias("matched_id"), F.coalesce("_n", F.lit(0)).alias("n_candidates"))


@dataclass(frozen=True)
class Fuzzy:
    """Weights and limits of a fuzzy tier."""

    name_weight: float
    least_name_candidate: float
    accept_name: float
    accept_total: float
    margin: float
    accept_address: float
    name_alone: float
    keep: int = 3


REFERENCE_FUZZY = Fuzzy(0.82, 0.80, 0.94, 0.92, 0.035, 0.65, 0.985)
CAPACITY_FUZZY = Fuzzy(0.82, 0.80, 0.96, 0.93, 0.04, 0.68, 0.99)


def fuzzy_tier(pairs: DataFrame, key: str, master_id: str, rules: Fuzzy) -> DataFrame:
    """Decisions from pairs (key, master_id, s_name, s_addr, m_name, m_addr) of one block.

    Names are compared first; only pairs over the candidate limit go on to their addresses. Spark would run
    both UDFs on all pairs if they stood in one projection, so the second is guarded by passing it nulls.
    """
    named = (pairs if "name_score" in pairs.columns else pairs.withColumn("name_score", similarity("s_name", "m_name"))).where(F.col("name_score") >= rules.least_name_candidate)
    scored = named if "address_score" in pairs.columns else named.withColumn("address_score", F.when((F.col("s_addr") != "") & (F.col("m_addr") != ""), similarity(F.when((F.col("s_addr") != "") & (F.col("m_addr") != ""), F.col("s_addr")), "m_addr")))
    total = F.when(F.col("s_addr") == "", F.col("name_score")).otherwise(rules.name_weight * F.col("name_score") + (1 - rules.name_weight) * F.coalesce("address_score", F.lit(0.0)))
    w = Window.partitionBy(key).orderBy(F.col("total").desc(), F.col(master_id))
    ranked = scored.withColumn("total", total).withColumn("_n", F.row_number().over(w)).where(F.col("_n") <= max(rules.keep, 2))
    suggestions = F.transform(F.array_sort(F.collect_list(F.when(F.col("_n") <= rules.keep, F.struct("_n", F.col(master_id).cast("string").alias("id"))))), lambda x: x["id"])
    best = lambda c: F.max(F.when(F.col("_n") == 1, F.col(c)))
    grouped = ranked.groupBy(key).agg(suggestions.alias("candidates"), F.coalesce(F.max(F.when(F.col("_n") == 2, F.col("total"))), F.lit(0.0)).alias("_second"), *(best(c).alias(c) for c in ("total", "name_score", "address_score", "s_addr")))
    address_ok = (F.col("s_addr") == "") | (F.col("address_score") >= rules.accept_address) | (F.col("name_score") >= rules.name_alone)
    ok = (F.col("name_score") >= rules.accept_name) & (F.col("total") >= rules.accept_total) & (F.col("total") - F.col("_second") >= rules.margin) & address_ok
    return grouped.select(key, *decision(F.when(ok, "matched").otherwise("unmatched"), F.when(ok, "high_confidence_fuzzy").otherwise("fuzzy_below_threshold"), F.col("total"), F.when(ok, F.slice("candidates", 1, 1)).otherwise(F.array().cast(_NONE)), F.col("candidates")))


def _tokens(c: Column) -> Column:
    """A name's characters, each numbered among its equals, from the highest code point down: a multiset as a set."""
    chars = F.sort_array(F.filter(F.split(c, ""), lambda v: v != ""), asc=False)
    return F.transform(chars, lambda v, k: F.concat(v, (k + 1 - F.array_position(chars, v)).cast("string")))


def name_scores(source: DataFrame, master: DataFrame, on: Sequence[str] = (), least: float = 0.80) -> DataFrame:
    """Of `on` blocks all pairs of different names s_name and m_name that have a ratio of `least` at least, with name_score.

    A ratio 2 M / T of `least` bounds the lengths, and M is at most what the names share as multisets of characters. So
    two such names share one of the first tokens of each, in any fixed order: an equi-join instead of a cross join. Of the
    pairs it makes, those that share enough characters in all are compared, each once, however many rows have them.
    """
    other = least / (2 - least)  # the shorter name's length, as a part of the longer one's, is at least this

    def begun(df: DataFrame, c: str) -> DataFrame:
        n = F.length(c)
        # of n characters this many are shared at least, with the shortest partner
        shared = F.ceil(n * other - 1e-9).cast("int")
        return df.select(*on, c).distinct().withColumn("_token", F.explode(F.slice(_tokens(F.col(c)), F.lit(1), F.greatest(n - shared + 1, F.lit(0)))))

    lengths = (F.length("m_name") >= F.length("s_name") * other - 1e-9) & (F.length("s_name") >= F.length("m_name") * other - 1e-9)
    near = begun(source, "s_name").join(begun(master, "m_name"), [*on, "_token"]).where(lengths).select(*on, "s_name", "m_name").distinct()
    left, right = (df.select(c).distinct().withColumn(tokens, _tokens(F.col(c))) for df, c, tokens in ((source, "s_name", "_s"), (master, "m_name", "_m")))
    near = near.join(left, "s_name").join(right, "m_name").where(2 * F.size(F.array_intersect("_s", "_m")) >= least * (F.length("s_name") + F.length("m_name")) - 1e-9)
    near = cut_lineage(near.select(*on, "s_name", "m_name"))
    scores = dealt(near.select("s_name", "m_name"), "m_name").withColumn("name_score", similarity("s_name", "m_name")).where(F.col("name_score") >= least)
    return near.join(scores, ["s_name", "m_name"])


def name_pairs(source: DataFrame, master: DataFrame, key: str, master_id: str, on: Sequence[str] = (), least: float = 0.80) -> DataFrame:
    """All pairs of rows of `on` blocks whose names have a ratio of `least` at least."""
    return source.join(name_scores(source, master, on, least), [*on, "s_name"]).join(master, [*on, "m_name"])


def best_names(names: DataFrame, master: DataFrame, on: Sequence[str], n: int) -> DataFrame:
    """Of each name and address (and block) the n first master rows by name_score, then m_id.

    Most addresses are full after the names of the highest score; rows of lower scores are dropped there before they are sorted.
    """
    place = [c for c in master.columns if c not in ("m_name", "m_id")]
    by_score = F.col("name_score").desc(), F.col("m_id")
    names = cut_lineage(name_scores(names, master, on))
    names = cut_lineage(names.withColumn("_level", F.dense_rank().over(Window.partitionBy(*on, "s_name").orderBy(F.col("name_score").desc()))))
    names = names.repartition(max(int(names.sparkSession.conf.get("spark.sql.shuffle.partitions")), 2 * names.sparkSession.sparkContext.defaultParallelism))
    master = cut_lineage(master)
    top = cut_lineage(first_targets(names.where("_level = 1").join(master, [*on, "m_name"]), ["s_name", *place], *by_score, n=n))
    full = cut_lineage(top.groupBy("s_name", *place).count().where(F.col("count") >= n).drop("count"))
    rest = names.where("_level > 1").join(master, [*on, "m_name"]).join(full, ["s_name", *place], "left_anti")
    return first_targets(top.unionByName(rest), ["s_name", *place], *by_score, n=n).drop("_level")


def fuzzy_texts(texts: DataFrame, master: DataFrame, key: str, rules: Fuzzy, block: Sequence[str] = (), on: Sequence[str] = (), inside: Column | None = None) -> DataFrame:
    """`fuzzy_tier` of distinct texts (key, *block, s_name, s_addr) against the master rows (*on, m_name, m_addr, m_id) of their block.

    A block is that of the columns `on`, or what `inside` says of a master row's other columns. With one address on either side
    the total grows with the name's score alone, so of each name's candidates at one address only the first `keep` can be among the first `keep` of all.
    """
    n = max(rules.keep, 2)
    few = first_targets(master, [c for c in master.columns if c != "m_id"], "m_id", n=n)
    best = cut_lineage(best_names(texts.select(*on, "s_name").distinct(), few, on, n))
    if inside is not None:
        best = texts.select(*block, "s_name").distinct().join(best, "s_name").where(inside)
        best = first_targets(best, [*block, "s_name", "m_addr"], F.col("name_score").desc(), "m_id", n=n)
    pairs = cut_lineage(texts.join(best.select(*block, "s_name", "m_name", "m_addr", "m_id", "name_score"), [*block, "s_name"]))
    both = (F.col("s_addr") != "") & (F.col("m_addr") != "")
    addresses = dealt(pairs.where(both).select("s_addr", "m_addr"), "m_addr").withColumn("address_score", similarity("s_addr", "m_addr"))
    return fuzzy_tier(pairs.join(cut_lineage(addresses), ["s_addr", "m_addr"], "left"), key, "m_id", rules)


def _keyed(df: DataFrame, municipality: str, name: str, address: str, prefix: str, name_key=name_key_reference, addr_key=address_key, infer: bool = False) -> DataFrame:
    """df with the keys of its texts, which are made once for each distinct text; with `infer` a blank municipality comes from the address."""
    raw = {f"_{prefix}{part}": F.coalesce(F.col(c).cast("string"), F.lit("")) for part, c in (("muni", municipality), ("name", name), ("addr", address))}
    town, title, place = (F.col(c) for c in raw)
    town = F.when(F.trim(town) != "", town).otherwise(infer_municipality(clean_text(place))) if infer else town
    rows = df.withColumns(raw)
    keys = rows.select(*raw).distinct().withColumns({f"{prefix}muni": municipality_key(town), f"{prefix}name": name_key(title), f"{prefix}addr": addr_key(place)})
    return rows.join(cut_lineage(keys), list(raw)).drop(*raw)


def municipality_block(source: DataFrame, master: DataFrame) -> DataFrame:
    """s_muni of the municipalities that some master row holds in its address or municipality; blank is in all.

    Containment is an equi-join: a municipality holds a piece of its own length in the address. The lengths of the
    municipalities are few; the pieces of all of them are cut from each distinct address.
    """
    names = source.select("s_muni").distinct()
    lengths = names.where("s_muni <> ''").groupBy().agg(F.sort_array(F.collect_set(F.length("s_muni"))).alias("_lengths"))  # one row
    places = master.select(F.explode(F.array("m_muni", "m_addr")).alias("_place")).distinct().where("_place <> ''").crossJoin(F.broadcast(lengths))
    pieces = F.flatten(F.transform("_lengths", lambda n: F.transform(F.when(F.length("_place") >= n, F.sequence(F.lit(1), F.length("_place") - n + 1)).otherwise(F.array().cast("array<int>")), lambda at: F.substring(F.col("_place"), at, n))))
    held = places.select(F.explode(pieces).alias("s_muni")).distinct()
    return names.join(held, "s_muni", "left_semi").unionByName(names.where("s_muni = ''"))


def match_reference(source: DataFrame, master: DataFrame, key: str = "row_id", master_id: str = "common_id", municipality: str = "municipality", name: str = "shelter_name", address: str = "address") -> DataFrame:
    """Tiered match to the reference master: exact name and address, exact name in the municipality, same address, fuzzy.

    Master columns: master_id, name, address (and optionally municipality). A group of several master rows
    matches only if they share name and address.
    """
    if municipality not in master.columns:
        master = master.withColumn(municipality, F.lit(""))
    s = _keyed(source, municipality, name, address, "s_").select(key, "s_muni", "s_name", "s_addr")
    m = cut_lineage(_keyed(master, municipality, name, address, "m_").select(F.col(master_id).cast("string").alias("m_id"), "m_muni", "m_name", "m_addr"))
    row_key, key = key, "_number"  # the tiers decide distinct texts
    ids = F.array_sort(F.collect_list("m_id"))
    by_both = m.groupBy(F.col("m_name").alias("s_name"), F.col("m_addr").alias("s_addr")).agg(ids.alias("ids"))
    whole = m.groupBy(F.col("m_name").alias("s_name")).agg(F.count("*").alias("n"), F.size(F.collect_set("m_addr")).alias("addrs"), ids.alias("ids"))
    places = m.groupBy(F.col("m_name").alias("s_name"), "m_muni", "m_addr").agg(F.count("*").alias("_rows"), F.collect_list("m_id").alias("_ids"))
    in_block = (F.col("s_muni") == "") | F.contains("m_addr", "s_muni") | F.contains("m_muni", "s_muni")

    def missing(rest: DataFrame) -> DataFrame:
        return rest.where("s_name = ''").select(key, *decision("unmatched", "missing_name", 0.0))

    def exact(rest: DataFrame) -> DataFrame:
        hit = rest.where("s_addr <> ''").join(by_both, ["s_name", "s_addr"])
        return hit.select(key, *decision(F.when(F.size("ids") == 1, "matched").otherwise("matched_multiple"), "exact_name_address", 1.0, F.col("ids")))

    def namesakes(rest: DataFrame, key: str) -> DataFrame:
        rows = rest.join(places, "s_name").withColumn("_in", in_block)
        g = rows.groupBy(key, "s_name").agg(F.coalesce(F.sum(F.when(F.col("_in"), F.col("_rows"))), F.lit(0)).alias("n_in"), F.size(F.collect_set(F.when(F.col("_in"), F.col("m_addr")))).alias("addr_in"), F.array_sort(F.flatten(F.collect_list(F.when(F.col("_in"), F.col("_ids"))))).alias("ids_in"))
        g = g.join(whole, "s_name")
        one_here, group_here = F.col("n_in") == 1, (F.col("n_in") > 1) & (F.col("addr_in") == 1)
        conflict, group = F.col("n") == 1, F.col("addrs") == 1
        status = F.when(one_here, "matched").when(group_here, "matched_multiple").when(conflict, "unmatched").when(group, "matched_multiple").otherwise("ambiguous")
        method = F.when(one_here, "exact_name_municipality").when(group_here, "exact_name_municipality_same_address").when(conflict, "exact_name_municipality_conflict").when(group, "exact_name_same_address").otherwise("exact_name_multiple_addresses")
        score = F.when(one_here | group_here, 0.99).when(~conflict & group, 0.97).otherwise(0.0)
        matches = F.when(one_here | group_here, F.col("ids_in")).when(~conflict & group, F.col("ids")).otherwise(F.array().cast(_NONE))
        return g.select(key, *decision(status, method, score, matches, F.when(status == "unmatched", F.col("ids")).when(status == "ambiguous", F.when(F.size("ids_in") > 0, F.col("ids_in")).otherwise(F.col("ids"))).otherwise(F.array().cast(_NONE))))

    def same(rest: DataFrame) -> DataFrame:
        return each_numbered(rest, key, ["s_muni", "s_name"], namesakes)

    def fuzzy(rest: DataFrame) -> DataFrame:
        # a municipality that no master address holds takes the whole master, as a blank one does; any other its own rows
        known = municipality_block(rest, m).select("s_muni").distinct().withColumn("_block", F.col("s_muni"))
        rest = cut_lineage(rest.join(known, "s_muni", "left").withColumn("_block", F.coalesce("_block", F.lit(""))))
        here = (F.col("_block") == "") | F.contains("m_addr", "_block") | F.contains("m_muni", "_block")
        return each_numbered(rest, key, ["_block", "s_name", "s_addr"], lambda texts, text: fuzzy_texts(texts, m, text, REFERENCE_FUZZY, ["_block"], inside=here))

    return each_numbered(cut_lineage(s), row_key, ["s_muni", "s_name", "s_addr"], lambda texts, _: cascade(texts, key, [missing, exact, same, fuzzy]))


def enrich_reference(decisions: DataFrame, master: DataFrame, key: str = "row_id", master_id: str = "common_id", attributes: Sequence[str] = ()) -> DataFrame:
    """One row for each source row with its matches' ids and attributes; the smallest id is the primary one."""
    rows = decisions.select(key, F.explode("matches").alias("_id")).join(master.withColumn("_id", F.col(master_id).cast("string")), "_id")
    columns = [c for c in attributes if c in master.columns]
    agg = rows.groupBy(key).agg(F.array_sort(F.collect_set("_id")).alias("reference_common_ids"), F.min("_id").alias("reference_common_id"), *(F.min_by(c, "_id").alias(f"reference_{c}") for c in columns), F.array_sort(F.collect_list(F.struct("_id", *columns))).alias("reference_rows"))
    return decisions.join(agg, key, "left").withColumn("reference_match_count", F.size("matches"))


def _first_filled(df: DataFrame, columns: Sequence[str]) -> Column:
    """The first non-blank of those columns that df has."""
    return F.coalesce(*(F.nullif(F.trim(F.col(c).cast("string")), F.lit("")) for c in columns if c in df.columns), F.lit(None).cast("string"))


def match_capacity(source: DataFrame, master: DataFrame, key: str = "row_id", master_id: str = "portal_shelter_id", municipality: str = "municipality", name: str = "shelter_name", address: str = "address", lat: Sequence[str] = ("reference_latitude", "portal_latitude", "latitude"), lon: Sequence[str] = ("reference_longitude", "portal_longitude", "longitude"), m_lat: str = "portal_latitude", m_lon: str = "portal_longitude") -> DataFrame:
    """Tiered match to the capacity master: known id, exact triple, name in municipality, nearest, fuzzy.

    A blank municipality is inferred from the address. A record's pool is its municipality, or the whole master if it has
    none or the master doesn't know it. Without a master all rows are `master_unavailable`.
    """
    s = _keyed(source, municipality, name, address, "s_", name_key_capacity, infer=True)
    s_id = F.trim(F.coalesce(F.col(master_id).cast("string"), F.lit(""))) if master_id in source.columns else F.lit("")
    s = s.select(key, "s_muni", "s_name", "s_addr", s_id.alias("s_id"), parse_coordinate(_first_filled(s, lat), -90, 90).alias("s_lat"), parse_coordinate(_first_filled(s, lon), -180, 180).alias("s_lon"))
    m = _keyed(master.where(F.trim(F.coalesce(F.col(name), F.lit(""))) != ""), municipality, name, address, "m_", name_key_capacity)
    m = cut_lineage(m.select(F.coalesce(F.col(master_id).cast("string"), F.lit("")).alias("m_id"), "m_muni", "m_name", "m_addr", parse_coordinate(F.col(m_lat).cast("string"), -90, 90).alias("m_lat"), parse_coordinate(F.col(m_lon).cast("string"), -180, 180).alias("m_lon")))
    # the pool of each municipality: its own rows, or all where the master has none
    known = m.select(F.col("m_muni").alias("s_muni"), F.lit(True).alias("_known")).where("s_muni <> ''").distinct()
    s = s.join(known, "s_muni", "left").withColumn("_known", F.coalesce("_known", F.lit(False)))
    here = (F.col("s_muni") == "") | (F.col("s_muni") == F.col("m_muni"))

    placed = first_targets(m.where("m_lat is not null and m_lon is not null"), ["m_muni", "m_name", "m_addr", "m_lat", "m_lon"], "m_id")

    def nearest(pairs: DataFrame, key: str) -> DataFrame:
        pairs = cut_lineage(pairs.select(key, "s_name", "s_addr", "m_id", "m_name", "m_addr", "distance_m"))
        names = dealt(pairs.select("s_name", "m_name"), "m_name").withColumn("name_score", similarity("s_name", "m_name"))
        both = (F.col("s_addr") != "") & (F.col("m_addr") != "")
        addresses = dealt(pairs.where(both).select("s_addr", "m_addr"), "m_addr").withColumn("address_score", similarity("s_addr", "m_addr"))
        # a hash before the texts, for the sort: texts are compared only where it is equal
        hashed = lambda df, s, m: df.withColumn("_hash", F.xxhash64(s, m))
        scored = hashed(pairs, "s_name", "m_name").join(hashed(names, "s_name", "m_name"), ["_hash", "s_name", "m_name"]).select(key, "s_addr", "m_addr", "m_id", "distance_m", "name_score")
        scored = hashed(scored, "s_addr", "m_addr").join(hashed(addresses, "s_addr", "m_addr"), ["_hash", "s_addr", "m_addr"], "left").select(key, "m_id", "distance_m", "name_score", F.coalesce("address_score", F.lit(0.0)).alias("address_score"))
        hit = accept_nearest(scored, key, tie="m_id").where("status is not null")
        return hit.select(key, *decision(F.col("status"), F.col("method"), F.col("score"), F.when(F.col("status") == "matched", F.array("m_id")).otherwise(F.array().cast(_NONE)), F.array("m_id")))

    def by_place(rest: DataFrame, equal: Sequence[str], allowed: Column = F.lit(True)) -> DataFrame:
        """Decisions by the nearest of the master rows that agree in the columns m_ for s_ of `equal`."""
        targets = placed.withColumns({c: F.col("m_" + c[2:]) for c in equal})
        near = lambda texts: radius_join(texts, targets, Weights().radius_m, "s_lat", "s_lon", "m_lat", "m_lon", on=list(equal)).where(allowed)
        return each_numbered(rest.where("s_lat is not null and s_lon is not null"), key, ["s_muni", "s_name", "s_addr", "s_lat", "s_lon", "_known"], lambda texts, text: nearest(near(texts), text))

    def unavailable(rest: DataFrame) -> DataFrame:
        return rest.crossJoin(F.broadcast(m.agg(F.count("*").alias("_rows")))).where("_rows = 0").select(key, *decision("master_unavailable", "capacity_master_not_found", 0.0))

    def by_id(rest: DataFrame) -> DataFrame:
        return rest.join(m.select(F.col("m_id").alias("s_id")).where("s_id <> ''").distinct(), "s_id").select(key, *decision("matched", "portal_shelter_id", 1.0, F.array("s_id")))

    triple = m.groupBy(F.col("m_muni").alias("s_muni"), F.col("m_name").alias("s_name"), F.col("m_addr").alias("s_addr")).agg(F.array_sort(F.collect_list("m_id")).alias("ids"))

    def exact(rest: DataFrame) -> DataFrame:
        hit = rest.join(triple, ["s_muni", "s_name", "s_addr"])
        return hit.where(F.size("ids") == 1).select(key, *decision("matched", "exact_municipality_name_address", 1.0, F.col("ids")))

    def several(rest: DataFrame, counted: DataFrame, equal: Sequence[str], allowed: Column, method: str) -> DataFrame:
        """Rows with several candidates `ids`: the nearest of them, or none."""
        hit = cut_lineage(counted.where(F.size("ids") > 1))
        found = cut_lineage(by_place(hit.select(rest.columns), equal, allowed))
        return found.unionByName(hit.join(found.select(key), key, "left_anti").select(key, *decision("ambiguous", method, 0.0, None, F.col("ids"))))

    def same_key(rest: DataFrame) -> DataFrame:
        return several(rest, rest.join(triple, ["s_muni", "s_name", "s_addr"]), ["s_muni", "s_name", "s_addr"], F.lit(True), "duplicate_exact_key")

    named = lambda *columns: m.withColumns({c: F.col("m_" + c[2:]) for c in columns}).groupBy(*columns).agg(F.array_sort(F.collect_list("m_id")).alias("ids"), F.min("m_addr").alias("m_addr"))

    def namesakes(rest: DataFrame) -> DataFrame:
        here, anywhere = rest.where("s_muni <> ''").join(named("s_muni", "s_name"), ["s_muni", "s_name"]), rest.where("s_muni = ''").join(named("s_name"), "s_name")
        return here.unionByName(anywhere)

    def one_name(rest: DataFrame) -> DataFrame:
        hit = namesakes(rest).where(F.size("ids") == 1).withColumn("_blank", (F.col("s_addr") == "") | (F.col("m_addr") == ""))
        hit = hit.withColumn("_score", F.when(F.col("_blank"), 0.97).otherwise(similarity("s_addr", "m_addr"))).where(F.col("_blank") | (F.col("_score") >= 0.72))
        return hit.select(key, *decision("matched", F.when(F.col("_blank"), "exact_name_municipality").otherwise("exact_name_municipality_address_similar"), F.col("_score"), F.col("ids")))

    def same_name(rest: DataFrame) -> DataFrame:
        return several(rest, namesakes(rest), ["s_name"], here, "exact_name_multiple_capacity_rows")

    def in_pool(rest: DataFrame) -> DataFrame:
        return by_place(rest.where("_known"), ["s_muni"]).unionByName(by_place(rest.where("not _known"), []))

    def fuzzy(rest: DataFrame) -> DataFrame:
        inside = each_numbered(rest.where("_known"), key, ["s_muni", "s_name", "s_addr"], lambda texts, text: fuzzy_texts(texts, m.withColumnRenamed("m_muni", "s_muni").select("s_muni", "m_name", "m_addr", "m_id"), text, CAPACITY_FUZZY, ["s_muni"], ["s_muni"]))
        outside = each_numbered(rest.where("not _known"), key, ["s_name", "s_addr"], lambda texts, text: fuzzy_texts(texts, m.select("m_name", "m_addr", "m_id"), text, CAPACITY_FUZZY))
        return inside.unionByName(outside)

    tiers = [unavailable, by_id, exact, same_key, one_name, same_name, in_pool, fuzzy]
    return cascade(s, key, tiers)


def enrich_capacity(source: DataFrame, decisions: DataFrame, master: DataFrame, key: str = "row_id", master_id: str = "portal_shelter_id", columns: Sequence[str] = ("portal_capacity_persons", "portal_capacity_raw", "capacity_source", "capacity_acquired_at_jst", "portal_latitude", "portal_longitude")) -> DataFrame:
    """Source rows with the matched master row's columns and the decision; computed from rows not enriched before."""
    own = source.drop(master_id, *columns)
    ids = decisions.select(key, F.col("status").alias("capacity_match_status"), F.col("method").alias("capacity_match_method"), F.col("score").alias("capacity_match_score"), F.element_at(F.when(F.size("matches") > 0, F.col("matches")), 1).alias(master_id))
    return own.join(ids, key, "left").join(master.select(F.col(master_id).cast("string").alias(master_id), *columns), master_id, "left")


def match_manual(source: DataFrame, manual: DataFrame, key: str = "row_id", shelter_id: str = "shelter_id", web_id: str = "web_shelter_id", municipality: str = "municipality", name: str = "shelter_name", address: str = "address") -> DataFrame:
    """Manual coordinates by id, web id, prefixed web id, then by a unique identity; duplicates are ambiguous."""
    ids = manual.select(F.col(shelter_id).alias("_id"))
    keyed = _keyed(source, municipality, name, address, "s_", name_key_capacity).select(key, "s_muni", "s_name", "s_addr", F.coalesce(F.col(shelter_id), F.lit("")).alias("_a"), F.coalesce(F.col(web_id), F.lit("")).alias("_b"))

    def by(c: Column, method: str) -> Tier:
        return lambda rest: rest.withColumn("_id", c).where("_id <> ''").join(ids, "_id").select(key, *decision("matched", method, 1.0, F.array("_id")))

    triple = _keyed(manual, municipality, name, address, "s_", name_key_capacity).groupBy("s_muni", "s_name", "s_addr").agg(F.array_sort(F.collect_list(shelter_id)).alias("ids"))

    def identity(rest: DataFrame) -> DataFrame:
        hit = rest.join(triple, ["s_muni", "s_name", "s_addr"])
        one = F.size("ids") == 1
        return hit.select(key, *decision(F.when(one, "matched").otherwise("ambiguous"), F.when(one, "manual_exact_identity").otherwise("manual_duplicate_identity"), F.when(one, 1.0).otherwise(0.0), F.when(one, F.col("ids")).otherwise(F.array().cast(_NONE)), F.col("ids")))

    web = F.when(F.col("_b") != "", F.when(F.startswith("_b", F.lit("web:")), F.col("_b")).otherwise(F.concat(F.lit("web:"), "_b")))
    tiers = [by(F.col("_a"), "manual_shelter_id"), by(F.col("_b"), "manual_web_shelter_id"), by(web, "manual_web_shelter_id"), identity]
    return cascade(keyed, key, tiers, ("unmatched", "manual_no_match"))


def choose_coordinates(pairs: Sequence[tuple[str, Column]]) -> list[Column]:
    """latitude, longitude, coordinate_source and coordinate_status from (source, struct(latitude, longitude)) in order; a pair is taken whole."""
    best = F.coalesce(*(p for _, p in pairs))
    source = F.coalesce(*(F.when(p.isNotNull(), F.lit(s)) for s, p in pairs))
    return [best["latitude"].alias("latitude"), best["longitude"].alias("longitude"), source.alias("coordinate_source"), F.when(best.isNotNull(), "complete").otherwise("missing").alias("coordinate_status")]


@dataclass(frozen=True)
class Municipal:
    name_weight: float = 0.64
    address_weight: float = 0.32
    open_bonus: float = 0.04
    open_margin: float = 0.025
    same_address: float = 0.72
    same_address_margin: float = 0.04
    same_name: float = 0.70
    fuzzy: float = 0.86
    fuzzy_margin: float = 0.055
    ambiguous: float = 0.74
    min_address_key: int = 5


def match_municipal(source: DataFrame, master: DataFrame, aliases: DataFrame, key: str = "row_id", rules: Municipal = Municipal()) -> DataFrame:
    """Municipal records to shelters.

    source: key, municipality, shelter_name, address. master: shelter_id, municipality, shelter_name, address,
    is_open (that day), capacity. aliases: municipality, source_shelter_name, source_address, shelter_id, _ord.
    Tiers: alias; exact name and address (open first); same address; unique exact name; fuzzy. A record without an
    address that these leave unmatched takes a unique name, the unique web row with capacity and address, the unique open
    row or the unique open web row of its name; several of a name are ambiguous; else the first tiers' answer stands.
    """
    s = cut_lineage(_keyed(source, "municipality", "shelter_name", "address", "s_", name_key_municipal, address_key_municipal).select(key, "s_muni", "s_name", "s_addr"))
    m = _keyed(master, "municipality", "shelter_name", "address", "m_", name_key_municipal, address_key_municipal).select(F.col("shelter_id").alias("m_id"), F.col("m_muni").alias("s_muni"), "m_name", "m_addr", F.coalesce(F.col("is_open"), F.lit(False)).alias("m_open"), F.coalesce(F.replace(F.trim(F.col("capacity").cast("string")), F.lit(","), F.lit("")).try_cast("double"), F.lit(0.0)).alias("m_cap"))
    m = cut_lineage(m)
    a = aliases.select(municipality_key(F.col("municipality")).alias("s_muni"), name_key_municipal(F.col("source_shelter_name")).alias("s_name"), address_key_municipal(F.col("source_address")).alias("s_addr"), "shelter_id", "_ord")
    a = a.where("s_muni <> '' and s_name <> '' and trim(shelter_id) <> ''")
    exact_alias = a.groupBy("s_muni", "s_name", "s_addr").agg(F.max_by("shelter_id", "_ord").alias("m_id"))
    any_alias = a.groupBy("s_muni", "s_name").agg(F.max_by("shelter_id", "_ord").alias("m_id"))
    ids = m.select("m_id", F.lit(True).alias("_there"))

    rows, row_key, key = s, key, "_text"  # the tiers decide distinct texts
    s = rows.select("s_muni", "s_name", "s_addr").distinct().withColumn(key, F.struct("s_muni", "s_name", "s_addr"))
    found_alias = exact_alias.select("s_muni", "s_name", "s_addr", F.col("m_id").alias("_exact")).where("s_addr <> ''")
    s = s.join(found_alias, ["s_muni", "s_name", "s_addr"], "left").join(any_alias.withColumnRenamed("m_id", "_any"), ["s_muni", "s_name"], "left").withColumn("_alias", F.coalesce("_exact", "_any")).drop("_exact", "_any")
    s = cut_lineage(s)
    dangling = F.col("_alias").isNotNull()

    def by_alias(rest: DataFrame) -> DataFrame:
        return rest.where(dangling).join(ids.withColumnRenamed("m_id", "_alias"), "_alias").select(key, *decision("matched", "manual_alias", 1.0, F.array("_alias"), F.array("_alias")))

    def lost(rest: DataFrame) -> DataFrame:
        """Answers of the first tiers to records that they can't compare."""
        nowhere = rest.where(~dangling).join(m.select("s_muni").distinct(), "s_muni", "left_anti")
        return rest.where(dangling).select(key, *decision("unmatched", "alias_target_missing", 0.0)).unionByName(nowhere.select(key, *decision("unmatched", "municipality_not_found", 0.0)))

    def total(name: Column, addr: Column) -> Column:
        return F.least(F.lit(1.0), rules.name_weight * name + rules.address_weight * addr + F.when(F.col("m_open"), rules.open_bonus).otherwise(0.0))

    def best_of_class(texts: DataFrame) -> DataFrame:
        """Of each name of a municipality the two best master rows of one address, state and sameness of name, and how many there are.

        Within a class the total of any text grows with the name's score alone, so its two best are among these. `n` stands on the first row.
        """
        place = ["s_muni", "m_addr", "m_open"]
        named = cut_lineage(texts.select("s_muni", "s_name").distinct().join(m.select("s_muni", "m_name").distinct(), "s_muni"))
        vars_of = lambda c: name_variants(F.col(c))
        scores = dealt(named.select("s_name", "m_name"), "m_name").select("s_name", "m_name", best_similarity(vars_of("s_name"), vars_of("m_name")).alias("_name"), F.arrays_overlap(vars_of("s_name"), vars_of("m_name")).alias("_same_name"))
        named = cut_lineage(named.join(scores, ["s_name", "m_name"]))
        sizes = m.groupBy(*place, "m_name").agg(F.count("*").alias("_rows"))
        n = named.where("_same_name").join(sizes, ["s_muni", "m_name"]).groupBy(*place, "s_name", "_same_name").agg(F.sum("_rows").alias("n"))
        cls = [*place, "s_name", "_same_name"]
        ranked = named.join(first_targets(m.select("s_muni", "m_name", "m_addr", "m_open", "m_id"), [*place, "m_name"], "m_id"), ["s_muni", "m_name"])
        ranked = ranked.withColumn("_r", F.row_number().over(Window.partitionBy(*cls).orderBy(F.col("_name").desc(), "m_id"))).where("_r <= 2")
        return cut_lineage(ranked.join(n, cls, "left").select(*cls, "_name", "m_id", F.when(F.col("_r") == 1, F.col("n")).otherwise(0).alias("n")))

    def scores_tier(texts: DataFrame) -> DataFrame:
        pairs = texts.join(best_of_class(texts), ["s_muni", "s_name"])
        addresses = texts.select("s_muni", "s_addr").where("s_addr <> ''").distinct().join(m.select("s_muni", "m_addr").distinct(), "s_muni")
        addresses = dealt(addresses.select("s_addr", "m_addr"), "m_addr").withColumn("_addr", similarity("s_addr", "m_addr"))
        rows = pairs.join(addresses, ["s_addr", "m_addr"], "left").withColumns({"_addr": F.coalesce("_addr", F.lit(0.0)), "_same_addr": (F.col("s_addr") != "") & (F.col("s_addr") == F.col("m_addr"))})
        rows = rows.withColumn("total", total(F.col("_name"), F.col("_addr")))
        both = F.col("_same_name") & F.col("_same_addr")
        order = [F.col("total").desc(), F.col("m_id")]
        rows = rows.withColumn("_both", both)
        ranks = {"": Window.partitionBy(key), "a": Window.partitionBy(key, "_same_addr"), "b": Window.partitionBy(key, "_both"), "n": Window.partitionBy(key, "_same_name")}
        rows = rows.withColumns({f"_n{x}": F.row_number().over(w.orderBy(*order)) for x, w in ranks.items()})
        row = F.struct("total", "m_id", "m_open")
        pick = lambda cond, x, n: F.max(F.when(cond & (F.col(f"_n{x}") == n), row))
        best = lambda cond, x: F.transform(F.array_sort(F.collect_list(F.when(cond & (F.col(f"_n{x}") <= 2), F.struct(f"_n{x}", "m_id")))), lambda v: v["m_id"])
        count = lambda cond: F.coalesce(F.sum(F.when(cond, F.col("n"))), F.lit(0))
        yes = F.lit(True)
        g = rows.groupBy(key).agg(
            count(F.col("_both")).alias("n_both"), count(F.col("_both") & F.col("m_open")).alias("n_open"), F.max(F.when(F.col("_both") & F.col("m_open"), row)).alias("opened"), count(F.col("_same_name")).alias("n_name"),
            *(pick(cond, x, n).alias(f"{name}{n}") for name, cond, x in (("top", yes, ""), ("addr", F.col("_same_addr"), "a"), ("both", F.col("_both"), "b"), ("named", F.col("_same_name"), "n")) for n in (1, 2)),
            best(yes, "").alias("two"), best(F.col("_same_addr"), "a").alias("two_addr"), best(F.col("_both"), "b").alias("two_both"), best(F.col("_same_name"), "n").alias("two_name"),
        )
        second = lambda name: F.coalesce(F.col(f"{name}2.total"), F.lit(0.0))
        selected = F.when(F.col("n_open") == 1, F.col("opened")).otherwise(F.col("both1"))
        one = F.col("n_both") == 1
        # fixed values: methods
        tiers = [
            (one | ((F.col("n_both") > 1) & ((F.col("n_open") == 1) | (selected["total"] - F.col("both2.total") >= rules.open_margin))), F.when(one, "exact_name_address").otherwise("exact_name_address_open_priority"), selected, "two_both"),
            ((F.col("addr1.total") >= rules.same_address) & (F.col("addr1.total") - second("addr") >= rules.same_address_margin), F.lit("exact_address_name_similarity"), F.col("addr1"), "two_addr"),
            ((F.col("n_name") == 1) & (F.col("named1.total") >= rules.same_name), F.lit("exact_normalized_name"), F.col("named1"), "two_name"),
            ((F.col("top1.total") >= rules.fuzzy) & (F.col("top1.total") - second("top") >= rules.fuzzy_margin), F.lit("high_confidence_fuzzy"), F.col("top1"), "two"),
        ]
        chosen = F.coalesce(*(F.when(cond, F.struct(method.alias("method"), hit["total"].alias("score"), hit["m_id"].alias("id"), F.col(two).alias("two"))) for cond, method, hit, two in tiers))
        return g.withColumn("_d", chosen)

    verdicts = cut_lineage(scores_tier(s.where(~dangling)).select(key, "_d", F.col("top1.total").alias("top"), "two"))

    def decided(rest: DataFrame) -> DataFrame:
        return verdicts.where("_d is not null").select(key, *decision("matched", F.col("_d.method"), F.col("_d.score"), F.array("_d.id"), F.col("_d.two")))

    def no_address(rest: DataFrame) -> DataFrame:
        variant = lambda df, c: df.select("s_muni", c, F.explode(name_variants(F.col(c))).alias("_variant")).distinct()
        blank = rest.where("s_addr = ''")
        same = variant(blank, "s_name").join(variant(m, "m_name"), ["s_muni", "_variant"]).select("s_muni", "s_name", "m_name").distinct()
        rows = blank.join(same, ["s_muni", "s_name"]).join(m, ["s_muni", "m_name"]).withColumn("total", total(F.lit(1.0), F.lit(0.0)))
        web = F.startswith("m_id", F.lit("web:"))
        good = web & (F.col("m_cap") > 0) & (F.length("m_addr") >= rules.min_address_key)
        # fixed values: methods
        options = [(F.lit(True), "exact_normalized_name_without_source_address", 0.97), (good, "exact_name_web_master_quality_without_source_address", 0.95), (F.col("m_open"), "exact_normalized_name_open_priority_without_source_address", 0.96), (web & F.col("m_open"), "exact_normalized_name_open_web_priority_without_source_address", 0.95)]
        w = Window.partitionBy(key).orderBy(F.col("total").desc(), "m_id")
        open_w = Window.partitionBy(key, "m_open").orderBy(F.col("total").desc(), "m_id")
        rows = rows.withColumns({"_n": F.row_number().over(w), "_o": F.row_number().over(open_w)})
        best = lambda n, cond: F.transform(F.array_sort(F.collect_list(F.when(cond & (F.col(n) <= 2), F.struct(n, "m_id")))), lambda v: v["m_id"])
        g = rows.groupBy(key).agg(*(x for k, (cond, _, _) in enumerate(options) for x in (F.count_if(cond).alias(f"n{k}"), F.min(F.when(cond, F.col("m_id"))).alias(f"id{k}"))), F.max("total").alias("top"), best("_n", F.lit(True)).alias("two"), best("_o", F.col("m_open")).alias("two_open"))
        one = F.coalesce(*(F.when(F.col(f"n{k}") == 1, F.struct(F.lit(method).alias("method"), F.lit(score).alias("score"), F.col(f"id{k}").alias("id"), F.col("two_open" if k > 1 else "two").alias("two"))) for k, (_, method, score) in enumerate(options)))
        ok = F.col("_d").isNotNull()
        return g.withColumn("_d", one).select(key, *decision(F.when(ok, "matched").otherwise("ambiguous"), F.when(ok, F.col("_d.method")).otherwise("exact_name_multiple_without_source_address"), F.when(ok, F.col("_d.score")).otherwise(F.col("top")), F.when(ok, F.array("_d.id")).otherwise(F.array().cast(_NONE)), F.when(ok, F.col("_d.two")).otherwise(F.col("two"))))

    def unsure(rest: DataFrame) -> DataFrame:
        close = F.col("top") >= rules.ambiguous
        return verdicts.join(rest.select(key), key, "left_semi").select(key, *decision(F.when(close, "ambiguous").otherwise("unmatched"), F.when(close, "candidate_margin_too_small").otherwise("no_high_confidence_candidate"), F.col("top"), None, F.col("two")))

    return each(rows, row_key, ["s_muni", "s_name", "s_addr"], lambda texts, _: cascade(s, key, [by_alias, decided, no_address, lost, unsure]))
