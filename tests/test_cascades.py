"""The linkage cascades over whole driver tables against record-by-record versions in plain Python."""

import difflib
import os
from math import asin, cos, radians, sin, sqrt

import pytest
from pyspark.sql import functions as F

from snapweave.functions import text
from snapweave.functions.scalars import EARTH_RADIUS_M
from snapweave.operators import linkage
from snapweave.plans import queries as q

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no driver tables")


def ratio(a, b):
    return difflib.SequenceMatcher(None, a, b).ratio()


@pytest.fixture(scope="module")
def sides(spark):
    def keyed(odd):
        df = q._parts(spark, SF, odd)
        keys = {"muni": text.municipality_key(F.col("municipality")), "ref": text.name_key_reference(F.col("shelter_name")), "cap": text.name_key_capacity(F.col("shelter_name")), "mun": text.name_key_municipal(F.col("shelter_name")), "addr": text.address_key(F.col("address")), "maddr": text.address_key_municipal(F.col("address")), "guess": text.municipality_key(text.infer_municipality(text.clean_text(F.col("address"))))}
        df = df.withColumns(keys).withColumn("vars", text.name_variants(F.col("mun")))
        return [r.asDict() for r in df.collect()]

    return keyed(True), keyed(False)


def check(got, want):
    got = {r["row_id"]: (r["status"], r["method"], round(r["score"], 9), r["matches"]) for r in got.collect()}
    assert got.keys() == want.keys()
    wrong = {k: (got[k], want[k]) for k in want if got[k] != (*want[k][:2], round(want[k][2], 9), ",".join(sorted(want[k][3])))}
    assert not wrong, (len(wrong), list(wrong.items())[:4])
    return {w[1] for w in want.values()}


def fuzzy(s, pool, name, limits):
    least, total_least, margin, address_least, alone = limits
    scored = []
    for m in pool:
        n = ratio(s[name], m[name])
        if n >= 0.80:
            a = ratio(s["addr"], m["addr"]) if s["addr"] and m["addr"] else 0.0
            scored.append((n if not s["addr"] else 0.82 * n + (1 - 0.82) * a, n, a, m["id"]))
    if not scored:
        return "unmatched", "no_candidate", 0.0, []
    scored.sort(key=lambda x: (-x[0], x[3]))
    total, n, a, i = scored[0]
    second = scored[1][0] if len(scored) > 1 else 0.0
    ok = n >= least and total >= total_least and total - second >= margin and (not s["addr"] or a >= address_least or n >= alone)
    return ("matched", "high_confidence_fuzzy", total, [i]) if ok else ("unmatched", "fuzzy_below_threshold", total, [])


def test_reference(spark, sides):
    source, master = sides
    master = [m | {"id": str(m["row_id"])} for m in master]
    want = {}
    for s in source:
        inside = lambda m, s=s: not s["muni"] or s["muni"] in m["addr"]
        both = [m for m in master if s["addr"] and (m["ref"], m["addr"]) == (s["ref"], s["addr"])]
        same = [m for m in master if m["ref"] == s["ref"]]
        here = [m for m in same if inside(m)]
        ids = lambda rows: [m["id"] for m in rows]
        if not s["ref"]:
            d = ("unmatched", "missing_name", 0.0, [])
        elif both:
            d = ("matched" if len(both) == 1 else "matched_multiple", "exact_name_address", 1.0, ids(both))
        elif len(here) == 1:
            d = ("matched", "exact_name_municipality", 0.99, ids(here))
        elif here and len({m["addr"] for m in here}) == 1:
            d = ("matched_multiple", "exact_name_municipality_same_address", 0.99, ids(here))
        elif len(same) == 1:
            d = ("unmatched", "exact_name_municipality_conflict", 0.0, [])
        elif same and len({m["addr"] for m in same}) == 1:
            d = ("matched_multiple", "exact_name_same_address", 0.97, ids(same))
        elif same:
            d = ("ambiguous", "exact_name_multiple_addresses", 0.0, [])
        else:
            d = fuzzy(s, [m for m in master if inside(m)] or master, "ref", (0.94, 0.92, 0.035, 0.65, 0.985))
        want[s["row_id"]] = d
    assert len(check(q.QUERIES["reference_match"](spark, SF), want)) >= 4


def metres(a, b):
    (la, lo), (lb, ob) = a, b
    t = sin(radians(lb - la) / 2) ** 2 + cos(radians(la)) * cos(radians(lb)) * sin(radians(ob - lo) / 2) ** 2
    return 2 * EARTH_RADIUS_M * asin(min(1.0, sqrt(t)))


def nearest(s, pool):
    if s["latitude"] is None:
        return None
    near = []
    for m in pool:
        if m["latitude"] is not None:
            d = metres((float(s["latitude"]), float(s["longitude"])), (float(m["latitude"]), float(m["longitude"])))
            if d <= 250:
                near.append((d, -ratio(s["cap"], m["cap"]), -(ratio(s["addr"], m["addr"]) if s["addr"] and m["addr"] else 0.0), m["id"]))
    if not near:
        return None
    near.sort()
    d, n, a, i = near[0]
    n, a = -n, -a
    if len(near) > 1 and near[1][0] - d < 12 and -near[1][1] >= n - 0.04:
        return "ambiguous", "coordinate_near_tie", 0.0, []
    method = "coordinate_with_name_20m" if d <= 20 and n >= 0.55 else "coordinate_name_address_75m" if d <= 75 and n >= 0.72 and (a >= 0.35 or n >= 0.9) else "coordinate_high_similarity_200m" if d <= 200 and n >= 0.9 and a >= 0.55 else None
    return method and ("matched", method, min(0.999, max(0.8, 0.58 * n + 0.17 * a + 0.25 * max(0, 1 - d / 250) + (0.08 if d <= 20 else 0.03))), [i])


def test_capacity(spark, sides):
    source, master = sides
    master = [m | {"id": str(m["row_id"])} for m in master if m["shelter_name"].strip()]
    known = {m["id"] for m in master}
    want = {}
    for s in source:
        s = s | {"muni": s["muni"] or s["guess"]}
        wanted = str(s["row_id"] + 1) if s["row_id"] % 23 == 0 else ""
        exact = [m for m in master if (m["muni"], m["cap"], m["addr"]) == (s["muni"], s["cap"], s["addr"])]
        same = [m for m in master if m["cap"] == s["cap"] and (not s["muni"] or m["muni"] == s["muni"])]
        pool = [m for m in master if not s["muni"] or m["muni"] == s["muni"]] or master
        if wanted in known:
            d = ("matched", "portal_shelter_id", 1.0, [wanted])
        elif len(exact) == 1:
            d = ("matched", "exact_municipality_name_address", 1.0, [exact[0]["id"]])
        elif exact:
            d = nearest(s, exact) or ("ambiguous", "duplicate_exact_key", 0.0, [])
        elif len(same) == 1 and not (s["addr"] and same[0]["addr"]):
            d = ("matched", "exact_name_municipality", 0.97, [same[0]["id"]])
        elif len(same) == 1 and ratio(s["addr"], same[0]["addr"]) >= 0.72:
            d = ("matched", "exact_name_municipality_address_similar", ratio(s["addr"], same[0]["addr"]), [same[0]["id"]])
        elif len(same) > 1:
            d = nearest(s, same) or ("ambiguous", "exact_name_multiple_capacity_rows", 0.0, [])
        else:
            d = nearest(s, pool) or fuzzy(s, pool, "cap", (0.96, 0.93, 0.04, 0.68, 0.99))
        want[s["row_id"]] = d
    assert len(check(q.QUERIES["capacity_match"](spark, SF), want)) >= 5


def test_no_capacity_master(spark):
    source = q._parts(spark, SF, True)
    master = q._parts(spark, SF, False).where("row_id < 0").select(F.col("row_id").cast("string").alias("portal_shelter_id"), "municipality", "shelter_name", "address", F.col("latitude").alias("portal_latitude"), F.col("longitude").alias("portal_longitude"))
    assert [tuple(r) for r in linkage.match_capacity(source, master).select("status", "method").distinct().collect()] == [("master_unavailable", "capacity_master_not_found")]


def test_manual(spark, sides):
    source, master = sides
    ids = {("web:" if m["row_id"] % 3 == 0 else "") + str(m["row_id"]): m for m in master}
    want = {}
    for s in source:
        k, near = s["row_id"], str(s["row_id"] + 1)
        own, web = near if k % 5 == 0 else "", near if k % 5 == 1 else "web:" + near if k % 5 == 2 else ""
        same = [i for i, m in ids.items() if (m["muni"], m["cap"], m["addr"]) == (s["muni"], s["cap"], s["addr"])]
        tried = [i for i in (web, web if web.startswith("web:") else "web:" + web) if web and i in ids]
        if own in ids:
            d = ("matched", "manual_shelter_id", 1.0, [own])
        elif tried:
            d = ("matched", "manual_web_shelter_id", 1.0, tried[:1])
        elif same:
            d = ("matched", "manual_exact_identity", 1.0, same) if len(same) == 1 else ("ambiguous", "manual_duplicate_identity", 0.0, [])
        else:
            d = ("unmatched", "manual_no_match", 0.0, [])
        want[k] = d
    check(q.QUERIES["manual_match"](spark, SF), want)


def test_municipal(spark, sides):
    source, master = sides
    master = [m | {"id": ("web:" if m["row_id"] % 3 == 0 else "s") + str(m["row_id"]), "open": m["row_id"] % 4 == 0, "cap_n": 1200 if m["row_id"] % 6 == 0 else 0} for m in master]
    known = {m["id"] for m in master}
    aliases = {}
    for s in sorted(source, key=lambda s: s["row_id"]):
        if s["row_id"] % 47 == 0 and s["muni"] and s["mun"]:
            for address in (s["maddr"], ""):
                aliases[s["muni"], s["mun"], address] = f"s{s['row_id'] + 1}"
    want = {}
    for s in source:
        def score(m, s=s):
            n = max((ratio(x, y) for x in s["vars"] for y in m["vars"]), default=0.0)
            a = ratio(s["maddr"], m["maddr"]) if s["maddr"] and m["maddr"] else 0.0
            return min(1.0, 0.64 * n + 0.32 * a + (0.04 if m["open"] else 0.0))

        pool = sorted(((-score(m), m["id"], m) for m in master if m["muni"] == s["muni"]), key=lambda x: x[:2])
        pool = [(-x, m) for x, _, m in pool]
        named = [(x, m) for x, m in pool if set(s["vars"]) & set(m["vars"])]
        addressed = [(x, m) for x, m in pool if s["maddr"] and m["maddr"] == s["maddr"]]
        both = [(x, m) for x, m in named if s["maddr"] and m["maddr"] == s["maddr"]]
        opened = [(x, m) for x, m in both if m["open"]]
        second = lambda rows: rows[1][0] if len(rows) > 1 else 0.0
        alias = aliases.get((s["muni"], s["mun"], s["maddr"])) or aliases.get((s["muni"], s["mun"], ""))
        if alias:
            d = ("matched", "manual_alias", 1.0, [alias]) if alias in known else ("unmatched", "alias_target_missing", 0.0, [])
        elif not pool:
            d = ("unmatched", "municipality_not_found", 0.0, [])
        else:
            d = None
            if both:
                chosen = opened[0] if len(opened) == 1 else both[0]
                if len(both) == 1 or len(opened) == 1 or chosen[0] - both[1][0] >= 0.025:
                    d = ("matched", "exact_name_address" if len(both) == 1 else "exact_name_address_open_priority", chosen[0], [chosen[1]["id"]])
            if not d and addressed and addressed[0][0] >= 0.72 and addressed[0][0] - second(addressed) >= 0.04:
                d = ("matched", "exact_address_name_similarity", addressed[0][0], [addressed[0][1]["id"]])
            if not d and len(named) == 1 and named[0][0] >= 0.70:
                d = ("matched", "exact_normalized_name", named[0][0], [named[0][1]["id"]])
            top = pool[0][0]
            if not d and top >= 0.86 and top - second(pool) >= 0.055:
                d = ("matched", "high_confidence_fuzzy", top, [pool[0][1]["id"]])
            d = d or (("ambiguous", "candidate_margin_too_small", top, []) if top >= 0.74 else ("unmatched", "no_high_confidence_candidate", top, []))
        if d[0] != "matched" and not s["maddr"] and named:
            good = [m for _, m in named if m["id"].startswith("web:") and m["cap_n"] > 0 and len(m["maddr"]) >= 5]
            opened = [m for _, m in named if m["open"]]
            web = [m for m in opened if m["id"].startswith("web:")]
            d = ("ambiguous", "exact_name_multiple_without_source_address", named[0][0], [])
            for rows, method, points in reversed([([m for _, m in named], "exact_normalized_name_without_source_address", 0.97), (good, "exact_name_web_master_quality_without_source_address", 0.95), (opened, "exact_normalized_name_open_priority_without_source_address", 0.96), (web, "exact_normalized_name_open_web_priority_without_source_address", 0.95)]):
                if len(rows) == 1:
                    d = ("matched", method, points, [rows[0]["id"]])
        want[s["row_id"]] = d
    assert len(check(q.QUERIES["municipal_match"](spark, SF), want)) >= 5


def test_name_pairs_lose_none(spark):
    import random

    r = random.Random(9)
    names = ["".join(r.choices("abcde町", k=r.randint(0, 9))) for _ in range(120)]
    left = spark.createDataFrame([(k, x) for k, x in enumerate(names[:60])], "row_id int, s_name string")
    right = spark.createDataFrame([(k, x) for k, x in enumerate(names[60:])], "m_id int, m_name string")
    got = {(x["row_id"], x["m_id"]) for x in linkage.name_pairs(left, right, "row_id", "m_id").collect()}
    assert got == {(i, j) for i, a in enumerate(names[:60]) for j, b in enumerate(names[60:]) if a and b and ratio(a, b) >= 0.8} and got


@pytest.mark.parametrize("name", ["reference", "capacity", "municipal"])
def test_copies_are_compared_once(spark, monkeypatch, name):
    """Rows with texts that others have too take their decision, and cost no pair and no comparison of their own."""
    compared, met = spark.sparkContext.accumulator(0), []
    fuzzy_tier = linkage.fuzzy_tier
    monkeypatch.setattr(linkage, "fuzzy_tier", lambda pairs, *rest: met.append(pairs.count()) or fuzzy_tier(pairs, *rest))

    def counted(udf):
        def count(a, b):
            compared.add(len(a))
            return udf.func(a, b)

        count.__annotations__ = {"a": "pd.Series", "b": "pd.Series", "return": "pd.Series"}
        return F.pandas_udf(count, "double", F.PandasUDFType.SCALAR)

    monkeypatch.setattr(linkage, "similarity", counted(text.similarity))
    monkeypatch.setattr(linkage, "best_similarity", counted(text.best_similarity))
    source, master = q._parts(spark, SF, True).where("shelter_name <> ''"), q._parts(spark, SF, False)
    ids = {"reference": "common_id", "capacity": "portal_shelter_id", "municipal": "shelter_id"}
    master = master.withColumnsRenamed({"latitude": "portal_latitude", "longitude": "portal_longitude"}) if name == "capacity" else master
    master = master.withColumn(ids[name], F.col("row_id").cast("string")).drop("row_id").withColumns({"is_open": F.lit(False), "capacity": F.lit("0")})
    aliases = spark.createDataFrame([], "municipality string, source_shelter_name string, source_address string, shelter_id string, _ord int")

    def run(rows, to):
        before = compared.value
        met.clear()
        out = {"reference": linkage.match_reference, "capacity": linkage.match_capacity, "municipal": lambda s, m: linkage.match_municipal(s, m, aliases)}[name](rows, to)
        got = {r["row_id"]: tuple(r)[1:] for r in out.collect()}
        return got, compared.value - before, sum(met)

    copies = source.withColumn("row_id", F.explode(F.transform(F.sequence(F.lit(0), F.lit(9)), lambda i: F.col("row_id") + i * 100_000)))
    one, few, pairs = run(source, master)
    many, more, as_many = run(copies, master)
    assert as_many == pairs and (pairs or name == "municipal")
    assert len(many) == 10 * len(one) and all(many[k] == one[k % 100_000] for k in many)
    twice = master.withColumn(ids[name], F.explode(F.array(ids[name], *(F.concat(F.lit(f"z{i}-"), ids[name]) for i in range(7)))))
    _, most, _ = run(source, twice)
    assert 0 < few and more <= 1.2 * few and most <= 3 * few, (few, more, most)


def test_keys_are_made_once_for_each_text(spark, monkeypatch):
    made = spark.sparkContext.accumulator(0)

    def counted(x):
        made.add(len(x))
        return text.nfkc.func(x)

    counted.__annotations__ = {"x": "pd.Series", "return": "pd.Series"}
    monkeypatch.setattr(text, "nfkc", F.pandas_udf(counted, "string", F.PandasUDFType.SCALAR))
    rows = spark.range(5000).selectExpr("id", "if(id % 4 = 0, null, concat('town ', id % 2, '市')) town", "concat('Hall ', id % 3) name", "concat('熊本県八代市', id % 2) place")
    got = {(r["k_muni"], r["k_name"], r["k_addr"]) for r in linkage._keyed(rows, "town", "name", "place", "k_", infer=True).collect()}
    assert got == {(t, f"hall{n}", f"八代市{p}") for n in range(3) for t, p in (("八代市", 0), ("town0市", 0), ("town1市", 1))}
    assert 0 < made.value < 500


def test_best_names_equal_all_pairs(spark):
    """Several rows an address, ties, addresses that the highest score fills and others that it does not."""
    import random

    r = random.Random(4)
    names = ["".join(r.choices("ab町", k=r.randint(3, 7))) for _ in range(40)]
    master = [(r.choice(names), f"a{r.randrange(4)}", f"m{k:03}") for k in range(300)]
    left, right = spark.createDataFrame([(x,) for x in names[:25]], "s_name string"), spark.createDataFrame(master, "m_name string, m_addr string, m_id string")
    got = sorted((x["s_name"], x["m_addr"], x["m_id"], x["name_score"]) for x in linkage.best_names(left.distinct(), right, [], 3).collect())
    want = []
    for s in set(names[:25]):
        for a in {m[1] for m in master}:
            near = sorted((-ratio(s, m), i) for m, b, i in master if b == a and ratio(s, m) >= 0.8)
            want += [(s, a, i, -n) for n, i in near[:3]]
    assert got == sorted(want) and len(want) > 100
