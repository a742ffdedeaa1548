"""Profiles of JSON documents and pages, link discovery and table dimensions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapweave.functions.text import keyword_contexts, keyword_count

MAX_DEPTH = 20


def json_nodes(df: DataFrame, column: str, max_depth: int = MAX_DEPTH) -> DataFrame:
    """Every node of each row's JSON: _doc, path, type and (for scalars) value. Invalid JSON has no nodes.

    Levels are unfolded one after another by variant_explode; unfolding ends at the first empty level.
    """
    docs = df.select(F.monotonically_increasing_id().alias("_doc"), F.try_parse_json(F.col(column)).alias("_v")).where("_v is not null")
    level = docs.select("_doc", F.lit("$").alias("path"), "_v")
    out = None
    for _ in range(max_depth):
        kind = F.schema_of_variant("_v")
        row = level.select("_doc", "path", F.when(F.startswith(kind, F.lit("OBJECT")), "object").when(F.startswith(kind, F.lit("ARRAY")), "array").otherwise(F.lower(kind)).alias("type"), F.when(~F.rlike(kind, F.lit("^(OBJECT|ARRAY)")), F.try_variant_get("_v", "$", "string")).alias("value"), "_v")
        shown = row.drop("_v")
        out = shown if out is None else out.unionByName(shown)
        inner = row.where("type in ('object', 'array')")
        if inner.isEmpty():
            break
        inner.createOrReplaceTempView("_snapweave_json_level")
        level = df.sparkSession.sql("select l._doc, case when e.key is null then l.path || '[]' else l.path || '.' || e.key end as path, e.value as _v from _snapweave_json_level l, lateral variant_explode(l._v) e")
    return out


def json_keys(df: DataFrame, column: str, examples: int = 8) -> DataFrame:
    """For each path: how many nodes and documents, and a few distinct values in order."""
    nodes = json_nodes(df, column)
    return nodes.groupBy("path", "type").agg(F.count("*").alias("n"), F.count_distinct("_doc").alias("n_docs"), F.slice(F.array_sort(F.collect_set("value")), 1, examples).alias("examples"))


def object_shapes(df: DataFrame, column: str, limit: int = 30) -> DataFrame:
    """The most common sets of top-level keys; ties by name."""
    keys = F.array_join(F.array_sort(F.json_object_keys(column)), ",")
    return df.select(keys.alias("shape")).where("shape is not null").groupBy("shape").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "shape").limit(limit)


def page_keywords(pages: DataFrame, key: str, column: str, keywords: Sequence[str], contexts: int = 3) -> DataFrame:
    """Counts and first contexts of each keyword on each page."""
    rows = F.array(*(F.struct(F.lit(k).alias("keyword"), keyword_count(F.col(column), k).cast("long").alias("n"), keyword_contexts(F.col(column), k, first=contexts).alias("contexts")) for k in keywords))
    return pages.select(key, F.explode(rows).alias("_k")).select(key, "_k.*").where("n > 0")


def resources(pages: DataFrame, column: str, keywords: Sequence[str]) -> DataFrame:
    """Pages that hold any keyword, with the keywords found."""
    words = F.array(*map(F.lit, keywords))
    return pages.withColumn("hits", F.filter(words, lambda k: F.contains(F.col(column), k))).where(F.size("hits") > 0)


def table_dimensions(cells: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows and widest row of each extracted table."""
    return cells.groupBy(*keys).agg(F.count("*").alias("n_rows"), F.max(F.size("cells")).alias("n_columns"))


def safe_name(c: Column, length: int = 120) -> Column:
    return F.substring(F.regexp_replace(c, r"[^A-Za-z0-9._-]+", "_"), 1, length)


def query_url(base: str, params: dict[str, Column]) -> Column:
    parts = [F.concat(F.lit(f"{name}="), F.url_encode(value.cast("string"))) for name, value in params.items()]
    return F.concat(F.lit(base + ("&" if "?" in base else "?")), F.concat_ws("&", *parts))


def rank_links(pages: DataFrame, key: str, html: str, base_url: str, suffix: str, words: dict[str, int], path_score: int = 100, text_score: int = 80, anchor_score: int = 5) -> DataFrame:
    """Links to documents on each page, best first: url, label, score.

    An anchor scores for a path that ends with the suffix, else for the suffix anywhere in url or label, plus
    words of its label or url. Attribute values that merely end with the suffix are a second way in. The
    largest score of a url counts; scripts and fragments are left out; relative links are made absolute.
    """
    anchors = F.transform(F.regexp_extract_all(html, F.lit(r"(?is)<a\s[^>]*?href\s*=\s*[\"']([^\"']+)[\"'][^>]*>(.*?)</a>"), 0), lambda a: F.struct(F.regexp_extract(a, r"(?is)href\s*=\s*[\"']([^\"']+)[\"']", 1).alias("raw"), F.trim(F.regexp_replace(F.regexp_replace(a, r"(?s)<[^>]*>", " "), r"(?U)\s+", " ")).alias("label"), F.lit(anchor_score).alias("score")))
    attributes = F.transform(F.regexp_extract_all(html, F.lit(r"(?i)(?:href|src|data)\s*=\s*[\"']([^\"']+?" + suffix.replace(".", r"\.") + r"(?:\?[^\"']*)?)[\"']"), 1), lambda u: F.struct(u.alias("raw"), F.lit("").alias("label"), F.lit(0).alias("score")))
    found = pages.select(key, F.col(base_url).alias("_base"), F.explode(F.concat(anchors, attributes)).alias("_a")).select(key, "_base", "_a.*")
    found = found.where(~F.rlike("raw", F.lit(r"(?i)^(javascript:|mailto:|#)")) & (F.col("raw") != ""))
    origin, folder = F.regexp_extract("_base", r"^([a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*)", 1), F.regexp_extract("_base", r"^([a-zA-Z][a-zA-Z0-9+.-]*://[^?#]*/)", 1)
    absolute = F.when(F.rlike("raw", F.lit("^[a-zA-Z][a-zA-Z0-9+.-]*:")), F.col("raw")).when(F.startswith("raw", F.lit("//")), F.concat(F.regexp_extract("_base", r"^([a-zA-Z][a-zA-Z0-9+.-]*:)", 1), F.col("raw"))).when(F.startswith("raw", F.lit("/")), F.concat(origin, F.col("raw"))).otherwise(F.concat(F.when(folder != "", folder).otherwise(F.concat(origin, F.lit("/"))), F.col("raw")))
    found = found.withColumn("url", absolute)
    path = F.lower(F.regexp_extract("url", r"^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*([^?#]*)", 1))
    base = F.when(F.endswith(path, F.lit(suffix)), path_score).when(F.contains(F.lower(F.concat_ws(" ", "label", "url")), F.lit(suffix)), text_score)
    bonus = sum((F.when(F.contains("label", F.lit(w)) | F.contains("url", F.lit(w)), s).otherwise(0) for w, s in words.items()), F.lit(0))
    scored = found.withColumn("score", F.col("score") + base + bonus).where("score is not null")
    return scored.groupBy(key, "url").agg(F.max("score").alias("score"), F.max_by("label", F.struct("score", "label")).alias("label")).orderBy(key, F.desc("score"), "url")
