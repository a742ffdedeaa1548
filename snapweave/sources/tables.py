"""Reading and writing CSV, JSON and Parquet under fixed column contracts."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from snapweave.operators.quality import require

DATE_FILE = r"([0-9]{4}-[0-9]{2}-[0-9]{2})\.csv$"


def strings(columns: Sequence[str]) -> StructType:
    return StructType([StructField(c, StringType()) for c in columns])


def _exists(spark: SparkSession, path: str) -> bool:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = at.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).globStatus(at)
    return found is not None and len(found) > 0


def read_csv(spark: SparkSession, path: str, columns: Sequence[str] | None = None, missing_ok: bool = True) -> DataFrame:
    """A CSV file with header and quoted JSON cells, all text, blanks as "". A missing file is empty if that is allowed."""
    if not _exists(spark, path):
        if missing_ok and columns is not None:
            return spark.createDataFrame([], strings(columns))
        raise FileNotFoundError(path)
    df = spark.read.option("header", True).option("escape", '"').option("multiLine", True).option("encoding", "UTF-8").csv(path)
    if columns is not None:
        df = df.select(*(F.col(f"`{c}`") if c in df.columns else F.lit("").alias(c) for c in columns))
    return df.na.fill("")


def read_required(spark: SparkSession, path: str, required: Sequence[str]) -> DataFrame:
    return require(read_csv(spark, path, missing_ok=False), required)


def daily_files(spark: SparkSession, root: str) -> DataFrame:
    """(day, path) of root/YYYY/MM/DATE.csv files, by day; other file names are skipped."""
    paths = spark.read.format("binaryFile").option("pathGlobFilter", "*.csv").option("recursiveFileLookup", True).load(root).select("path")
    day = F.to_date(F.try_to_timestamp(F.regexp_extract("path", DATE_FILE, 1), F.lit("yyyy-MM-dd")))
    return paths.select(day.alias("day"), "path").where("day is not null").orderBy("day", "path")


def read_daily(spark: SparkSession, root: str, columns: Sequence[str], since=None) -> DataFrame:
    """All daily files as one table with `day` and an order column; one scan, pruned by path for a first day."""
    df = spark.read.schema(strings(columns)).option("header", True).option("escape", '"').option("enforceSchema", False).option("recursiveFileLookup", True).option("pathGlobFilter", "*.csv").csv(root)
    day = F.to_date(F.try_to_timestamp(F.regexp_extract(F.col("_metadata.file_name"), DATE_FILE, 1), F.lit("yyyy-MM-dd")))
    out = df.select("*", day.alias("day"), F.struct(F.col("_metadata.file_path").alias("path"), F.monotonically_increasing_id().alias("n")).alias("_ord")).where("day is not null")
    return (out if since is None else out.where(F.col("day") >= since)).na.fill("")


def concat_columns(frames: Sequence[DataFrame]) -> DataFrame:
    """Rows of all frames under the union of their columns, in order of first appearance."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def previous_day(days: DataFrame, current: Column, day: str = "day") -> DataFrame:
    """The latest day on record before the given one, if any."""
    return days.where(F.col(day) < current).agg(F.max(day).alias("previous_day"))


def with_order(df: DataFrame, name: str = "_ord") -> DataFrame:
    """An explicit insertion order; meaningful within one read."""
    return df.withColumn(name, F.monotonically_increasing_id())


def write_csv(df: DataFrame, path: str, columns: Sequence[str], mode: str = "overwrite") -> None:
    """Exactly these columns in this order; missing ones blank, others left out."""
    df.select(*(F.col(f"`{c}`") if c in df.columns else F.lit("").alias(c) for c in columns)).write.mode(mode).option("header", True).option("escape", '"').option("emptyValue", "").csv(path)


def write_partitioned(df: DataFrame, path: str, day: str) -> None:
    """Parquet by day; a rerun of a day replaces that day only."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(day).parquet(path)


def latest_view(df: DataFrame, day: str) -> DataFrame:
    """Rows of the last day: a filter, not a copy."""
    last = df.agg(F.max(day).alias(day))
    return df.join(F.broadcast(last), day)  # one row


def write_json_report(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def write_if_changed(new: DataFrame, path: str, ignore: Sequence[str] = ()) -> bool:
    """Write a report unless the one there has the same content but for the ignored columns."""
    from snapweave.operators.quality import same_content

    spark = new.sparkSession
    if _exists(spark, path) and same_content(spark.read.schema(new.schema).json(path), new, ignore):
        return False
    write_json_report(new, path)
    return True


CAPACITY_ITEM = "facilityId string, name string, capacity string, address string, latitude string, longitude string, municipalityCd string, municipalityName string"


def capacity_items(spark: SparkSession, path: str) -> DataFrame:
    """Items of {items: [...], total: n} documents, with the document's stated total."""
    doc = spark.read.schema(f"items array<struct<{', '.join(x.replace(' ', ':', 1) for x in CAPACITY_ITEM.split(', '))}>>, total long").option("multiLine", True).json(path)
    return doc.select("total", F.posexplode("items").alias("_ord", "_i")).select("total", "_ord", "_i.*")


def capacity_rows(items: DataFrame, acquired_at: str, source_url: str, source: str = "kumamoto_portal_map") -> DataFrame:
    """Master rows of capacity items."""
    from snapweave.functions.scalars import match_key, parse_capacity
    from snapweave.functions.text import address_key, clean_text, municipality_key, name_key_capacity

    c = {n: clean_text(F.col(n)) for n in ("facilityId", "municipalityCd", "municipalityName", "name", "address", "latitude", "longitude")}
    return items.select(c["facilityId"].alias("portal_shelter_id"), c["municipalityCd"].alias("municipality_code"), c["municipalityName"].alias("municipality"), c["name"].alias("shelter_name"), c["address"].alias("address"), c["latitude"].alias("portal_latitude"), c["longitude"].alias("portal_longitude"), parse_capacity(clean_text(F.col("capacity"))).alias("_c"), F.lit(source).alias("capacity_source"), F.lit(acquired_at).alias("capacity_acquired_at_jst"), match_key(municipality_key(F.col("municipalityName")), name_key_capacity(F.col("name")), address_key(F.col("address"))).alias("capacity_match_key"), F.lit(source_url).alias("source_url"), "_ord").select("*", F.col("_c.persons").alias("portal_capacity_persons"), F.col("_c.raw").alias("portal_capacity_raw"), F.col("_c.status").alias("capacity_parse_status")).drop("_c")


def capacity_contract(items: DataFrame, min_rows: int = 2000, min_parsed: int = 1) -> DataFrame:
    """The contract of a capacity document as rule rows: rows, unique ids, blank ids, parsed values, total."""
    from snapweave.functions.scalars import parse_capacity

    status = parse_capacity(F.col("capacity"))["status"]
    a = items.agg(F.count("*").alias("n"), F.count_distinct("facilityId").alias("ids"), F.count_if(F.trim(F.coalesce("facilityId", F.lit(""))) == "").alias("blank"), F.count_if(status == "parsed").alias("parsed"), F.max("total").alias("total"))
    rules = {"min_rows": F.greatest(F.lit(min_rows) - F.col("n"), F.lit(0)), "unique_ids": F.col("n") - F.col("ids"), "blank_ids": F.col("blank"), "min_parsed": F.greatest(F.lit(min_parsed) - F.col("parsed"), F.lit(0)), "total_equals_count": F.abs(F.coalesce("total", "n") - F.col("n"))}
    return a.select(F.inline(F.array(*(F.struct(F.lit(k).alias("rule"), v.cast("long").alias("n_violations")) for k, v in rules.items()))))


# Header words of the scraped listing, and what a cell of an empty listing says.
HEADER_ALIASES = {
    "municipality": ("市町村", "自治体", "市区町村"),
    "shelter_name": ("避難所名", "避難場所名", "施設名"),
    "opening_status": ("開設状況", "開設状態", "状態"),
    "congestion_status": ("混雑状況", "混雑状態"),
    "evacuee_count": ("避難者数", "避難者人数", "収容者数", "現在避難者数"),
    "address": ("住所", "所在地"),
    "route_search": ("ルート検索", "経路検索"),
}
NO_DATA = "条件に一致するデータが存在しません"


def canonical_header(name: str) -> str | None:
    """The column a header stands for; the longest alias contained in it wins."""
    bare = "".join(name.split())
    hits = [(len(a), -k, key) for k, (key, aliases) in enumerate(HEADER_ALIASES.items()) for a in aliases if a in bare]
    return max(hits)[2] if hits else None


def canonical_columns(df: DataFrame) -> DataFrame:
    """Columns under their canonical names; of several with one meaning the first counts, others are dropped."""
    out: dict[str, str] = {}
    for c in df.columns:
        key = canonical_header(c)
        if key and key not in out:
            out[key] = c
    return df.select(*(F.col(f"`{c}`").alias(key) for key, c in out.items()))


def clean_rows(raw: DataFrame, headers: str = "headers", cells: str = "cells", order: str = "_ord") -> DataFrame:
    """Scraped rows as maps: headers filled as column_N, rows cut or padded to them, blank, no-data and repeated rows dropped.

    Of two headers with one name the last one's cell counts.
    """
    from snapweave.functions.text import normalize_list
    from snapweave.operators.picks import first_wins

    raw = raw.withColumns({"_names": normalize_list(F.col(headers)), "_cells": normalize_list(F.col(cells))})
    names = F.transform("_names", lambda h, i: F.when(h == "", F.concat(F.lit("column_"), (i + 1).cast("string"))).otherwise(h))
    width = F.size("_names")
    fitted = F.slice(F.concat("_cells", F.array_repeat(F.lit(""), width)), 1, width)
    rows = raw.withColumns({"_names": names, "_cells": fitted}).where(F.exists("_cells", lambda v: v != "") & ~F.exists("_cells", lambda v: F.contains(v, F.lit(NO_DATA))))
    pairs = F.transform(F.col("_names"), lambda h, i: F.struct(h.alias("key"), F.get(F.col("_cells"), i).alias("value"), (F.size("_names") - F.array_position(F.reverse("_names"), h) == i).alias("last")))
    kept = F.transform(F.filter(pairs, lambda x: x["last"]), lambda x: F.struct(x["key"], x["value"]))
    rows = rows.withColumn("_row", kept).withColumn("_key", F.sha2(F.to_json(F.array_sort("_row")), 256))
    return first_wins(rows, ["_key"], [], order).select(order, F.map_from_entries("_row").alias("row"))
