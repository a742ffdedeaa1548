"""Merging a fresh download into a master, and keyed logs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapweave.operators.picks import last_wins

PARSED = "parsed"
PRESERVED = "preserved_previous_parsed"


def merge_master(existing: DataFrame, downloaded: DataFrame, keys: Sequence[str], preserved: Sequence[str], status: str, tie: str | None = None, keep_preserved: bool = True) -> DataFrame:
    """Downloaded rows over existing ones; rows only in existing stay; earlier verified values outlive a bad download.

    keys: the first non-blank one identifies a row; rows without any are dropped. Where the earlier row is
    parsed (or was preserved before, if keep_preserved) and the new one isn't, the `preserved` columns come
    from the earlier row and the status says so. Within a side the latest row by `tie` wins.
    """
    key = F.coalesce(*(F.when(F.trim(F.col(k).cast("string")) != "", F.col(k).cast("string")) for k in keys))
    columns = [c for c in downloaded.columns if c != tie]
    sides = []
    for side in (existing, downloaded):
        side = side.withColumn("_key", key).where("_key is not null")
        side = last_wins(side, ["_key"], tie) if tie else side
        sides.append(side.select("_key", F.struct(*columns).alias("_row")))
    old, new = sides[0].withColumnRenamed("_row", "_old"), sides[1].withColumnRenamed("_row", "_new")
    both = old.join(new, "_key", "full_outer")
    good = F.col(f"_old.{status}").isin(PARSED, *([PRESERVED] if keep_preserved else []))
    keep = F.coalesce(good & (F.coalesce(F.col(f"_new.{status}"), F.lit("")) != PARSED), F.lit(False))
    out = []
    for c in columns:
        fresh = F.when(F.col("_new").isNull(), F.col(f"_old.{c}")).otherwise(F.col(f"_new.{c}"))
        if c in preserved:
            fresh = F.when(F.col("_new").isNotNull() & keep, F.col(f"_old.{c}")).otherwise(fresh)
        if c == status:
            fresh = F.when(F.col("_new").isNotNull() & keep, F.lit(PRESERVED)).otherwise(fresh)
        out.append(fresh.alias(c))
    return both.select(*out)


def upsert_log(log: DataFrame, rows: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The log without entries of the new keys, with the new rows, in order."""
    return log.join(rows.select(*keys), list(keys), "left_anti").unionByName(rows, allowMissingColumns=True).orderBy(*order)


def not_smaller(existing: DataFrame, merged: DataFrame) -> DataFrame:
    """A rule row: the merged master must not have fewer rows."""
    a, b = existing.agg(F.count("*").alias("before")), merged.agg(F.count("*").alias("after"))
    return a.join(b, F.lit(True)).select(F.lit("master_not_smaller").alias("rule"), F.greatest(F.col("before") - F.col("after"), F.lit(0)).alias("n_violations"))
