"""Observation logs with revisions: late corrections are new revisions at the same observed time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from snapweave.operators.picks import first_wins, max_rows


def snapshot_hash(records: DataFrame, keys: Sequence[str], sort_by: Sequence[str], fields: Sequence[str]) -> DataFrame:
    """`content_hash` of each snapshot: SHA-256 of its records, sorted by the given keys, as compact JSON."""
    item = F.struct(*(F.col(c).alias(f"_{k}") for k, c in enumerate(sort_by)), F.struct(*fields).alias("_row"))
    rows = F.transform(F.array_sort(F.collect_list(item)), lambda x: x["_row"])
    return records.groupBy(*keys).agg(F.sha2(F.to_json(rows), 256).alias("content_hash"))


def assign_revisions(incoming: DataFrame, log: DataFrame, source: str, observed_at: str, content: str, order: str, against_latest: bool = False) -> DataFrame:
    """New snapshots with their revision: contents that the log has (at any revision, or with against_latest at the
    current one) and repeats within the batch are ignored; the rest are numbered on from the log's highest revision.
    """
    keys = [source, observed_at]
    fresh = incoming
    if against_latest:
        known = max_rows(log, keys, "revision").select(*keys, content)
        changed = F.lag(content).over(Window.partitionBy(*keys).orderBy(order))
        fresh = fresh.withColumn("_last", changed).where(F.col("_last").isNull() | (F.col("_last") != F.col(content))).drop("_last")
        first = F.row_number().over(Window.partitionBy(*keys).orderBy(order))
        fresh = fresh.withColumn("_n", first).join(known.withColumn("_known", F.lit(True)), [*keys, content], "left").where("not (_n = 1 and coalesce(_known, false))").drop("_n", "_known")
    else:
        fresh = first_wins(fresh, [*keys, content], [], order).join(log.select(*keys, content), [*keys, content], "left_anti")
    top = log.groupBy(*keys).agg(F.max("revision").alias("_top"))
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(order))
    return fresh.withColumn("_place", place).join(top, keys, "left").withColumn("revision", (F.coalesce("_top", F.lit(0)) + F.col("_place")).cast("int")).drop("_place", "_top")


def latest_revision(log: DataFrame, source: str, observed_at: str) -> DataFrame:
    """All rows of the highest revision of each (source, observed_at)."""
    return max_rows(log, [source, observed_at], "revision")


def latest_observation(log: DataFrame, source: str, observed_at: str) -> DataFrame:
    """All rows of each source's latest observation, at its highest revision."""
    return latest_revision(max_rows(log, [source], observed_at), source, observed_at)


def best_of_day(log: DataFrame, subject: str, day: str, observed_at: str, tie: str) -> DataFrame:
    """One row for each subject and day: latest observation, highest revision, earliest row."""
    return first_wins(log, [subject, day], [F.col(observed_at), F.col("revision")], tie)
