"""Choosing one row of each key by explicit order, and what follows from an order of rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def pick_one(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each key in the given order. Spark limits groups before the shuffle (WindowGroupLimit)."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_place", F.row_number().over(w)).where("_place = 1").drop("_place")


def first_wins(df: DataFrame, keys: Sequence[str], priorities: Sequence[Column], tie: str) -> DataFrame:
    """Highest priorities win; among equals the earliest row."""
    return pick_one(df, keys, [*(p.desc() for p in priorities), F.col(tie).asc()])


def last_wins(df: DataFrame, keys: Sequence[str], tie: str) -> DataFrame:
    """The latest row of each key."""
    return pick_one(df, keys, [F.col(tie).desc()])


def row_priorities(state: Column, reference_status: Column, capacity_status: Column, coordinate_status: Column) -> list[Column]:
    """Open before closed before unknown; then matched reference, matched capacity, complete coordinate."""
    return [F.when(state, 2).when(~state, 1).otherwise(0), F.coalesce(reference_status.isin("matched", "matched_multiple"), F.lit(False)).cast("int"), F.coalesce(capacity_status == "matched", F.lit(False)).cast("int"), F.coalesce(coordinate_status == "complete", F.lit(False)).cast("int")]


def top_k(df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int, rank: str = "rank") -> DataFrame:
    """The first k rows of each key with their rank from 1."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(w)).where(F.col(rank) <= k)


def top_with_margin(df: DataFrame, keys: Sequence[str], score: str, tie: str) -> DataFrame:
    """The best row of each key with `runner_up`, the second score (0 if none), and `margin`."""
    ranked = top_k(df, keys, [F.col(score).desc(), F.col(tie).asc()], 2, "_rank")
    w = Window.partitionBy(*keys).orderBy("_rank")
    return ranked.withColumn("runner_up", F.lead(score, 1, 0.0).over(w)).where("_rank = 1").withColumn("margin", F.col(score) - F.col("runner_up")).drop("_rank")


def max_rows(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """All rows that hold the largest value of their key, ties included."""
    best = df.groupBy(*keys).agg(F.max(value).alias("_best"))
    return df.join(best, list(keys)).where(F.col(value) == F.col("_best")).drop("_best")


def previous_value(df: DataFrame, column: str, order: str) -> DataFrame:
    """Distinct values of a small ordered column with the one before each; gaps are stepped over."""
    values = df.select(F.col(column).alias(order)).distinct()
    return values.withColumn(f"previous_{order}", F.lag(order).over(Window.orderBy(order)))


def dedup_first_seen(df: DataFrame, content: Sequence[str], order: str) -> DataFrame:
    """The earliest row of each content. A hash of long content is grouped, not the content itself."""
    key = F.sha2(F.to_json(F.struct(*content), {"ignoreNullFields": "false"}), 256)
    first = df.groupBy(key.alias("_key")).agg(F.min(order).alias("_first"))
    return df.join(first.select(F.col("_first").alias(order)).distinct(), order, "left_semi")


def open_streaks(df: DataFrame, keys: Sequence[str], day: str) -> DataFrame:
    """Runs of consecutive days of each key: first day, last day and length."""
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(day))
    island = F.date_sub(F.col(day), place).alias("_island")
    return df.select(*keys, day).distinct().select(*keys, day, island).groupBy(*keys, "_island").agg(F.min(day).alias("first_day"), F.max(day).alias("last_day"), F.count("*").alias("days")).drop("_island")
