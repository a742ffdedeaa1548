"""Wide tables with a column for each date, from long ones and back."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def date_columns(*frames: DataFrame, column: str) -> list[str]:
    """Distinct ISO dates of all frames, ascending. Dates are few; they become column names."""
    dates = frames[0].select(F.date_format(column, "yyyy-MM-dd").alias("d"))
    for f in frames[1:]:
        dates = dates.unionByName(f.select(F.date_format(column, "yyyy-MM-dd").alias("d")))
    return [r["d"] for r in dates.where("d is not null").distinct().orderBy("d").collect()]


def last_non_blank(df: DataFrame, keys: Sequence[str], columns: Sequence[str], order: Sequence[str]) -> DataFrame:
    """For each key the latest value of every column that isn't blank."""
    def of(c: str) -> Column:
        filled = F.when(F.trim(F.coalesce(F.col(c).cast("string"), F.lit(""))) != "", F.struct(*order, F.col(c).alias("_value")))
        return F.max(filled)["_value"].alias(c)

    return df.groupBy(*keys).agg(*(of(c) for c in columns))


def pivot_dates(df: DataFrame, keys: Sequence[str], day: str, value: Column, dates: Sequence[str], default=None) -> DataFrame:
    """One row for each key with a column for each date; dates are named, so no pass finds them.

    The value of a (key, date) must be unique; pick one first.
    """
    wide = df.groupBy(*keys).pivot(day, list(dates)).agg(F.first(value, ignorenulls=True))
    return wide if default is None else wide.na.fill(default, list(dates))


def unpivot_dates(wide: DataFrame, keys: Sequence[str], dates: Sequence[str], day: str = "day", value: str = "value") -> DataFrame:
    return wide.unpivot(list(keys), list(dates), day, value)


def changed_cells(old: DataFrame, new: DataFrame, keys: Sequence[str], dates: Sequence[str]) -> DataFrame:
    """Cells of past dates that differ between two wide tables, or are in one only."""
    a = unpivot_dates(old, keys, dates, value="before")
    b = unpivot_dates(new, keys, dates, value="after")
    return a.join(b, [*keys, "day"], "full_outer").where("not (before <=> after)")


def wide_counts(population: DataFrame, counts: DataFrame, key: str, day: str, value: str, dates: Sequence[str]) -> DataFrame:
    """Population rows with a count for each date; blank where nothing was observed, never 0."""
    wide = counts.groupBy(key).pivot(day, list(dates)).agg(F.first(value, ignorenulls=True))
    return population.join(wide, key, "left")


def wide_schema_errors(columns: Sequence[str], fixed: Sequence[str]) -> list[str]:
    """What is wrong with a wide table's columns: fixed ones first and in order, then ascending ISO dates."""
    import re

    out = [] if list(columns[: len(fixed)]) == list(fixed) else ["fixed columns differ"]
    dates = list(columns[len(fixed) :])
    out += [f"not a date: {d}" for d in dates if not re.fullmatch(r"\d{4}-\d{2}-\d{2}", d)]
    return out + (["dates not ascending"] if dates != sorted(set(dates)) else [])
