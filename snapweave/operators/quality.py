"""Data-quality rules as queries: each gives (rule, severity, n_checked, n_violations, examples)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F




def check_rows(df: DataFrame, rules: dict[str, Column], subject: str, severity: str = "error") -> DataFrame:
    """Several row rules in one scan; a rule's column is true for a violation (null counts as none)."""
    bad = {name: F.coalesce(cond, F.lit(False)) for name, cond in rules.items()}
    aggregated = df.agg(F.count("*").alias("n_checked"), *(x for k, cond in enumerate(bad.values()) for x in (F.count_if(cond).alias(f"n{k}"), F.min(F.when(cond, F.col(subject).cast("string"))).alias(f"e{k}"))))
    rows = F.inline(F.array(*(F.struct(F.lit(name).alias("rule"), F.lit(severity).alias("severity"), F.col("n_checked"), F.col(f"n{k}").alias("n_violations"), F.col(f"e{k}").alias("example")) for k, name in enumerate(bad))))
    return aggregated.select(rows)


def unique(df: DataFrame, keys: Sequence[str], rule: str) -> DataFrame:
    """Keys that occur more than once."""
    counts = df.groupBy(*keys).agg(F.count("*").alias("_n"))
    return counts.agg(F.count("*").alias("n_checked"), F.count_if(F.col("_n") > 1).alias("n_violations"), F.min(F.when(F.col("_n") > 1, F.concat_ws("|", *keys))).alias("example")).select(F.lit(rule).alias("rule"), F.lit("error").alias("severity"), "n_checked", "n_violations", "example")


def foreign_key(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str, rule: str) -> DataFrame:
    """Child rows whose key no parent has."""
    keys = parent.select(F.col(parent_key).alias(child_key)).distinct()
    flagged = child.where(F.col(child_key).isNotNull()).join(keys.withColumn("_there", F.lit(True)), child_key, "left")
    gone = F.col("_there").isNull()
    return flagged.agg(F.count("*").alias("n_checked"), F.count_if(gone).alias("n_violations"), F.min(F.when(gone, F.col(child_key).cast("string"))).alias("example")).select(F.lit(rule).alias("rule"), F.lit("error").alias("severity"), "n_checked", "n_violations", "example")


def least(df: DataFrame, rule: str, value: Column, minimum: float) -> DataFrame:
    """An aggregate that must reach a minimum (row counts, match rates)."""
    return df.agg(F.count("*").alias("n_checked"), value.alias("_v")).select(F.lit(rule).alias("rule"), F.lit("error").alias("severity"), "n_checked", F.when(F.coalesce(F.col("_v"), F.lit(0)) < minimum, 1).otherwise(0).cast("long").alias("n_violations"), F.col("_v").cast("string").alias("example"))


def missing_columns(df: DataFrame, required: Sequence[str]) -> list[str]:
    return sorted(set(required) - set(df.columns))


def require(df: DataFrame, required: Sequence[str]) -> DataFrame:
    gone = missing_columns(df, required)
    if gone:
        raise ValueError(f"missing columns: {gone}")
    return df


def gate(report: DataFrame) -> DataFrame:
    """The report, or an error that names the rules that failed. Save what reviewers need before calling it."""
    failed = [r["rule"] for r in report.where("severity = 'error' and n_violations > 0").select("rule").collect()]
    if failed:
        raise ValueError(f"rules failed: {', '.join(sorted(failed))}")
    return report


def cell_differences(a: DataFrame, b: DataFrame, keys: Sequence[str], columns: Sequence[str], tolerance: float | None = None) -> DataFrame:
    """Cells of two tables that differ or are in one only, long: keys, column, left and right text."""
    x = a.select(*keys, *(F.col(c).alias(f"_a_{c}") for c in columns), F.lit(True).alias("_in_a"))
    y = b.select(*keys, *(F.col(c).alias(f"_b_{c}") for c in columns), F.lit(True).alias("_in_b"))
    both = x.join(y, list(keys), "full_outer")
    def same(c: str) -> Column:
        plain = F.col(f"_a_{c}").eqNullSafe(F.col(f"_b_{c}"))
        return plain if tolerance is None else plain | F.coalesce(F.abs(F.col(f"_a_{c}") - F.col(f"_b_{c}")) <= tolerance, F.lit(False))

    cells = F.array(*(F.struct(F.lit(c).alias("column"), F.col(f"_a_{c}").cast("string").alias("left"), F.col(f"_b_{c}").cast("string").alias("right"), same(c).alias("same")) for c in columns))
    return both.select(*keys, F.explode(cells).alias("_c")).select(*keys, "_c.column", "_c.left", "_c.right", "_c.same").where("not same").drop("same")


def set_difference(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Keys that only one side has, with the side."""
    left, right = a.select(key).distinct(), b.select(key).distinct()
    return left.join(right, key, "left_anti").withColumn("side", F.lit("left_only")).unionByName(right.join(left, key, "left_anti").withColumn("side", F.lit("right_only")))


def value_frequency(df: DataFrame, column: str) -> DataFrame:
    """How often each value occurs; null and blank count as (blank)."""
    value = F.coalesce(F.nullif(F.trim(F.col(column).cast("string")), F.lit("")), F.lit("(blank)"))
    return df.groupBy(value.alias("value")).agg(F.count("*").alias("n"))


def match_rate(df: DataFrame, matched: Column, by: Sequence[str] = ()) -> DataFrame:
    """Share of rows that match; 0 for no rows."""
    return df.groupBy(*by).agg(F.count("*").alias("n"), F.count_if(matched).alias("n_matched")).withColumn("rate", F.coalesce(F.try_divide(F.col("n_matched"), F.col("n")), F.lit(0.0)))


def control_total(parts: DataFrame, totals: DataFrame, key: str, amount: Column, total: str, tolerance: float = 0.0) -> DataFrame:
    """Sums of parts against published totals: key, calculated, published, difference, agrees."""
    sums = parts.groupBy(key).agg(F.sum(amount).alias("calculated"))
    both = totals.select(key, F.col(total).alias("published")).join(sums, key, "left")
    difference = F.coalesce("calculated", F.lit(0)) - F.col("published")
    return both.withColumn("difference", difference).withColumn("agrees", F.abs("difference") <= tolerance)


def same_content(a: DataFrame, b: DataFrame, ignore: Sequence[str] = ()) -> bool:
    """Whether two reports have the same rows, whatever is ignored (timestamps); a writer may then be spared."""
    columns = [c for c in a.columns if c not in ignore]
    x, y = a.select(columns), b.select(columns)
    return x.exceptAll(y).isEmpty() and y.exceptAll(x).isEmpty()
