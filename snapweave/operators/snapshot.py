"""Daily snapshots: overlay on a population, comparison with the day before, removals."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapweave.functions.scalars import open_text
from snapweave.operators.picks import last_wins


@dataclass(frozen=True)
class TrackedField:
    column: str
    label: str
    title: str


#: Fields whose change is reported, in order of report.
TRACKED = (
    TrackedField("opening_status", "opening_status_changed", "開設状況"),
    TrackedField("congestion_status", "congestion_changed", "混雑状況"),
    TrackedField("evacuee_count", "evacuee_count_changed", "避難者数"),
    TrackedField("address", "address_changed", "住所"),
)


def _cell(c: Column) -> Column:
    return F.trim(F.coalesce(c.cast("string"), F.lit("")))


def state_change(before: Column, after: Column) -> Column:
    """Label of a change of a nullable open state; null if there is none."""
    return F.when(before.eqNullSafe(after), None).when(~before & after, "opened").when(before & ~after, "closed").otherwise("open_state_changed")


def diff(current: DataFrame, previous: DataFrame, key: str = "shelter_id", state: str = "is_open", tracked: Sequence[TrackedField] = TRACKED, tie: str | None = None) -> DataFrame:
    """Current rows with change_type, change_details and previous_<field>; `new` where no earlier row is.

    One left join on the key. Of earlier rows with one key the latest by `tie` counts. Labels join with ";".
    """
    if tie:
        previous = last_wins(previous, [key], tie)
    fields = [state, *(f.column for f in tracked)]
    old = previous.select(key, F.lit(True).alias("_there"), *(F.col(c).alias(f"_old_{c}") for c in fields))
    both = current.join(old, key, "left")
    before = {f: _cell(F.col(f"_old_{f.column}")) for f in tracked}
    after = {f: _cell(F.col(f.column)) for f in tracked}
    moved = state_change(F.col(f"_old_{state}"), F.col(state))
    labels = F.array_compact(F.array(moved, *(F.when(before[f] != after[f], f.label) for f in tracked)))
    said = F.when(moved == "opened", "未開設または閉鎖から開設へ変化").when(moved == "closed", "開設から未開設または閉鎖へ変化").when(moved.isNotNull(), F.concat(F.lit(f"{state}: "), open_text(F.col(f"_old_{state}")), F.lit(" -> "), open_text(F.col(state))))
    shown = lambda c: F.when(c == "", "(空欄)").otherwise(c)
    details = F.array_compact(F.array(said, *(F.when(before[f] != after[f], F.concat(F.lit(f"{f.title}: "), shown(before[f]), F.lit(" -> "), shown(after[f]))) for f in tracked)))
    new = F.col("_there").isNull()
    return both.select(
        *(F.col(c) for c in current.columns if c not in ("change_type", "change_details") and not c.startswith("previous_")),
        F.when(new, "new").when(F.size(labels) == 0, "unchanged").otherwise(F.array_join(labels, ";")).alias("change_type"),
        F.when(new, "前回スナップショットに同一避難所なし").otherwise(F.array_join(details, " / ")).alias("change_details"),
        *(F.col(f"_old_{f.column}").alias(f"previous_{f.column}") for f in tracked if f.column != "address"),
    )


def removed(current: DataFrame, previous: DataFrame, key: str = "shelter_id", overrides: dict[str, Column] | None = None) -> DataFrame:
    """Earlier rows whose key is gone, carried over with overrides; state columns stay as they were."""
    gone = previous.join(current.select(key), key, "left_anti")
    return gone.withColumns({"change_type": F.lit("removed_from_listing"), **(overrides or {})})


def changes(current: DataFrame, previous: DataFrame, key: str = "shelter_id", overrides: dict[str, Column] | None = None, **options) -> DataFrame:
    """The change feed: new and changed rows of the day, and removals."""
    now = diff(current, previous, key, **options).where("change_type <> 'unchanged'")
    return now.unionByName(removed(current, previous, key, overrides), allowMissingColumns=True)


def overlay(population: DataFrame, listed: DataFrame, key: str, defaults: dict[str, Column], tie: str | None = None) -> DataFrame:
    """A row for every member of the population, the listed one where there is one, else the defaults; unknown listed rows are added.

    Of listed rows with one key the latest by `tie` counts. `source` tells listed, default and unmatched.
    """
    if tie:
        listed = last_wins(listed, [key], tie)
    columns = [c for c in listed.columns if c not in (key, tie)]
    web = listed.select(key, F.struct(*columns).alias("_web"))
    filled = F.struct(*(defaults.get(c, F.lit(None)).cast(listed.schema[c].dataType).alias(c) for c in columns))
    dense = population.select(key).join(web, key, "left").select(key, F.coalesce("_web", filled).alias("_row"), F.when(F.col("_web").isNull(), "default").otherwise("listed").alias("source")).select(key, "_row.*", "source")
    extra = listed.join(population.select(key), key, "left_anti").select(key, *columns, F.lit("unmatched").alias("source"))
    return dense.unionByName(extra)


def day_counts(rows: DataFrame, day: str, label: str, subject: str) -> DataFrame:
    return rows.groupBy(day, label).agg(F.count("*").alias("n_rows"), F.count_distinct(subject).alias("n_subjects"))


def consecutive_days(states: DataFrame, day: str, key: str, state: str, opening: str) -> DataFrame:
    """Labels for each (day, key) against the previous day on record, all days at once, and removals.

    One equi-join of states with themselves on (previous day, key): the small table of days is broadcast
    to name each row's previous and next day, so no day is handled in a loop.
    """
    from snapweave.operators.picks import previous_value

    days = previous_value(states, day, "d").withColumnsRenamed({"d": day, "previous_d": "_previous"})
    now = states.join(F.broadcast(days), day)  # one row for each day on record
    then = states.select(F.col(day).alias("_previous"), key, F.col(state).alias("_before"))
    joined = now.join(then, ["_previous", key], "left")
    label = F.when(F.col("_before").isNull(), "new").when(F.col("_before") == F.col(state), "unchanged").when(F.col(state) == opening, "opened").when(F.col("_before") == opening, "closed").otherwise("open_state_changed")
    present = joined.select(day, key, F.col("_before").alias("before"), F.col(state).alias("after"), label.alias("label"))
    next_day = days.where("_previous is not null").select(F.col("_previous").alias("_then"), F.col(day).alias("_next"))
    due = states.select(F.col(day).alias("_then"), key, F.col(state).alias("before")).join(F.broadcast(next_day), "_then").select(F.col("_next").alias(day), key, "before")
    gone = due.join(states.select(day, key), [day, key], "left_anti")
    return present.unionByName(gone.select(day, key, "before", F.lit(None).cast("string").alias("after"), F.lit("removed_from_listing").alias("label")))
