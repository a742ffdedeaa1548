"""Streams give what batches give, and failed gates write nothing."""

import pytest
from pyspark.sql import functions as F

from snapweave.operators import quality
from snapweave.operators.revisions import assign_revisions
from snapweave.streaming import observations as o

SCHEMA = "s string, t timestamp, h string, o long"


@pytest.fixture
def files(spark, tmp_path):
    rows = [("x", "2026-08-01 08:00:00", "A", 1), ("x", "2026-08-01 08:00:00", "A", 2), ("x", "2026-08-01 08:00:00", "B", 3), ("y", "2026-08-01 09:00:00", "A", 4), ("x", "2026-08-01 08:00:00", "B", 5), ("x", "2026-08-02 08:00:00", "C", 6)]
    df = spark.createDataFrame(rows, "s string, t string, h string, o long").withColumn("t", F.col("t").cast("timestamp"))
    for k in range(3):
        df.where(F.pmod(F.col("o"), F.lit(3)) == (k + 1) % 3).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    return df, str(tmp_path)


def test_revisions_equal_batch(spark, files):
    df, root = files
    stream = o.landed(spark, f"{root}/in", df.schema, files_per_batch=1)
    for _ in range(2):  # a second run finds nothing new
        o.append_revisions(stream, f"{root}/log", f"{root}/cp", "s", "t", "h", "o").awaitTermination()
    log = o.read_log(spark, f"{root}/log", spark.read.parquet(f"{root}/log").drop("batch_id").schema)
    want = assign_revisions(df, df.limit(0).withColumn("revision", F.lit(0)), "s", "t", "h", "o")
    assert sorted(log.groupBy("s", "t").agg(F.sort_array(F.collect_set("h")).alias("h"), F.max("revision").alias("r")).collect()) == sorted(want.groupBy("s", "t").agg(F.sort_array(F.collect_set("h")).alias("h"), F.max("revision").alias("r")).collect())


def test_failed_gate_writes_nothing(spark, files):
    df, root = files
    rules = lambda b: quality.check_rows(b, {"no_b": F.col("h") == "B"}, "s")
    with pytest.raises(Exception, match="rules failed: no_b"):
        o.append_revisions(o.landed(spark, f"{root}/in", df.schema), f"{root}/log2", f"{root}/cp2", "s", "t", "h", "o", rules).awaitTermination()
    assert o.read_log(spark, f"{root}/log2", df.schema).count() == 0


def test_days_are_replaced(spark, files):
    df, root = files
    stream = o.landed(spark, f"{root}/in", df.schema).withColumn("day", F.col("t").cast("date"))
    o.overwrite_days(stream, f"{root}/days", f"{root}/cp3", "day").awaitTermination()
    assert spark.read.parquet(f"{root}/days").count() == df.count()
    past = lambda old, new: quality.least(new, "newer", F.count_if(F.col("day") > F.lit("2030-01-01")), 1)
    with pytest.raises(Exception, match="newer"):
        o.overwrite_days(stream, f"{root}/days", f"{root}/cp4", "day", past).awaitTermination()


def test_changed_only_and_latest(spark, files):
    df, root = files
    stream = o.landed(spark, f"{root}/in", df.schema)
    o.changed_only(stream, ["s", "t", "h"]).writeStream.format("memory").queryName("changed").option("checkpointLocation", f"{root}/cp5").trigger(availableNow=True).start().awaitTermination()
    assert spark.table("changed").count() == df.dropDuplicates(["s", "t", "h"]).count() == 4
    o.changed_only(stream, ["s", "t", "h"], "t").writeStream.format("memory").queryName("bounded").option("checkpointLocation", f"{root}/cp6").trigger(availableNow=True).start().awaitTermination()
    assert spark.table("bounded").count() == 4
    o.latest_of_day(stream, ["s"], "t", ["o", "h"]).writeStream.format("memory").queryName("latest").outputMode("complete").option("checkpointLocation", f"{root}/cp7").trigger(availableNow=True).start().awaitTermination()
    assert sorted((r["s"], str(r["day"]), r["h"]) for r in spark.table("latest").collect()) == [("x", "2026-08-01", "B"), ("x", "2026-08-02", "C"), ("y", "2026-08-01", "A")]
