"""Structured Streaming over landed observations: detection of change, revisions, day partitions and gates.

Every sink is idempotent by batch: a batch writes under its own id and a repeated batch overwrites that, so a
restart after a lost executor or driver gives the same log. A failed gate raises before anything is written and
the checkpoint does not advance, so a failure never turns into a zero.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import IntegerType, LongType, StructType

from snapweave.operators.quality import gate
from snapweave.operators.revisions import assign_revisions


def landed(spark: SparkSession, path: str, schema: StructType, kind: str = "parquet", files_per_batch: int = 100, **options) -> DataFrame:
    """A stream of files as they land; all that is there comes first, in bounded batches."""
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch)
    for k, v in options.items():
        reader = reader.option(k, v)
    return reader.format(kind).load(path)


def changed_only(stream: DataFrame, keys: Sequence[str], event_time: str | None = None, late: str = "7 days") -> DataFrame:
    """Rows whose (source, event time, content) wasn't seen; with a watermark the state is bounded."""
    if event_time is None:
        return stream.dropDuplicates(list(keys))
    return stream.withWatermark(event_time, late).dropDuplicatesWithinWatermark(list(keys))


def latest_of_day(stream: DataFrame, keys: Sequence[str], event_time: str, columns: Sequence[str], late: str = "1 day") -> DataFrame:
    """The latest row of each key in each tumbling day."""
    order = F.struct(event_time, *columns)
    grouped = stream.withWatermark(event_time, late).groupBy(F.window(event_time, "1 day"), *keys).agg(F.max(order).alias("_last"))
    return grouped.select(F.col("window.start").cast("date").alias("day"), *keys, *(F.col(f"_last.{c}").alias(c) for c in columns))


def read_log(spark: SparkSession, path: str, schema: StructType, before_batch: int | None = None) -> DataFrame:
    """The log's rows; with before_batch those of earlier batches only. A log that isn't there is empty."""
    try:
        log = spark.read.schema(StructType([*schema.fields]).add("batch_id", LongType())).parquet(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], schema)
    log = log if before_batch is None else log.where(F.col("batch_id") < before_batch)
    return log.drop("batch_id")


def append_revisions(stream: DataFrame, path: str, checkpoint: str, source: str, observed_at: str, content: str, order: str, rules: Callable[[DataFrame], DataFrame] | None = None, against_latest: bool = False) -> StreamingQuery:
    """Append each batch's new snapshots to the log at path with their revisions.

    `rules` makes a report of a batch (rule, severity, n_violations); an error in it stops the stream before
    the batch is written.
    """
    schema = StructType([*stream.schema.fields]).add("revision", IntegerType())

    def write(batch: DataFrame, batch_id: int) -> None:
        if rules is not None:
            gate(rules(batch))
        log = read_log(batch.sparkSession, path, schema, batch_id)
        new = assign_revisions(batch, log, source, observed_at, content, order, against_latest)
        new.select(*(f.name for f in schema)).write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def overwrite_days(stream: DataFrame, path: str, checkpoint: str, day: str, rules: Callable[[DataFrame, DataFrame], DataFrame] | None = None) -> StreamingQuery:
    """Write each batch by day; a day that comes again replaces that day's partition only.

    `rules` gets (table so far, batch), for example to forbid changes of past days.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        if rules is not None:
            try:
                old = batch.sparkSession.read.parquet(path)
            except AnalysisException as e:
                if "PATH_NOT_FOUND" not in str(e):
                    raise
                old = batch.limit(0)
            gate(rules(old, batch))
        batch.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(day).parquet(path)

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
