"""Streaming counterparts of the batch operators.

A stream re-reads late data for seven days: that is the watermark.  Every sink is idempotent,
so a batch replayed after a failure changes nothing.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from ..functions.scalars import mean_of
from ..operators.training import score
from ..sources.files import parse_daily, parse_hourly
from ..sources.store import append_new_days

# Fixed value: how late a reading may arrive.
LATENESS = "7 days"


def read_landed_files(
    spark: SparkSession, path: str, schema: T.StructType | str, *, format: str = "json", files_per_batch: int | None = None
) -> DataFrame:
    """A stream over files landing in a folder; the schema is fixed, never inferred."""
    reader = spark.readStream.schema(schema).format(format)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path)


def read_landed_payloads(spark: SparkSession, path: str, *, section: str, ids: Sequence[str], **kw: object) -> DataFrame:
    """Landed payload lines (ids and the payload text) parsed to rows."""
    schema = ", ".join([*[f"{i} string" for i in ids], "payload string"])
    lines = read_landed_files(spark, path, schema)
    parse = {"daily": parse_daily, "hourly": parse_hourly}[section]
    return parse(lines, "payload", ids=list(ids), **kw)


def streaming_rollup(
    readings: DataFrame, *, key: str, ts: str, value: str, lateness: str = LATENESS
) -> DataFrame:
    """One row per (series, closed day).

    State holds a few numbers per open (series, day); exact quantiles or modes are left to
    the batch operators because their state grows with the distinct values.
    """
    day = F.window(ts, "1 day")
    rolled = (
        readings.withWatermark(ts, lateness)
        .groupBy(F.col(key), day)
        .agg(
            F.max(value).alias("value_max"),
            F.min(value).alias("value_min"),
            mean_of(value).alias("value_mean"),
            F.coalesce(F.sum(value), F.lit(0)).alias("value_sum"),
            F.count_if(F.col(value) > 0).alias("n_positive"),
        )
    )
    return rolled.select(key, F.to_date("window.start").alias("day"), *rolled.columns[2:])


def first_per_day(readings: DataFrame, *, keys: Sequence[str], ts: str, lateness: str = LATENESS) -> DataFrame:
    """Keep one row per key among those arriving within the lateness."""
    return readings.withWatermark(ts, lateness).dropDuplicatesWithinWatermark(list(keys))


def append_stream_to_store(
    stream: DataFrame, path: str, checkpoint: str, *, keys: Sequence[str], day: str = "day", order: Sequence[str] | None = None
) -> StreamingQuery:
    """Append every micro-batch's absent keys to the observation store."""

    def write(batch: DataFrame, _: int) -> None:
        append_new_days(batch.sparkSession, path, batch, keys=keys, day=day, order=order)

    return run_available(stream, checkpoint, write)


def run_available(stream: DataFrame, checkpoint: str, write: Callable[[DataFrame, int], None]) -> StreamingQuery:
    """Process what has landed so far and stop; run again for newer files."""
    return (
        stream.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def write_stream(stream: DataFrame, path: str, checkpoint: str, *, mode: str = "append") -> StreamingQuery:
    """Exactly-once Parquet sink of a stream, processing what is available."""
    return (
        stream.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode(mode)
        .trigger(availableNow=True)
        .start()
    )


def score_stream(model: PipelineModel, stream: DataFrame, targets: Sequence[str]) -> DataFrame:
    """Batch scoring applied to a stream: the same transformers, row by row."""
    return score(model, stream, targets)
