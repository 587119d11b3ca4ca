"""Streaming runs over the event table; each processes what is there and stops."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.session import work_path
from tidemark.streaming import pipelines as L

from .register import query

KEY, DAY = "series_key", "day"
EVENT_SCHEMA = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"


def _stream(spark, sf_dir):
    """The event table as a stream of files (the pattern is this one name, a file or a folder of parts)."""
    rows = L.read_landed_files(spark, f"{sf_dir}/{{events.parquet}}", EVENT_SCHEMA, format="parquet")
    return rows.select(
        F.col("event_type").alias(KEY),
        F.col("ts").cast("timestamp").alias("ts"),
        "event_id",
        F.col("value").cast("decimal(18,2)").alias("value"),
    )


@query(
    """SELECT event_type AS series_key, CAST(ts AS DATE) AS day, MAX(value) AS value_max, MIN(value) AS value_min,
  CAST(SUM(CAST(value AS DECIMAL(18,2))) AS DOUBLE) / COUNT(value) AS value_mean,
  CAST(SUM(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS value_sum, COUNT(*) FILTER (WHERE value > 0) AS n_positive
FROM events GROUP BY 1, 2
HAVING CAST(CAST(ts AS DATE) AS TIMESTAMP) + INTERVAL 1 DAY <= (SELECT MAX(ts) FROM events) - INTERVAL 7 DAY"""
)
def stream_daily_rollup(spark, sf_dir):
    """Days closed by the seven-day watermark."""
    path = work_path(spark, "stream-rollup")
    rolled = L.streaming_rollup(_stream(spark, sf_dir), key=KEY, ts="ts", value="value")
    L.write_stream(rolled, f"{path}/data", f"{path}/checkpoint").awaitTermination()
    out = spark.read.parquet(f"{path}/data")
    return out.select(
        KEY, DAY, *[F.col(c).cast("double").alias(c) for c in ("value_max", "value_min", "value_mean", "value_sum")], "n_positive"
    )


@query(
    """SELECT event_type AS series_key, CAST(ts AS DATE) AS day, MIN(event_id) AS event_id FROM events GROUP BY 1, 2"""
)
def stream_insert_absent(spark, sf_dir):
    """Each batch appends its first reading per series and day; the replayed stream adds nothing."""
    path = work_path(spark, "stream-store")
    rows = _stream(spark, sf_dir).select(KEY, F.to_date("ts").alias(DAY), "event_id")
    for attempt in ("first", "replay"):
        checkpoint = f"{path}/checkpoint-{attempt}"
        L.append_stream_to_store(rows, f"{path}/data", checkpoint, keys=[KEY, DAY], order=["event_id"]).awaitTermination()
    return spark.read.parquet(f"{path}/data").select(KEY, DAY, "event_id")


@query("SELECT DISTINCT event_type AS series_key, CAST(ts AS DATE) AS day FROM events")
def stream_dedup(spark, sf_dir):
    """One row per series and day among the readings within the watermark."""
    path = work_path(spark, "stream-dedup")
    rows = _stream(spark, sf_dir).withColumn(DAY, F.to_date("ts"))
    kept = L.first_per_day(rows, keys=[KEY, DAY], ts="ts").select(KEY, DAY)
    L.write_stream(kept, f"{path}/data", f"{path}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{path}/data")
