"""CSV, Parquet and JSON payload readers.  Missing readings arrive as NULL, never NaN."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..schema import DAILY_MEASURES, HOURLY_MEASURES, nan_to_null, payload_schema


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """CSV with a header.  Give a schema for large files: inference costs a second scan."""
    reader = spark.read.option("header", True).option("nanValue", "")
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", True)
    return nan_to_null(reader.csv(path))


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return nan_to_null(spark.read.parquet(path))


def read_documents(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """Multi-line JSON documents, one row per file."""
    reader = spark.read.option("multiLine", True)
    return (reader.schema(schema) if schema is not None else reader).json(path)


def unpack_payload(df: DataFrame, payload: Column, measures: Sequence[str], ids: Sequence[str]) -> DataFrame:
    """Parallel arrays of a payload section to rows: ids, time, measures.

    A measure the payload lacks is missing on every row; the rows themselves stay.
    """
    absent = F.array().cast("array<double>")
    arrays = [payload["time"].alias("time"), *[F.coalesce(payload[m], absent).alias(m) for m in measures]]
    zipped = F.arrays_zip(*arrays)
    rows = df.select(*ids, F.explode(zipped).alias("_row"))
    return rows.select(*ids, *[F.col("_row")[name].alias(name) for name in ["time", *measures]])


def parse_payload(
    df: DataFrame, text: str, *, section: str, measures: Sequence[str], ids: Sequence[str]
) -> DataFrame:
    """Rows of a payload held as JSON text."""
    parsed = df.withColumn("_payload", F.from_json(text, payload_schema(section, measures)))
    return nan_to_null(unpack_payload(parsed, F.col(f"_payload.{section}"), measures, ids))


def unreadable(df: DataFrame, text: str, *, section: str, measures: Sequence[str], ids: Sequence[str]) -> DataFrame:
    """Payloads without a readable section: ids and the text, for the caller to count or keep."""
    parsed = F.from_json(text, payload_schema(section, list(measures)))
    return df.where(parsed[section]["time"].isNull()).select(*ids, text)


def parse_daily(df: DataFrame, text: str, *, ids: Sequence[str], measures: Sequence[str] | None = None) -> DataFrame:
    """Daily payloads to one row per day; the time text becomes the date column ``day``.

    A time that is no date gives a row without a day; ``unreadable`` returns payloads without rows.
    """
    measures = list(measures or [m for m in DAILY_MEASURES if m != "humidity"])
    rows = parse_payload(df, text, section="daily", measures=measures, ids=ids)
    return rows.select(*ids, F.col("time").try_cast("date").alias("day"), *measures)


def parse_hourly(df: DataFrame, text: str, *, ids: Sequence[str], measures: Sequence[str] | None = None) -> DataFrame:
    """Hourly payloads to one row per reading with the local timestamp ``ts``."""
    measures = list(measures or HOURLY_MEASURES)
    rows = parse_payload(df, text, section="hourly", measures=measures, ids=ids)
    return rows.select(*ids, F.col("time").try_cast("timestamp_ntz").alias("ts"), *measures)


def unpack_metrics(df: DataFrame, text: str, *, ids: Sequence[str]) -> DataFrame:
    """``{model: {metric: value}}`` documents to one row per (ids, model, metric)."""
    parsed = df.select(*ids, F.from_json(text, "map<string,map<string,double>>").alias("_models"))
    models = parsed.select(*ids, F.explode("_models").alias("model", "_metrics"))
    return models.select(*ids, "model", F.explode("_metrics").alias("metric", "value"))


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def write_json(df: DataFrame, path: str) -> None:
    """Line-delimited JSON, for instance of a dashboard series."""
    df.write.mode("overwrite").json(path)
