"""Summaries and series for dashboards, as ordinary rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..schema import numeric_columns
from .features import last_rows
from .ingest import absent_rows

# What a summary shows when the newest row lacks a measure.
HEADLINE_DEFAULTS = {
    "temperature_2m_mean": 20.0,
    "temperature_2m_max": 25.0,
    "temperature_2m_min": 15.0,
    "precipitation_sum": 0.0,
    "windspeed_10m_max": 15.0,
}


def rounded(columns: Mapping[str, str], digits: int = 1, default: float = 0.0) -> list[Column]:
    """Output name -> source column, missing as ``default``, rounded half to even."""
    return [
        F.bround(F.coalesce(F.col(c).cast("double"), F.lit(default)), digits).alias(n) for n, c in columns.items()
    ]


def dashboard_series(df: DataFrame, *, key: str, day: str, columns: Mapping[str, str], n: int = 30) -> DataFrame:
    """The last ``n`` days of every series, rounded for display."""
    return last_rows(df, key=key, order=day, n=n).select(key, day, *rounded(columns))


def metric_series(series: DataFrame, *, ids: Sequence[str], metrics: Sequence[str], metric: str | None = None) -> DataFrame:
    """Display columns as (metric, value) rows, optionally of one metric only."""
    long = series.unpivot(list(ids), list(metrics), "metric", "value")
    return long if metric is None else long.where(F.col("metric") == metric)


def append_today(series: DataFrame, today: DataFrame, *, keys: Sequence[str], day: str = "day") -> DataFrame:
    """Add today's row to each series that does not show it yet."""
    return series.unionByName(absent_rows(series, today, keys=keys, day=day), allowMissingColumns=True)


def chart_arrays(series: DataFrame, *, key: str, day: str, columns: Sequence[str], n: int = 30) -> DataFrame:
    """One row per series with equally long arrays of its last ``n`` rows."""
    points = F.array_sort(F.collect_list(F.struct(day, *columns)))
    packed = last_rows(series, key=key, order=day, n=n).groupBy(key).agg(points.alias("_points"))
    return packed.select(key, *[F.col(f"_points.{c}").alias(c) for c in [day, *columns]])


def data_summary(df: DataFrame, *, key: str, day: str, columns: Sequence[str]) -> DataFrame:
    """Rows, columns, date range, numeric columns, missing cells and 8-byte cell volume per series."""
    missing = F.lit(0).cast("bigint")
    for c in columns:
        missing = missing + F.count_if(F.col(c).isNull())
    return df.groupBy(key).agg(
        F.count("*").alias("n_rows"),
        F.lit(len(df.columns)).alias("n_columns"),
        F.min(day).alias("first_day"),
        F.max(day).alias("last_day"),
        F.lit(len([c for c in numeric_columns(df) if c in columns])).alias("numeric_columns"),
        missing.alias("missing_cells"),
        (F.count("*") * (8 * len(df.columns))).alias("cell_bytes"),
    )


def date_range(df: DataFrame, *, key: str, day: str) -> DataFrame:
    return df.groupBy(key).agg(
        F.min(day).alias("first_day"), F.max(day).alias("last_day"), F.count("*").alias("n_rows")
    )


def collection_summary(
    total: DataFrame, fetched: DataFrame, inserted: DataFrame, *, key: str, day: str, defaults: Mapping[str, float]
) -> DataFrame:
    """Per series: rows fetched, inserted and stored, the date range and the newest measures."""
    new = fetched.groupBy(key).agg(
        F.count("*").alias("fetched"), F.max_by(F.struct(*defaults), day).alias("_newest"), F.max(day).alias("newest_day")
    )
    added = inserted.groupBy(key).agg(F.count("*").alias("inserted"))
    stored = date_range(total, key=key, day=day).withColumnRenamed("n_rows", "total_records")
    shown = [F.coalesce(F.col(f"_newest.{c}").cast("double"), F.lit(d)).alias(c) for c, d in defaults.items()]
    return (
        stored.join(new, key)
        .join(added, key, "left")
        .select(
            key,
            "total_records",
            "first_day",
            "last_day",
            "fetched",
            F.coalesce("inserted", F.lit(0).cast("bigint")).alias("inserted"),
            "newest_day",
            *shown,
        )
    )


def collection_stats(log: DataFrame, *, key: str, at: str, rows: str) -> DataFrame:
    """Totals of a collection log per series."""
    return log.groupBy(key).agg(
        F.count("*").alias("total_collections"),
        F.max(at).alias("last_collection"),
        F.sum(rows).alias("collected_rows"),
    )


def headline(
    latest: DataFrame, predictions: DataFrame, *, key: str, columns: Sequence[str], ids: Sequence[str] = ()
) -> DataFrame:
    """Today's measures with the prediction beside them, a row for each of ``ids`` (as the models) that
    has one; missing predictions show the default."""
    named = predictions.select(key, *ids, *[F.col(c).alias(f"predicted_{c}") for c in columns])
    filled = {
        f"predicted_{c}": F.coalesce(f"predicted_{c}", F.lit(HEADLINE_DEFAULTS.get(c, 0.0))) for c in columns
    }
    return latest.join(named, key, "left").withColumns(filled)


def history_range(df: DataFrame, *, day: str, first: str, last: str, year: str | None = None) -> DataFrame:
    """Days first..last; the comparison reaches the scan.

    ``year`` names the partition column of a store by year; partitions outside are then not read.
    """
    low, high = F.lit(first).cast("date"), F.lit(last).cast("date")
    inside = F.col(day).between(low, high)
    if year:
        inside = inside & F.col(year).between(F.year(low), F.year(high))
    return df.where(inside)


def retention_split(df: DataFrame, *, day: str, as_of: Column, keep_days: int, archive_days: int) -> DataFrame:
    """Mark rows to keep, to archive and to delete by age."""
    age = F.datediff(as_of, F.col(day))
    fate = F.when(age <= keep_days, "keep").when(age <= archive_days, "archive").otherwise("delete")
    return df.withColumn("retention", fate)
