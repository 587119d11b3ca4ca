"""Data-quality checks, staleness and alerts.  All counts of a frame come from one aggregation."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.scalars import percent, share
from ..schema import numeric_columns
from .clean import count_outliers

# Limits of the validation before training.
MIN_ROWS = 100
MIN_NUMERIC_COLUMNS = 5
MAX_MISSING_SHARE = 0.3

# Monitoring limits.
QUALITY_LIMITS = {"max_null": 0.1, "max_duplicate": 0.05, "max_outlier": 0.05, "min_completeness": 0.9}
ALERT_LIMITS = {"drift": 0.5, "performance_degradation": 0.1, "data_quality": 0.7, "error_rate": 0.05}

# Retraining rhythm in days, and the staleness of a model never trained.
RETRAIN_AFTER = 7
NEVER_TRAINED = 999


def _missing_cells(columns: Sequence[str]) -> Column:
    total = F.lit(0).cast("bigint")
    for c in columns:
        total = total + F.count_if(F.col(f"`{c}`").isNull())
    return total


def completeness(df: DataFrame, *, key: str, columns: Sequence[str]) -> DataFrame:
    """Missing cells and the completeness percentage (one digit) per series."""
    counted = df.groupBy(key).agg(F.count("*").alias("n_rows"), _missing_cells(columns).alias("missing_cells"))
    cells = F.col("n_rows") * len(columns)
    return counted.withColumn(
        "completeness", F.bround(100 - percent(F.col("missing_cells"), F.nullif(cells, F.lit(0))), 1)
    )


def validate_series(df: DataFrame, *, key: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Is a series fit for training: (valid, errors) with the reasons as an array."""
    columns = list(columns or [c for c in df.columns if c != key])
    numeric = [c for c in numeric_columns(df) if c in columns]
    counted = df.groupBy(key).agg(F.count("*").alias("n_rows"), _missing_cells(columns).alias("_missing"))
    missing = share(F.col("_missing"), F.col("n_rows") * len(columns))
    errors = F.array_compact(
        F.array(
            F.when(F.col("n_rows") < MIN_ROWS, F.lit("too few rows")),
            F.when(F.lit(len(numeric)) < MIN_NUMERIC_COLUMNS, F.lit("too few numeric columns")),
            F.when(missing > MAX_MISSING_SHARE, F.lit("too many missing values")),
        )
    )
    return counted.select(key, "n_rows", missing.alias("missing_share"), errors.alias("errors")).withColumn(
        "valid", F.size("errors") == 0
    )


def quality_label(prepared: DataFrame) -> DataFrame:
    """Label a prepared data set by its size and its train/test ratio."""
    total = F.col("train_samples") + F.col("test_samples")
    ratio = F.bround(share(F.col("train_samples"), F.nullif("test_samples", F.lit(0))), 2)
    # Without test rows there is no ratio, and the data set cannot be good.
    label = F.when(total < 1000, "Limited").when(ratio.between(3, 5), "Good").otherwise("Fair")
    return prepared.withColumns(
        {"total_samples": total, "train_test_ratio": ratio, "data_quality_score": label}
    )


def staleness(
    series: DataFrame, trainings: DataFrame, *, key: str, trained_at: str, as_of: Column, threshold: int = RETRAIN_AFTER
) -> DataFrame:
    """Days since the last training, whether to retrain, and the countdown."""
    last = trainings.groupBy(key).agg(F.max(trained_at).alias("_last"))
    days = F.coalesce(F.datediff(as_of, F.col("_last")), F.lit(NEVER_TRAINED))
    return (
        series.join(last, key, "left")
        .withColumn("days_since_training", days)
        .withColumn("should_retrain", F.col("days_since_training") >= threshold)
        .withColumn("next_retrain_in", F.greatest(F.lit(0), threshold - F.col("days_since_training")))
        .drop("_last")
    )


def quality_report(
    df: DataFrame,
    *,
    key: str,
    columns: Sequence[str],
    identity: Sequence[str],
    ranges: Mapping[str, tuple[float, float]],
    limits: Mapping[str, float] = QUALITY_LIMITS,
    daily: bool = True,
) -> DataFrame:
    """Shares of missing, duplicate, out-of-range and outlying values per series, and verdicts.

    Duplicates are rows whose ``identity`` columns repeat within a series.
    """
    out_of_range = F.lit(0).cast("bigint")
    for c, (low, high) in ranges.items():
        out_of_range = out_of_range + F.count_if(~F.col(c).between(low, high))
    facts = df.groupBy(key).agg(
        F.count("*").alias("n_rows"), _missing_cells(columns).alias("_missing"), out_of_range.alias("_outside")
    )
    repeats = (
        df.groupBy(key, *identity)
        .agg(F.count("*").alias("_copies"))
        .groupBy(key)
        .agg(F.sum(F.col("_copies") - 1).alias("_surplus"))
    )
    outliers = (
        count_outliers(df, key=key, columns=columns, daily=daily)
        .groupBy(key)
        .agg(F.sum("n_values").alias("_values"), F.sum("n_outliers").alias("_outliers"))
    )
    rows, cells = F.col("n_rows"), F.col("n_rows") * len(columns)
    return (
        facts.join(repeats, key, "left")
        .join(outliers, key, "left")
        .select(
            key,
            "n_rows",
            share(F.col("_missing"), cells).alias("null_share"),
            share(F.col("_surplus"), rows).alias("duplicate_share"),
            share(F.col("_outside"), rows * max(len(ranges), 1)).alias("out_of_range_share"),
            share(F.coalesce("_outliers", F.lit(0)), F.nullif("_values", F.lit(0))).alias("outlier_share"),
        )
        .withColumns(
            {
                "null_ok": F.col("null_share") <= limits["max_null"],
                "duplicate_ok": F.col("duplicate_share") <= limits["max_duplicate"],
                "range_ok": F.col("out_of_range_share") == 0,
                "outlier_ok": F.coalesce("outlier_share", F.lit(0.0)) <= limits["max_outlier"],
                "completeness_ok": 1 - F.col("null_share") >= limits["min_completeness"],
            }
        )
    )


def alerts(measures: DataFrame, *, kind: str, value: str, limits: Mapping[str, float] = ALERT_LIMITS) -> DataFrame:
    """Monitoring values that crossed their limit; quality alerts when it falls below.

    An unknown value of a kind with a limit is an alert as well.
    """
    limit = F.lit(None).cast("double")
    for name, threshold in limits.items():
        limit = F.when(F.col(kind) == name, F.lit(float(threshold))).otherwise(limit)
    low_is_bad = F.col(kind) == "data_quality"
    reading = F.nanvl(F.col(value).cast("double"), F.lit(None).cast("double"))
    crossed = F.when(low_is_bad, reading < F.col("threshold")).otherwise(reading > F.col("threshold"))
    return measures.withColumn("threshold", limit).where(F.col("threshold").isNotNull() & F.coalesce(crossed, F.lit(True)))
