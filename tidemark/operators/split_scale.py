"""Time-ordered train/test splits, folds and standardisation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import durable
from .framing import series_window, with_positions

# Fixed value: share of the rows, in time order, that trains the models.
SPLIT_RATIO = 0.8


def temporal_split(df: DataFrame, *, key: str, order: Sequence[str], ratio: float = SPLIT_RATIO) -> DataFrame:
    """Label the first ``floor(n * ratio)`` days of each daily series ``train``, the rest ``test``."""
    placed = df.withColumns(
        {
            "_row": F.row_number().over(series_window([key], order)),
            "_n": F.count("*").over(Window.partitionBy(key)),
        }
    )
    label = F.when(F.col("_row") <= F.floor(F.col("_n") * F.lit(float(ratio))), "train").otherwise("test")
    return placed.withColumn("split", label).drop("_row", "_n")


def temporal_split_raw(
    df: DataFrame, *, key: str, order: Sequence[str], ratio: float = SPLIT_RATIO, bucket: str = "hour"
) -> DataFrame:
    """The same split for raw readings of any number, without sorting them.

    Readings are counted per (series, time bucket); running counts of that small table name the
    bucket the cut falls into.  Rows of other buckets are labelled by comparison, only the
    cutting bucket's rows are ranked (block by block).  ``order[0]`` is the timestamp, the rest
    breaks ties.
    """
    at = F.date_trunc(bucket, order[0])
    counts = df.groupBy(key, at.alias("_cutoff")).agg(F.count("*").alias("_rows"))
    by_time = Window.partitionBy(key).orderBy("_cutoff").rowsBetween(Window.unboundedPreceding, 0)
    cut = F.floor(F.col("_n") * F.lit(float(ratio)))
    placed = counts.withColumns(
        {"_upto": F.sum("_rows").over(by_time), "_n": F.sum("_rows").over(Window.partitionBy(key))}
    )
    cutting = placed.where((cut > F.col("_upto") - F.col("_rows")) & (cut <= F.col("_upto")))
    # One row per series; a series too short for a training row has none.
    cutting = durable(cutting.select(key, "_cutoff", (cut - F.col("_upto") + F.col("_rows")).alias("_take")))

    joined = df.join(cutting, key, "left")
    decided = joined.where(F.col("_cutoff").isNull() | (at != F.col("_cutoff")))
    decided = decided.withColumn("split", F.when(at < F.col("_cutoff"), "train").otherwise("test"))
    ranked = with_positions(joined.where(at == F.col("_cutoff")), [key], order, "_row")
    ranked = ranked.withColumn("split", F.when(F.col("_row") <= F.col("_take"), "train").otherwise("test"))
    return decided.unionByName(ranked.drop("_row")).drop("_cutoff", "_take")


def split_by_date(df: DataFrame, *, day: str, first_test_day: str) -> DataFrame:
    """Label rows before the given day ``train`` and the others ``test``."""
    return df.withColumn("split", F.when(F.col(day) < F.lit(first_test_day).cast("date"), "train").otherwise("test"))


def time_folds(df: DataFrame, *, key: str, order: Sequence[str], folds: int = 5) -> DataFrame:
    """Contiguous folds of nearly equal size in time order: train on folds < k, test on k."""
    return df.withColumn("fold", F.ntile(folds).over(series_window([key], order)))


def fit_scaler(df: DataFrame, *, key: str, features: Sequence[str], fit_on: Column | None = None) -> DataFrame:
    """Mean and population deviation of every feature: one aggregation, one row per series."""
    fitted = df if fit_on is None else df.where(fit_on)
    stats = []
    for f in features:
        stats += [F.avg(F.col(f).cast("double")).alias(f"mean_{f}"), F.stddev_pop(F.col(f).cast("double")).alias(f"std_{f}")]
    return fitted.groupBy(key).agg(*stats)


def apply_scaler(df: DataFrame, scaler: DataFrame, *, key: str, features: Sequence[str]) -> DataFrame:
    """Standardise with a fitted scaler; a constant feature is only centred."""
    scaled = {}
    for f in features:
        spread = F.when(F.col(f"std_{f}") == 0, 1.0).otherwise(F.col(f"std_{f}"))
        scaled[f] = (F.col(f).cast("double") - F.col(f"mean_{f}")) / spread
    return df.join(scaler, key).withColumns(scaled).select(*df.columns)
