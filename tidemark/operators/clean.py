"""Cleaning of observation series: gaps, outliers, duplicates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..session import durable
from .framing import nearest_known, series_window, with_positions
from .quantiles import COLUMN, daily_quantiles, raw_quantiles, to_long

# Fixed value: how many inter-quartile ranges beyond the quartiles a value may lie.
IQR_FACTOR = 3.0
QUARTILES = (0.25, 0.5, 0.75)


def interpolate_linear(
    df: DataFrame, *, key: str, order: Sequence[str], columns: Sequence[str], blocks: bool = False
) -> DataFrame:
    """Fill gaps linearly by row position; leading and trailing gaps take the nearest value.

    ``blocks=True`` handles series too long for one task (see ``framing``).
    """
    if blocks:
        out = with_positions(df, [key], order, "_row", keep_block=True)
    else:
        out = df.withColumn("_row", F.row_number().over(series_window([key], order)).cast("bigint"))
    known = {}
    for i, name in enumerate(columns):
        here = F.struct(F.col("_row").alias("at"), F.col(name).cast("double").alias("v"))
        known[f"_known{i}"] = F.when(F.col(name).isNotNull(), here)
    out = nearest_known(out, [key], order, known, blocks=blocks)
    filled = {}
    for i, name in enumerate(columns):
        low, high = F.col(f"_known{i}_before"), F.col(f"_known{i}_after")
        reach = F.nullif(high["at"] - low["at"], F.lit(0)).cast("double")
        between = low["v"] + (high["v"] - low["v"]) / reach * (F.col("_row") - low["at"]).cast("double")
        filled[name] = F.coalesce(F.col(name).cast("double"), between, low["v"], high["v"])
    return out.withColumns(filled).select(*df.columns)


def fill_forward_backward(df: DataFrame, *, key: str, order: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Take the last known value, and before the first known value the next one."""
    known = {f"_known{i}": F.col(name) for i, name in enumerate(columns)}
    out = nearest_known(df, [key], list(order), known)
    filled = {n: F.coalesce(f"_known{i}_before", f"_known{i}_after") for i, n in enumerate(columns)}
    return out.withColumns(filled).select(*df.columns)


def iqr_bounds(
    df: DataFrame,
    *,
    key: str,
    columns: Sequence[str],
    factor: float = IQR_FACTOR,
    daily: bool = True,
    fit_on: Column | None = None,
) -> DataFrame:
    """Quartiles, median and outlier limits: one row per (series, column).

    ``fit_on`` restricts the rows the limits are learned from (for instance the training
    part).  ``daily=False`` is the plan for raw readings with groups of any size.
    """
    fitted = df if fit_on is None else df.where(fit_on)
    quantiles = (daily_quantiles if daily else raw_quantiles)(fitted, [key], columns, QUARTILES)
    q1, median, q3 = (F.col("quantiles")[i] for i in range(3))
    spread = (q3 - q1) * F.lit(float(factor))
    return quantiles.select(
        key,
        COLUMN,
        q1.alias("q1"),
        median.alias("median"),
        q3.alias("q3"),
        (q1 - spread).alias("lower"),
        (q3 + spread).alias("upper"),
    )


def _bounds_per_series(bounds: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """One row per series with a struct of limits per column."""
    limits = F.struct("lower", "upper", "median", "q1", "q3")
    return bounds.groupBy(key).agg(
        *[F.max(F.when(F.col(COLUMN) == c, limits)).alias(f"_limits_{i}") for i, c in enumerate(columns)]
    )


def _is_outlier(value: Column, limits: str, zero_iqr: str) -> Column:
    outside = (value < F.col(f"{limits}.lower")) | (value > F.col(f"{limits}.upper"))
    if zero_iqr == "skip":  # a column that hardly varies has no usable limits
        outside = outside & (F.col(f"{limits}.q1") != F.col(f"{limits}.q3"))
    elif zero_iqr != "replace":
        raise ValueError("zero_iqr is 'replace' or 'skip'")
    return F.coalesce(outside, F.lit(False))


def replace_outliers(
    df: DataFrame,
    *,
    key: str,
    columns: Sequence[str],
    bounds: DataFrame | None = None,
    zero_iqr: str = "replace",
    **fit: object,
) -> DataFrame:
    """Replace values strictly outside the limits by the series' median.

    The limits have one row per series and join on the key.
    """
    bounds = bounds if bounds is not None else iqr_bounds(df, key=key, columns=columns, **fit)
    limits = _bounds_per_series(bounds, key, columns)
    # Raw rows must not be shuffled by series just to meet one row of limits each: stored
    # limits have a known size and are broadcast when small.  Daily rows are partitioned by
    # series already.
    joined = df.join(limits if fit.get("daily", True) else durable(limits), [key], "left")
    fixed = {}
    for i, name in enumerate(columns):
        value, limits = F.col(name).cast("double"), f"_limits_{i}"
        fixed[name] = F.when(_is_outlier(value, limits, zero_iqr), F.col(f"{limits}.median")).otherwise(value)
    return joined.withColumns(fixed).select(*df.columns)


def count_outliers(
    df: DataFrame,
    *,
    key: str,
    columns: Sequence[str],
    bounds: DataFrame | None = None,
    zero_iqr: str = "replace",
    **fit: object,
) -> DataFrame:
    """Outliers per (series, column), with the number of readings looked at."""
    bounds = bounds if bounds is not None else iqr_bounds(df, key=key, columns=columns, **fit)
    limits = bounds.select(key, COLUMN, F.struct("lower", "upper", "q1", "q3").alias("_limits"))
    limits = limits if fit.get("daily", True) else durable(limits)
    readings = to_long(df, [key], columns).join(limits, [key, COLUMN])
    return readings.groupBy(key, COLUMN).agg(
        F.count("*").alias("n_values"),
        F.count_if(_is_outlier(F.col("_value"), "_limits", zero_iqr)).alias("n_outliers"),
    )


def drop_exact_duplicates(df: DataFrame) -> DataFrame:
    """Remove rows equal in every column (aggregated per task before the shuffle)."""
    return df.dropDuplicates()


def count_exact_duplicates(df: DataFrame) -> DataFrame:
    """Rows, distinct rows and surplus rows, in one pass over the grouped rows."""
    copies = df.groupBy(*df.columns).agg(F.count("*").alias("_copies"))
    return copies.agg(
        F.coalesce(F.sum("_copies"), F.lit(0)).alias("n_rows"),
        F.count("*").alias("n_distinct"),
        F.coalesce(F.sum(F.col("_copies") - 1), F.lit(0)).alias("n_duplicates"),
    )


def keep_last(df: DataFrame, *, keys: Sequence[str], priority: Sequence[str]) -> DataFrame:
    """One row per key: the one with the greatest priority.

    ``max_by`` combines partially before the shuffle, so many versions of one key
    never meet in a single window partition.
    """
    rest = [c for c in df.columns if c not in keys]
    best = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*priority)).alias("_row"))
    return best.select(*keys, "_row.*").select(*df.columns)


def drop_incomplete(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Keep rows where every listed column is known."""
    return df.dropna(subset=list(columns))
