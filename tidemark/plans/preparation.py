"""Clean, derive, validate, split and scale: the way from observations to model input."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..operators.clean import drop_exact_duplicates, interpolate_linear, replace_outliers
from ..operators.features import feature_matrix
from ..operators.split_scale import apply_scaler, fit_scaler, temporal_split
from ..schema import FEATURES, detect_measures, detect_targets
from ..sources.store import stage


def preprocess(
    df: DataFrame,
    *,
    key: str,
    day: str,
    columns: Sequence[str],
    zero_iqr: str = "replace",
    fit_on: Column | None = None,
) -> DataFrame:
    """Daily series: fill gaps, replace outliers by the median, drop repeated rows.

    Only the listed measure columns are touched; calendar columns and codes are not measures.
    """
    filled = interpolate_linear(df, key=key, order=[day], columns=columns)
    fixed = replace_outliers(filled, key=key, columns=columns, zero_iqr=zero_iqr, fit_on=fit_on)
    return drop_exact_duplicates(fixed)


def transform(df: DataFrame, *, key: str, day: str, columns: Sequence[str], **features: object) -> DataFrame:
    """Preprocessing and features of new data in one lazy plan."""
    clean = preprocess(df, key=key, day=day, columns=columns)
    found = detect_measures(clean.select(*columns))
    wanted = {**found, **features}
    return feature_matrix(clean, key=key, day=day, **wanted)


def staged(
    spark: SparkSession, folder: str, raw: DataFrame, *, key: str, day: str, columns: Sequence[str], value: str
) -> DataFrame:
    """raw -> processed -> features as stage tables; a stage that exists is read, not rebuilt."""
    stored = stage(spark, f"{folder}/raw", lambda: raw)
    processed = stage(
        spark, f"{folder}/processed", lambda: preprocess(stored, key=key, day=day, columns=columns)
    )
    return stage(
        spark, f"{folder}/features", lambda: feature_matrix(processed, key=key, day=day, value=value)
    )


@dataclass(frozen=True)
class Prepared:
    """Model input: rows labelled train/test, scaled features, and the scaler that did it."""

    rows: DataFrame
    scaler: DataFrame
    features: list[str]
    targets: list[str]


def prepare(
    matrix: DataFrame,
    *,
    key: str,
    day: str,
    features: Sequence[str] = tuple(FEATURES),
    targets: Sequence[str] | None = None,
    scaler: DataFrame | None = None,
) -> Prepared:
    """Split by time and standardise with statistics of the training part only.

    A scaler fitted earlier may be given; it is then applied unchanged.
    """
    targets = list(targets or detect_targets(matrix))
    complete = matrix.dropna(subset=[*features, *targets])
    split = temporal_split(complete, key=key, order=[day])
    fitted = scaler or fit_scaler(split, key=key, features=features, fit_on=F.col("split") == "train")
    return Prepared(apply_scaler(split, fitted, key=key, features=features), fitted, list(features), targets)
