"""Model fits timed by bench.py: one daily series, the full feature list, three targets."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.operators.features import feature_matrix
from tidemark.operators.resample import daily_rollup, densify_daily
from tidemark.operators.split_scale import temporal_split
from tidemark.operators.training import evaluate, fit_models, score
from tidemark.plans.preparation import preprocess
from tidemark.schema import FEATURES
from tidemark.session import durable

from . import inputs as I

FAMILIES = ["LinearRegression", "GradientBoosting", "RandomForest"]
TARGETS = ["value", "high", "low"]


def training_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All orders as one daily series (about as many days as the published runs had)."""
    prices = I.read(spark, sf_dir, "orders").select(
        F.lit("all").alias("series_key"), F.col("o_orderdate").alias("ts"), F.col("o_totalprice").alias("price")
    )
    rules = {"value": ("mean", "price"), "high": ("max", "price"), "low": ("min", "price")}
    days = densify_daily(daily_rollup(prices, key="series_key", ts="ts", rules=rules), key="series_key")
    clean = preprocess(days, key="series_key", day="day", columns=TARGETS)
    matrix = feature_matrix(clean, key="series_key", day="day", value="value", targets=TARGETS)
    return durable(temporal_split(matrix, key="series_key", order=["day"]))


def fit(rows: DataFrame, family: str) -> list:
    """Fit with the library's default settings, score both splits, measure."""
    model = fit_models(rows.where("split = 'train'"), family=family, features=FEATURES, targets=TARGETS)
    return evaluate(score(model, rows, TARGETS), ["split"], TARGETS).collect()
