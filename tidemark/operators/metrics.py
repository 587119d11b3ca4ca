"""Regression metrics over long predictions: one row per (row, target) with y and yhat."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F


def _error(y: str, yhat: str) -> Column:
    return F.col(y).cast("double") - F.col(yhat).cast("double")


def rmse(y: str, yhat: str) -> Column:
    return F.sqrt(F.avg(_error(y, yhat) * _error(y, yhat)))


def mae(y: str, yhat: str) -> Column:
    return F.avg(F.abs(_error(y, yhat)))


def r2(y: str, yhat: str) -> Column:
    """1 - SSE / SST; a constant truth gives 1 for a perfect prediction, else 0."""
    sse = F.sum(_error(y, yhat) * _error(y, yhat))
    sst = F.var_pop(F.col(y).cast("double")) * F.count(y)
    return F.when(sst != 0, 1 - sse / F.nullif(sst, F.lit(0.0))).when(sse == 0, 1.0).when(sse != 0, 0.0)


def mape(y: str, yhat: str) -> Column:
    """Mean absolute percentage error over rows whose true value is not zero."""
    truth = F.col(y).cast("double")
    return F.avg(F.when(truth != 0, F.abs(_error(y, yhat) / F.nullif(truth, F.lit(0.0))))) * 100


def predictions_to_long(df: DataFrame, ids: Sequence[str], targets: Mapping[str, tuple[str, str]]) -> DataFrame:
    """Wide truth/prediction columns to one row per target; NULL pairs are dropped."""
    pairs = F.array(
        *[
            F.struct(
                F.lit(name).alias("target"), F.col(y).cast("double").alias("y"), F.col(p).cast("double").alias("yhat")
            )
            for name, (y, p) in targets.items()
        ]
    )
    return df.select(*ids, F.inline(pairs)).where("y is not null and yhat is not null")


def regression_metrics(df: DataFrame, groups: Sequence[str], y: str = "y", yhat: str = "yhat") -> DataFrame:
    """RMSE, MAE, R2 and the row count per group (model, target, split, ...) in one pass."""
    return df.groupBy(*groups).agg(
        rmse(y, yhat).alias("rmse"), mae(y, yhat).alias("mae"), r2(y, yhat).alias("r2"), F.count("*").alias("n_rows")
    )


def average_over_targets(metrics: DataFrame, groups: Sequence[str]) -> DataFrame:
    """Mean of the per-target metrics: the figures models are compared by."""
    return metrics.groupBy(*groups).agg(
        F.avg("rmse").alias("avg_rmse"), F.avg("mae").alias("avg_mae"), F.avg("r2").alias("avg_r2")
    )


def pooled_rmse(df: DataFrame, groups: Sequence[str], y: str = "y", yhat: str = "yhat") -> DataFrame:
    """Root of the squared error pooled over all targets: the tuning objective."""
    return df.groupBy(*groups).agg(rmse(y, yhat).alias("pooled_rmse"))


def metrics_to_runs(metrics: DataFrame, ids: Sequence[str], names: Sequence[str]) -> DataFrame:
    """Wide metrics to the long run log: ids, metric, value."""
    return metrics.select(*ids, *[F.col(n).cast("double").alias(n) for n in names]).unpivot(
        list(ids), list(names), "metric", "value"
    )


def pivot_runs(runs: DataFrame, ids: Sequence[str], names: Sequence[str] | None = None) -> DataFrame:
    """The run log as one row per run; metric names that are listed spare the job that looks for all of them."""
    if names is None:
        names = [r["metric"] for r in runs.select("metric").distinct().orderBy("metric").collect()]  # a column each
    return runs.groupBy(*ids).pivot("metric", list(names)).agg(F.first("value"))


def rolling_error(df: DataFrame, *, key: str | Sequence[str], day: str, y: str, yhat: str, days: int = 7) -> DataFrame:
    """Mean absolute error of the last ``days`` calendar days per series."""
    from pyspark.sql import Window

    span = Window.partitionBy(key).orderBy(F.unix_date(day)).rangeBetween(-(days - 1), 0)
    return df.withColumn(f"mae_{days}d", F.avg(F.abs(_error(y, yhat))).over(span))


def prediction_band(df: DataFrame, yhat: str, half_width: float | Column = 0.5) -> DataFrame:
    """Lower and upper limit around a prediction."""
    half = F.lit(half_width) if not isinstance(half_width, Column) else half_width
    return df.withColumns({"lower": F.col(yhat) - half, "upper": F.col(yhat) + half})


def join_predictions(actuals: DataFrame, predictions: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Logged predictions beside what was observed later."""
    return actuals.join(predictions, list(keys))
