"""Fitted models on the order series.  Fits are iterative, so most of these have no SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import linear as L, training as T
from tidemark.operators.clean import interpolate_linear
from tidemark.operators.features import feature_matrix
from tidemark.operators.framing import rows_back, series_window
from tidemark.operators.resample import densify_daily
from tidemark.operators.selection import top_importances
from tidemark.operators.split_scale import temporal_split, time_folds
from tidemark.plans.lifecycle import train_run
from tidemark.schema import FEATURES
from tidemark.session import durable, work_path

from . import inputs as I
from .register import query, with_

KEY, DAY = "series_key", "day"
D = "double"
MEASURES = ["value", "high", "low"]
TARGETS = [f"{m}_ahead" for m in MEASURES]


def _training_rows(spark, sf_dir):
    """Features of a day with the next day's measures as labels: no leak."""
    dense = densify_daily(I.daily(spark, sf_dir).select(KEY, DAY, *MEASURES), key=KEY)
    whole = interpolate_linear(dense, key=KEY, order=[DAY], columns=MEASURES)
    rows = feature_matrix(whole, key=KEY, day=DAY, value="value", horizon=1, targets=MEASURES)
    wide = rows.select(KEY, DAY, *[F.col(c).cast(D).alias(c) for c in [*FEATURES, *TARGETS]])
    return temporal_split(wide, key=KEY, order=[DAY])


@query(
    with_(I.READINGS)
    + """SELECT series_key, ROUND(REGR_SLOPE(CAST(value AS DOUBLE), CAST(k AS DOUBLE)), 6) AS slope,
  ROUND(REGR_INTERCEPT(CAST(value AS DOUBLE), CAST(k AS DOUBLE)), 6) AS intercept,
  ROUND(REGR_R2(CAST(value AS DOUBLE), CAST(k AS DOUBLE)), 8) AS r2 FROM readings GROUP BY 1"""
)
def univariate_ols(spark, sf_dir):
    out = T.univariate_ols(
        I.readings(spark, sf_dir), key=KEY, x=F.col("k").cast(D), y=F.col("value").cast(D)
    )
    return out.select(KEY, *[F.round(c, n).alias(c) for c, n in (("slope", 6), ("intercept", 6), ("r2", 8))])


@query()
def train_compare(spark, sf_dir):
    """Three families fitted, measured and scored against each other."""
    rows = _training_rows(spark, sf_dir)
    _, _, scores = train_run(rows, experiment={"run": 1}, features=FEATURES, targets=TARGETS)
    return scores


@query()
def topk_importance(spark, sf_dir):
    """The five most important features of the forest of each target."""
    train = durable(_training_rows(spark, sf_dir).where(F.col("split") == "train"))
    model = T.fit_models(train, family="RandomForest", features=FEATURES, targets=TARGETS)
    weights = T.importances({"RandomForest": model}, spark, features=FEATURES, targets=TARGETS)
    return top_importances(weights, ["model", "target"], k=5)


@query()
def batch_scoring(spark, sf_dir):
    """A saved and reloaded linear model scoring the test rows given as feature maps."""
    rows = durable(_training_rows(spark, sf_dir))
    model = T.fit_models(
        rows.where(F.col("split") == "train"), family="LinearRegression", features=FEATURES, targets=TARGETS
    )
    path = work_path(spark, "model")
    T.save_pipeline(model, path)
    pairs = [x for f in FEATURES for x in (F.lit(f), F.col(f))]
    requests = rows.where(F.col("split") == "test").select(KEY, DAY, F.create_map(*pairs).alias("features_map"))
    scored = T.score_maps(T.load_pipeline(path), requests, features=FEATURES, targets=TARGETS)
    return scored.select(KEY, DAY, *[F.col("predictions")[t].alias(f"{t}_hat") for t in TARGETS])


@query()
def tune_forest(spark, sf_dir):
    """The library's random search, scored on the last fifth of the training rows."""
    train = _training_rows(spark, sf_dir).where(F.col("split") == "train").drop("split")
    tail = temporal_split(train, key=KEY, order=[DAY]).withColumn("is_tail", F.col("split") == "test").drop("split")
    _, outcomes = T.tune_forest(tail, features=FEATURES, targets=TARGETS, valid=F.col("is_tail"))
    return spark.createDataFrame([(i, str(s), e) for i, (s, e) in enumerate(outcomes)], "trial int, setting string, pooled_rmse double")


@query()
def ts_cross_validation(spark, sf_dir):
    """Expanding-window validation of the linear model over five folds."""
    rows = durable(time_folds(_training_rows(spark, sf_dir).drop("split"), key=KEY, order=[DAY]))
    return T.cross_validate(rows, family="LinearRegression", features=FEATURES, targets=TARGETS)


@query(
    with_(*I.SERIES)
    + """SELECT series_key, day, ROUND(20.0::DOUBLE + 5 * SIN(2 * PI() * MONTH(day) / 12) + 0.02::DOUBLE * (YEAR(day) - 2000), 6) AS value_hat
FROM filled"""
)
def fallback_scores(spark, sf_dir):
    """Scoring without any model."""
    rows = I.filled(spark, sf_dir).select(KEY, DAY, F.year(DAY).alias("y"), F.month(DAY).alias("m"))
    out = T.score_or_fallback({}, "RandomForest", rows, ["value"], year="y", month="m")
    return out.select(KEY, DAY, F.round("value_hat", 6).alias("value_hat"))


LABELS = [(t, h) for t in ("value", "week_mean") for h in range(1, 8)]


def _one_feature(spark, sf_dir):
    """The filled series with the mean of seven rows beside the value."""
    window = series_window([KEY], DAY)
    rows = I.filled(spark, sf_dir).withColumn("value", F.col("value").cast(D))
    return rows.withColumns({"now": F.col("value"), "week_mean": F.avg("value").over(rows_back(window, 7))})


ONE_FEATURE = (
    *I.SERIES,
    """one AS (
  SELECT series_key, day, CAST(value AS DOUBLE) AS now, CAST(value AS DOUBLE) AS value,
    AVG(CAST(value AS DOUBLE)) OVER (PARTITION BY series_key ORDER BY day ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS week_mean
  FROM filled)""",
    "ahead AS (SELECT series_key, day, now, "
    + ", ".join(f"LEAD({t}, {h}) OVER (PARTITION BY series_key ORDER BY day) AS {t}_{h}" for t, h in LABELS)
    + " FROM one)",
    """placed AS (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY series_key ORDER BY day) AS rn, COUNT(*) OVER (PARTITION BY series_key) AS n,
    NTILE(5) OVER (PARTITION BY series_key ORDER BY day) AS fold
  FROM ahead WHERE value_7 IS NOT NULL)""",
    "long AS ("
    + " UNION ALL ".join(f"SELECT series_key, rn, n, fold, '{t}' AS target, {h} AS horizon, now AS x, {t}_{h} AS y FROM placed" for t, h in LABELS)
    + ")",
)


@query(
    with_(*ONE_FEATURE)
    + """, fits AS (
  SELECT series_key, target, horizon, COUNT(*) AS n_train, REGR_INTERCEPT(y, x) AS a, REGR_SLOPE(y, x) AS b
  FROM long WHERE rn <= FLOOR(n * 0.8::DOUBLE) GROUP BY 1, 2, 3)
SELECT f.series_key, f.target, f.horizon, MAX(n_train) AS n_train, COUNT(*) AS n_test, ROUND(MAX(a), 4) AS intercept, ROUND(MAX(b), 8) AS slope,
  ROUND(SQRT(AVG(POWER(y - (a + b * x), 2))), 4) AS rmse, ROUND(1 - SUM(POWER(y - (a + b * x), 2)) / (VAR_POP(y) * COUNT(*)), 8) AS r2
FROM fits f JOIN long l USING (series_key, target, horizon) WHERE rn > FLOOR(n * 0.8::DOUBLE) GROUP BY 1, 2, 3"""
)
def models_by_series(spark, sf_dir):
    """A line for each series, target and horizon from one matrix of cross products per series."""
    found = L.models_by_series(
        _one_feature(spark, sf_dir), key=KEY, day=DAY, features=["now"], targets=["value", "week_mean"], horizons=range(1, 8)
    )
    return found.select(
        KEY, "target", "horizon", "n_train", "n_test", F.round("intercept", 4).alias("intercept"),
        F.round(F.col("coefficients")["now"], 8).alias("slope"), F.round("rmse", 4).alias("rmse"), F.round("r2", 8).alias("r2"),
    )


@query(
    with_(*ONE_FEATURE)
    + """, folds AS (SELECT UNNEST(RANGE(2, 6)) AS k),
fits AS (
  SELECT k, series_key, target, horizon, COUNT(*) AS n_train, REGR_INTERCEPT(y, x) AS a, REGR_SLOPE(y, x) AS b
  FROM long JOIN folds ON fold < k GROUP BY 1, 2, 3, 4)
SELECT f.series_key, CAST(f.k AS INTEGER) AS fold, f.target, f.horizon, MAX(n_train) AS n_train, COUNT(*) AS n_test,
  ROUND(SQRT(AVG(POWER(y - (a + b * x), 2))), 4) AS rmse
FROM fits f JOIN long l ON l.fold = f.k AND l.series_key = f.series_key AND l.target = f.target AND l.horizon = f.horizon
GROUP BY 1, 2, 3, 4"""
)
def expanding_validation(spark, sf_dir):
    """Five folds of every series, each scored by the sum of the matrices before it."""
    window = series_window([KEY], DAY)
    rows = _one_feature(spark, sf_dir)
    rows = rows.withColumns({f"{t}:{h}": F.lead(t, h).over(window) for t, h in LABELS}).dropna()
    rows = time_folds(rows, key=KEY, order=[DAY])
    found = L.validate(rows, key=KEY, fold="fold", features=["now"], labels=[f"{t}:{h}" for t, h in LABELS])
    parts = F.split("label", ":")
    return found.select(
        KEY, "fold", F.get(parts, F.lit(0)).alias("target"), F.get(parts, F.lit(1)).cast("int").alias("horizon"),
        "n_train", "n_test", F.round("rmse", 4).alias("rmse"),
    )


@query()
def forecasts_by_series(spark, sf_dir):
    """All features, three targets and seven horizons for every series: coefficients and test errors."""
    dense = densify_daily(I.daily(spark, sf_dir).select(KEY, DAY, *MEASURES), key=KEY)
    whole = interpolate_linear(dense, key=KEY, order=[DAY], columns=MEASURES)
    rows = feature_matrix(whole, key=KEY, day=DAY, value="value")
    rows = rows.select(KEY, DAY, *[F.col(c).cast(D).alias(c) for c in [*FEATURES, *MEASURES]])
    return L.models_by_series(rows, key=KEY, day=DAY, features=FEATURES, targets=MEASURES, horizons=range(1, 8))
