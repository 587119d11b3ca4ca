"""Fits per series, horizon and fold against numpy's least squares."""

import datetime

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.operators import linear as L
from tidemark.operators.features import feature_matrix
from tidemark.operators.split_scale import time_folds
from tidemark.schema import FEATURES


@pytest.fixture(scope="module")
def observed(spark):
    draw = np.random.default_rng(4)
    start, rows = datetime.date(2019, 3, 1), []
    for k in range(3):
        noise = np.cumsum(draw.normal(size=500)) * 0.3
        for i in range(500):
            value = 20 + 8 * np.sin(i / 58 + k) + noise[i]
            rows.append((f"s{k}", start + datetime.timedelta(days=i), float(value), float(value + draw.normal())))
    return spark.createDataFrame(rows, "series_key string, day date, value double, high double")


@pytest.fixture(scope="module")
def matrix(observed):
    rows = feature_matrix(observed, key="series_key", day="day", value="value")
    return rows.select("series_key", "day", "value", "high", *[F.col(f).cast("double").alias(f) for f in FEATURES]).cache()


def _least_squares(x, y, x_new, y_new):
    design, scale = np.c_[np.ones(len(x)), (x - x.mean(axis=0))], np.where(x.std(axis=0) > 0, x.std(axis=0), 1)
    design[:, 1:] /= scale
    found = np.linalg.lstsq(design, y, rcond=1e-9)[0]
    guess = np.c_[np.ones(len(x_new)), (x_new - x.mean(axis=0)) / scale] @ found
    return np.sqrt(((guess - y_new) ** 2).mean(axis=0))


def _ahead(frame, horizons):
    out = {}
    for name, part in frame.toPandas().sort_values("day").groupby("series_key"):
        for t in ("value", "high"):
            for h in horizons:
                part[f"{t}:{h}"] = part[t].shift(-h)
        out[name] = part.dropna()
    return out


def test_all_features_targets_and_horizons(matrix):
    found = L.models_by_series(matrix, key="series_key", day="day", features=FEATURES, targets=["value", "high"], horizons=range(1, 8))
    rows = found.collect()
    assert len(rows) == 3 * 2 * 7
    plain = _ahead(matrix, range(1, 8))
    for r in rows:
        part, label = plain[r["series_key"]], f"{r['target']}:{r['horizon']}"
        cut = int(np.floor(len(part) * 0.8))
        x, y = part[list(FEATURES)].to_numpy(), part[label].to_numpy()
        assert (r["n_train"], r["n_test"]) == (cut, len(part) - cut)
        assert r["rmse"] == pytest.approx(_least_squares(x[:cut], y[:cut], x[cut:], y[cut:]), rel=1e-5)
        guess = r["intercept"] + x[cut:] @ np.array([r["coefficients"][f] for f in FEATURES])
        assert np.sqrt(((guess - y[cut:]) ** 2).mean()) == pytest.approx(r["rmse"], rel=1e-6)
        assert r["r2"] == pytest.approx(1 - ((guess - y[cut:]) ** 2).sum() / ((y[cut:] - y[cut:].mean()) ** 2).sum(), abs=1e-6)


def test_folds_equal_separate_fits(matrix):
    labels = ["value:1", "high:1"]
    folds = time_folds(matrix, key="series_key", order=["day"])
    rows = folds.withColumns({"value:1": F.col("value"), "high:1": F.col("high")})
    features = ["f_lag_1", "f_ma_7", "f_ma_30", "f_month_sin", "f_day_of_year"]
    found = {(r["series_key"], r["fold"], r["label"]): r for r in L.validate(rows, key="series_key", fold="fold", features=features, labels=labels).collect()}
    assert len(found) == 3 * 4 * 2
    for key, part in folds.toPandas().sort_values("day").groupby("series_key"):
        for k in range(2, 6):
            before, own = part[part.fold < k], part[part.fold == k]
            for label in labels:
                t = label.split(":")[0]
                want = _least_squares(before[features].to_numpy(), before[t].to_numpy(), own[features].to_numpy(), own[t].to_numpy())
                assert found[key, k, label]["rmse"] == pytest.approx(want, rel=1e-8)
                assert found[key, k, label]["n_train"] == len(before)


def test_constant_and_repeated_features(spark):
    rows = [("a", i, float(i % 7), 3.0, 2.0 * (i % 7), 1.0 + 5.0 * (i % 7)) for i in range(40)]
    df = spark.createDataFrame(rows, "series_key string, i int, x double, flat double, twice double, y double")
    df = df.withColumn("fold", F.when(F.col("i") < 30, 1).otherwise(2)).withColumn("none", F.lit(4.0))
    found = {r["label"]: r for r in L.validate(df, key="series_key", fold="fold", features=["x", "flat", "twice"], labels=["y", "none"]).collect()}
    y = found["y"]
    assert y["rmse"] == pytest.approx(0, abs=1e-6) and y["r2"] == pytest.approx(1) and y["intercept"] == pytest.approx(1)
    assert y["coefficients"]["x"] == pytest.approx(5) and y["coefficients"]["flat"] == y["coefficients"]["twice"] == 0
    assert (found["none"]["rmse"], found["none"]["r2"]) == (0.0, 1.0)


def test_one_shuffle_by_series(spark):
    """Windows, split and sums share one partitioning of the rows."""
    df = spark.range(100).selectExpr("cast(id % 3 as string) as series_key", "id as day", "cast(id as double) as x", "cast(id * id as double) as y")
    found = L.models_by_series(df, key="series_key", day="day", features=["x"], targets=["y"], horizons=[1, 2])
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = found._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert plan.count("Exchange hashpartitioning") == 1


def test_short_series_and_missing_values(spark):
    df = spark.createDataFrame([("a", 1, 1.0, 2.0), ("b", 1, None, 2.0), ("b", 2, 3.0, 4.0), ("b", 3, 4.0, 5.0)], "series_key string, fold int, x double, y double")
    found = L.validate(df, key="series_key", fold="fold", features=["x"], labels=["y"]).collect()
    assert [(r["series_key"], r["fold"], r["n_train"], r["n_test"]) for r in found] == [("b", 3, 1, 1)]
    assert L.validate(df.where("false"), key="series_key", fold="fold", features=["x"], labels=["y"]).count() == 0
