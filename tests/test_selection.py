"""Comparison, gate and registry, with figures of published training runs as expectations."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.functions import scalars as X
from tidemark.operators import metrics as M
from tidemark.operators import quality as Q
from tidemark.operators import registry as R
from tidemark.operators import selection as S
from tidemark.plans.lifecycle import decide, register

# Published averages (RMSE, R2, MAE) and training seconds of three models.
PUBLISHED = [
    ("LinearRegression", 0.9835629860206653, 0.958132211106686, 0.7578885107963407, 8.362539052963257),
    ("GradientBoosting", 1.196650448197966, 0.9536013687983561, 0.9334135467957817, 12.782554864883423),
    ("RandomForest", 1.3462500194306566, 0.9479969881715306, 1.0544524412019236, 88.97497916221619),
]
COLUMNS = "run int, model string, avg_rmse double, avg_r2 double, avg_mae double, training_seconds double, test_rows int"


@pytest.fixture(scope="module")
def published(spark):
    return spark.createDataFrame([(1, *r, 441) for r in PUBLISHED], COLUMNS)


def by_model(df, *names):
    return {r.model: tuple(r[n] for n in names) for r in df.collect()}


def test_composite_scores(published):
    got = by_model(S.composite_scores(published, ["run"]), "composite_score")
    assert math.isclose(got["LinearRegression"][0], 100.0)
    assert math.isclose(got["GradientBoosting"][0], 50.70229691160842)
    assert math.isclose(got["RandomForest"][0], 0.0, abs_tol=1e-9)
    assert S.select_composite(S.composite_scores(published, ["run"]), ["run"]).first().model == "LinearRegression"


def test_equal_metrics_and_unknown_times_score_full(spark):
    df = spark.createDataFrame([(1, "a", 1.0, 0.9, 1.0, None, 5), (1, "b", 1.0, 0.9, 1.0, None, 5)], COLUMNS)
    got = by_model(S.composite_scores(df, ["run"]), "composite_score")
    assert all(math.isclose(v[0], 100) for v in got.values())
    assert S.select_composite(S.composite_scores(df, ["run"]), ["run"]).first().model == "a"


def test_simple_selection(spark):
    rows = [(1, "Model1", 1.5, 0.95, 1.0, 1.0, 1), (1, "Model2", 1.2, 0.97, 0.8, 1.0, 1), (1, "Model3", 2.0, 0.9, 1.5, 1.0, 1)]
    assert S.select_simple(spark.createDataFrame(rows, COLUMNS), ["run"]).first().best_model == "Model2"


def test_summary_gaps_and_ranking(published):
    grades = by_model(S.performance_summary(published), "performance_grade", "test_rmse")
    assert grades == {
        "LinearRegression": ("A+ (Excellent)", 0.9836),
        "GradientBoosting": ("A+ (Excellent)", 1.1967),
        "RandomForest": ("A (Très bon)", 1.3463),
    }
    gaps = by_model(S.performance_gaps(published, ["run"]), "rmse_gap_percent", "r2_gap_percent")
    assert gaps == {"LinearRegression": (0, 0), "GradientBoosting": (21.66, 0.47), "RandomForest": (36.87, 1.06)}
    ranks = by_model(S.rank_models(published, ["run"]), "rank_rmse", "rank_r2")
    assert ranks == {"LinearRegression": (1, 1), "GradientBoosting": (2, 2), "RandomForest": (3, 3)}


def test_gap_to_a_best_that_is_not_positive_is_zero(spark):
    df = spark.createDataFrame([(1, "a", 0.0, -1.0, 1.0, 1.0, 1), (1, "b", 2.0, -2.0, 1.0, 1.0, 1)], COLUMNS)
    gaps = by_model(S.performance_gaps(df, ["run"]), "rmse_gap_percent", "r2_gap_percent")
    assert set(gaps.values()) == {(0.0, 0.0)}


def gated(spark, rows, **kw):
    results = spark.createDataFrame([("s", *r) for r in rows], "series string, " + COLUMNS)
    return decide(S.composite_scores(results, ["series", "run"]), series=["series"], run="run", **kw)


def gate(spark, rows, **kw):
    return gated(spark, rows, **kw).orderBy("run").collect()


def test_gate_first_run_passes(spark):
    first = gate(spark, [(1, *r, 441) for r in PUBLISHED])[0]
    assert first.should_deploy and first.ok_first and first.ok_rmse_gain is None
    assert len(first.reasons) == 3


def test_gate_compares_with_the_run_before(spark):
    better = (2, "LinearRegression", 0.8, 0.99, 0.7, 1.0, 441)
    same = (3, "LinearRegression", 0.8, 0.99, 0.7, 1.0, 441)
    few = (4, "LinearRegression", 0.1, 0.9999, 0.1, 1.0, 50)
    decided = gated(spark, [(1, *PUBLISHED[0], 441), better, same, few])
    runs = decided.orderBy("run").collect()
    assert [r.should_deploy for r in runs] == [True, True, False, False]
    assert runs[1].ok_rmse_gain and runs[1].ok_r2_gain
    assert not runs[2].ok_rmse_gain
    assert not runs[3].ok_rows and "rows:missed" in runs[3].reasons
    core = S.deployment_gate(decided.where("run = 3"), require_all=False).first()
    assert core.should_deploy  # performance and row count alone


def test_gate_extra_checks(spark):
    slow = gate(spark, [(1, "m", 1.0, 0.9, 1.0, 4000.0, 441)], extra=True)[0]
    assert not slow.ok_time and not slow.should_deploy


def test_previous_run_without_metrics_gives_no_gain_check(spark):
    runs = gate(spark, [(1, "m", None, None, None, 1.0, 441), (2, "m", 1.0, 0.9, 1.0, 1.0, 441)])
    assert runs[1].ok_rmse_gain is None and runs[1].ok_first is None and runs[1].should_deploy


def test_recommendations(spark):
    best = gated(spark, [(1, *r, 441) for r in PUBLISHED])
    out = S.recommendations(best, ["LinearRegression"], ["RandomForest", "GradientBoosting"]).first()
    assert out.recommendations == [
        "quality:excellent", "deploy:yes", "family:linear",
    ]


def test_quality_label(spark):
    df = spark.createDataFrame([(1760, 441), (500, 100), (2000, 1000)], "train_samples int, test_samples int")
    got = [(r.total_samples, r.train_test_ratio, r.data_quality_score) for r in Q.quality_label(df).collect()]
    assert got == [(2201, 3.99, "Good"), (600, 5.0, "Limited"), (3000, 2.0, "Fair")]


def test_versions_and_promotion(spark):
    versions = spark.createDataFrame(
        [("m", "r1", True, 1, "Production"), ("n", "r1", True, 1, "Production")],
        "model string, run_id string, approved boolean, version int, stage string",
    )
    decided = spark.createDataFrame(
        [("m", "r2", True), ("m", "r3", False), ("n", "r2", False), ("new", "r1", True)],
        "model string, run string, should_deploy boolean",
    )
    snapshot = register(versions, decided, model=["model"], run="run")
    got = {(r.model, r.version): r.stage for r in snapshot.collect()}
    assert got == {
        ("m", 1): "Archived", ("m", 2): "Production", ("m", 3): "None",
        ("n", 1): "Production", ("n", 2): "None", ("new", 1): "Production",
    }
    serving = {r.model: r.version for r in R.production_version(snapshot, ["model"]).collect()}
    assert serving == {"m": 2, "n": 1, "new": 1}
    listed = {(r.model, r.stage): r.latest_version for r in R.list_models(snapshot, ["model"]).collect()}
    assert listed[("m", "Archived")] == 1


def test_metrics_equal_numpy(spark):
    rng = np.random.default_rng(7)
    y, p = rng.normal(20, 5, (130, 3)), rng.normal(20, 5, (130, 3))
    rows = [
        (i, "train" if i < 100 else "test", f"t{j}", float(y[i, j]), float(p[i, j])) for i in range(130) for j in range(3)
    ]
    df = spark.createDataFrame(rows, "row_id int, split string, target string, y double, yhat double")
    got = {(r.split, r.target): r for r in M.regression_metrics(df, ["split", "target"]).collect()}
    e = y[100:, 1] - p[100:, 1]
    r = got[("test", "t1")]
    assert np.allclose(
        [r.rmse, r.mae, r.r2],
        [np.sqrt((e**2).mean()), np.abs(e).mean(), 1 - (e**2).sum() / ((y[100:, 1] - y[100:, 1].mean()) ** 2).sum()],
    )
    pooled = {r.split: r.pooled_rmse for r in M.pooled_rmse(df, ["split"]).collect()}
    assert math.isclose(pooled["train"], np.sqrt(((y - p)[:100] ** 2).mean()))
    averages = M.average_over_targets(M.regression_metrics(df, ["split", "target"]), ["split"]).count()
    assert averages == 2


def test_r2_of_constant_truth(spark):
    rows = [("perfect", 1.0, 1.0), ("perfect", 1.0, 1.0), ("wrong", 1.0, 2.0), ("wrong", 1.0, 1.0)]
    df = spark.createDataFrame(rows, "model string, y double, yhat double")
    got = by_model(M.regression_metrics(df, ["model"]), "r2")
    assert got == {"perfect": (1.0,), "wrong": (0.0,)}


def test_mape_skips_zero_truth(spark):
    df = spark.createDataFrame([(0.0, 5.0), (2.0, 1.0)], "y double, yhat double")
    assert df.agg(M.mape("y", "yhat")).first()[0] == 50.0


def test_run_log_round_trip(spark, published):
    runs = M.metrics_to_runs(published, ["run", "model"], ["avg_rmse", "avg_r2"])
    back = M.pivot_runs(runs, ["run", "model"], ["avg_rmse", "avg_r2"])
    assert runs.count() == 6 and back.count() == 3
    best = S.best_run(back.withColumn("family", F.lit("all")), ["family"], "avg_rmse", "model").first()
    assert best.best_run == "LinearRegression"


def test_scalars(spark):
    df = spark.createDataFrame([("Test RMSE (temp/max)", "2024-03-05T06:07:08Z", {"b": 2.0})], "name string, at string, m map<string,double>")
    row = df.select(
        X.clean_metric_name(F.col("name")).alias("clean"),
        X.parse_iso_timestamp(F.col("at")).cast("string").alias("at"),
        X.parse_iso_timestamp(F.lit("2024-03-05 nonsense")).cast("string").alias("fallback"),
        X.vector_values(F.col("m"), ["a", "b"]).alias("vector"),
        X.season_fallback(F.lit(2024), F.lit(6)).alias("forecast"),
    ).first()
    assert row.clean == "Test_RMSE_temp_max"
    assert row["at"] == "2024-03-05 06:07:08" and row.fallback == "2024-03-05 00:00:00"
    assert row.vector == [0.0, 2.0] and math.isclose(row.forecast, 20.48)
    named = df.select(X.name_predictions(F.array(F.lit(1.0), F.lit(2.0)), None, 2).alias("p")).first().p
    assert named == {"target_0": 1.0, "target_1": 2.0}


def test_aliases(spark):
    df = spark.createDataFrame([(None, 3.0)], "`temp (°C)` double, temp double")
    out = X.resolve_aliases(df, {"t": ["temp (°C)", "temp"], "u": ["none"]}).first()
    assert (out.t, out.u) == (0.0, 0.0)  # the first present name wins, its NULL becomes the default


@pytest.mark.parametrize("missing", [None, float("nan")])
def test_a_model_without_metrics_is_never_chosen(spark, missing):
    rows = [("e", "broken", missing, missing, missing, 1.0), ("e", "sound", 2.0, 0.8, 1.5, 9.0)]
    results = spark.createDataFrame(rows, "x string, model string, avg_rmse double, avg_r2 double, avg_mae double, training_seconds double")
    assert S.select_simple(results, ["x"]).first().best_model == "sound"
    assert S.best_run(results, ["x"], "avg_rmse", "model").first().best_run == "sound"
    scores = S.composite_scores(results, ["x"])
    assert S.select_composite(scores, ["x"]).first().model == "sound"
    ranks = {r.model: (r.rank_rmse, r.rank_r2) for r in S.rank_models(results, ["x"]).collect()}
    assert ranks == {"sound": (1, 1), "broken": (2, 2)}
    alone = S.select_composite(S.composite_scores(results.where("model = 'broken'"), ["x"]), ["x"])
    assert alone.first().model is None


@pytest.mark.parametrize("missing", [None, float("nan")])
@pytest.mark.parametrize("field", ["avg_r2", "test_rows", "training_seconds"])
def test_the_gate_refuses_what_is_unknown(spark, field, missing):
    row = {"avg_rmse": 1.0, "avg_r2": 0.9, "test_rows": 500.0, "training_seconds": 10.0, "composite_score": 90.0}
    row |= {"has_previous": False, "previous_rmse": None, "previous_r2": None, "previous_score": None}
    schema = ", ".join(f"{k} {'boolean' if k == 'has_previous' else 'double'}" for k in row)

    def gated(r):
        return S.deployment_gate(spark.createDataFrame([tuple(r.values())], schema), extra=True).first()

    assert gated(row).should_deploy
    assert not gated(row | {field: missing}).should_deploy
