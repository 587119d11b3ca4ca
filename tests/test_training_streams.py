import json

import numpy as np
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from tidemark.operators import training as T
from tidemark.operators.features import feature_matrix
from tidemark.operators.selection import top_importances
from tidemark.operators.split_scale import temporal_split, time_folds
from tidemark.plans.lifecycle import train_run
from tidemark.plans.preparation import prepare, staged, transform
from tidemark.plans.stages import SeriesFeatures
from tidemark.schema import FEATURES
from tidemark.session import work_path
from tidemark.sources import store
from tidemark.streaming import pipelines as L

SMALL = {"RandomForest": {"numTrees": 8, "maxDepth": 6}, "GradientBoosting": {"maxIter": 8, "maxDepth": 4}}
NAMES = ["f_lag_1", "f_lag_7", "f_ma_7", "f_diff_1", "f_day_of_year_sin", "f_day_of_year_cos"]


@pytest.fixture(scope="module")
def yearly(spark, series):
    """Three years of a noisy seasonal series."""
    rng = np.random.default_rng(5)
    days = np.arange(1100)
    return series({"a": 20 + 10 * np.sin(2 * np.pi * days / 365) + rng.normal(0, 1, len(days))})


@pytest.fixture(scope="module")
def rows(yearly):
    matrix = feature_matrix(yearly, key="series_key", day="day", value="value", horizon=1, targets=["value"])
    return temporal_split(matrix, key="series_key", order=["day"]).cache()


@pytest.fixture(scope="module")
def run(rows):
    return train_run(rows, experiment={"run": 1}, features=NAMES, targets=["value_ahead"], params=SMALL)


def test_models_learn_and_are_ranked(run):
    models, metrics, scores = run
    test = {r.model: r for r in metrics.where("split = 'test'").collect()}
    assert set(test) == {"LinearRegression", "GradientBoosting", "RandomForest"}
    assert all(r.r2 > 0.7 and r.rmse < 4 for r in test.values())
    best = scores.orderBy(F.desc("composite_score")).first()
    assert best.model in models and 0 <= best.composite_score <= 100 and best.test_rows >= 100


def test_leak_without_horizon_and_none_with(yearly, run):
    leaky = temporal_split(feature_matrix(yearly, key="series_key", day="day", value="value", targets=["value"]), key="series_key", order=["day"])
    model = T.fit_models(leaky.where("split = 'train'"), family="LinearRegression", features=NAMES, targets=["value"])
    same_day = T.evaluate(T.score(model, leaky, ["value"]), ["split"], ["value"]).where("split = 'test'").first()
    assert same_day.rmse < 1e-3
    ahead = run[1].where("split = 'test' and model = 'LinearRegression'").first()
    assert ahead.rmse > 0.5


def test_importances(spark, run):
    weights = T.importances(run[0], spark, features=NAMES, targets=["value_ahead"])
    assert weights.count() == 2 * len(NAMES)  # the linear model has none
    top = top_importances(weights, ["model", "target"], k=2)
    assert top.count() == 4 and {r["rank"] for r in top.collect()} == {1, 2}


def test_saved_model_scores_maps_like_rows(spark, run, rows):
    path = work_path(spark, "test-model")
    T.save_pipeline(run[0]["GradientBoosting"], path)
    model = T.load_pipeline(path)
    maps = rows.select("day", F.create_map(*[x for n in NAMES for x in (F.lit(n), F.col(n))]).alias("features_map"))
    named = T.score_maps(model, maps, features=NAMES, targets=["value_ahead"])
    plain = T.score(model, rows, ["value_ahead"]).select("day", "value_ahead_hat")
    wrong = named.join(plain, "day").where(F.abs(F.col("predictions")["value_ahead"] - F.col("value_ahead_hat")) > 1e-9)
    assert wrong.count() == 0
    empty = spark.createDataFrame([(1, {})], "id int, features_map map<string,double>")
    assert T.score_maps(model, empty, features=NAMES, targets=["value_ahead"]).first().predictions["value_ahead"] is not None


def test_fallback(spark, run):
    df = spark.createDataFrame([(2024, 6)], "y int, m int")
    out = T.score_or_fallback({}, "any", df, ["t"], year="y", month="m").first()
    assert abs(out.t_hat - 20.48) < 1e-9


def test_first_available_model_serves_when_the_named_one_is_missing(run, rows):
    out = T.score_or_fallback(run[0], "absent", rows, ["value_ahead"], year="f_year", month="f_month")
    assert "value_ahead_hat" in out.columns


def test_search_uses_a_validation_tail(rows):
    train = rows.where("split = 'train'").drop("split")
    tail = temporal_split(train, key="series_key", order=["day"]).withColumn("is_tail", F.col("split") == "test").drop("split")
    ranges = {"numTrees": (2, 5), "maxDepth": (2, 4), "minInstancesPerNode": (1, 3)}
    kw = dict(features=NAMES, targets=["value_ahead"], valid=F.col("is_tail"), trials=2, ranges=ranges)
    best, outcomes = T.tune_forest(tail, **kw)
    assert best == min(outcomes, key=lambda o: o[1])[0] and len(outcomes) == 2
    assert [s for s, _ in T.tune_forest(tail, **kw)[1]] == [s for s, _ in outcomes]  # seeded


def test_unprepared_data_is_an_error(spark, series):
    with pytest.raises(ValueError):
        T.fit_models(series({"a": [1]}), family="LinearRegression", features=NAMES, targets=["value"])


def test_prepare(yearly):
    matrix = feature_matrix(yearly, key="series_key", day="day", value="value")
    prepared = prepare(matrix, key="series_key", day="day", targets=["value"])
    counts = {r.split: r["count"] for r in prepared.rows.groupBy("split").count().collect()}
    assert 0.75 <= counts["train"] / sum(counts.values()) <= 0.85
    stats = prepared.rows.where("split = 'train'").agg(F.avg("f_ma_7"), F.stddev_pop("f_ma_7")).first()
    assert abs(stats[0]) < 1e-6 and abs(stats[1] - 1) < 1e-6
    again = prepare(matrix, key="series_key", day="day", targets=["value"], scaler=prepared.scaler)
    assert again.rows.exceptAll(prepared.rows).count() == 0


def test_transform_and_stages(spark, series):
    df = series({"a": [float(i % 9) for i in range(60)]}).withColumnRenamed("value", "temperature_2m_max")
    out = transform(df, key="series_key", day="day", columns=["temperature_2m_max"])
    assert set(FEATURES) <= set(out.columns) and out.count() == 30
    folder = work_path(spark, "test-stages")
    kw = dict(key="series_key", day="day", columns=["temperature_2m_max"], value="temperature_2m_max")
    built = staged(spark, folder, df, **kw)
    assert built.count() == 30 and staged(spark, folder, df.limit(0), **kw).count() == 30


def test_cross_validation_trains_on_the_past(rows):
    folded = time_folds(rows.drop("split"), key="series_key", order=["day"])
    out = T.cross_validate(folded, family="LinearRegression", features=NAMES, targets=["value_ahead"]).orderBy("fold").collect()
    assert [r.fold for r in out] == [2, 3, 4, 5]
    assert all(r.rmse < 10 for r in out[1:])


def test_feature_stage_survives_saving(spark, series):
    df = series({"a": [float((i * 5) % 17) for i in range(80)]}).withColumn("value", F.when(F.col("value") != 10, F.col("value")))
    stage = SeriesFeatures(columns=["value"], value="value", horizon=1, targets=["value"])
    assembler = VectorAssembler(inputCols=NAMES, outputCol="features")
    model = Pipeline(stages=[stage, assembler, LinearRegression(labelCol="value_ahead")]).fit(df)
    path = work_path(spark, "test-stage")
    T.save_pipeline(model, path)
    again = T.load_pipeline(path).transform(df).select("day", "prediction")
    assert again.count() == 49
    assert again.exceptAll(model.transform(df).select("day", "prediction")).count() == 0


def test_vector_table(spark, rows):
    path = work_path(spark, "test-matrix")
    T.assembled(rows, NAMES).select("day", "features", "value_ahead").write.parquet(path)
    stored = spark.read.parquet(path)
    assert stored.first().features.size == len(NAMES) and stored.count() == rows.count()


# streaming --------------------------------------------------------------------------------


def land(folder, name, lines):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(json.dumps(x) for x in lines))


SCHEMA = "k string, ts timestamp, v double"


def reading(day, hour, v, k="a"):
    return {"k": k, "ts": f"2024-01-{day:02d}T{hour:02d}:00:00Z", "v": v}


def test_rollup_closes_days_and_drops_late_rows(spark, tmp_path):
    land(tmp_path / "in", "1.json", [reading(1, 1, 1.0), reading(1, 2, 3.0), reading(2, 1, 5.0), reading(20, 0, 0.0)])
    target = work_path(spark, "test-stream")

    def process():
        stream = L.read_landed_files(spark, str(tmp_path / "in"), SCHEMA)
        rolled = L.streaming_rollup(stream, key="k", ts="ts", value="v")
        L.write_stream(rolled, f"{target}/data", f"{target}/checkpoint").awaitTermination()
        return {r.day.day: (r.value_max, r.value_sum, r.n_positive) for r in spark.read.parquet(f"{target}/data").collect()}

    assert process() == {1: (3.0, 4.0, 2), 2: (5.0, 5.0, 1)}
    land(tmp_path / "in", "2.json", [reading(2, 5, 99.0), reading(15, 0, 7.0), reading(28, 0, 0.0)])  # day 2 is closed
    assert process() == {1: (3.0, 4.0, 2), 2: (5.0, 5.0, 1), 15: (7.0, 7.0, 1), 20: (0.0, 0.0, 0)}


def test_dedupe_within_the_watermark(spark, tmp_path):
    land(tmp_path / "in", "1.json", [reading(1, 1, 1.0), reading(1, 1, 2.0), reading(1, 2, 1.0)])
    target = work_path(spark, "test-stream")
    stream = L.read_landed_files(spark, str(tmp_path / "in"), SCHEMA)
    L.write_stream(L.first_per_day(stream, keys=["k", "ts"], ts="ts"), f"{target}/data", f"{target}/c").awaitTermination()
    assert spark.read.parquet(f"{target}/data").count() == 2


def test_payload_stream_feeds_the_store_once(spark, tmp_path):
    payload = {"daily": {"time": ["2024-01-01", "2024-01-02"], "value": [1.0, 2.0]}}
    land(tmp_path / "in", "1.json", [{"series_key": "a", "payload": json.dumps(payload)}])
    target = work_path(spark, "test-stream")

    def process(checkpoint):
        rows = L.read_landed_payloads(spark, str(tmp_path / "in"), section="daily", ids=["series_key"], measures=["value"])
        L.append_stream_to_store(rows, f"{target}/data", f"{target}/{checkpoint}", keys=["series_key", "day"]).awaitTermination()
        return spark.read.parquet(f"{target}/data").count()

    assert process("one") == 2
    assert process("one") == 2  # nothing new landed
    assert process("two") == 2  # replayed from the start
    assert store.has_rows(store.read_if_exists(spark, f"{target}/data"))


def test_stream_scoring_equals_batch(spark, run, rows):
    source, target = work_path(spark, "test-stream"), work_path(spark, "test-stream")
    kept = rows.select("day", *NAMES)
    kept.write.parquet(source)
    stream = L.read_landed_files(spark, source, kept.schema, format="parquet")
    model = run[0]["LinearRegression"]
    L.write_stream(L.score_stream(model, stream, ["value_ahead"]), f"{target}/data", f"{target}/c").awaitTermination()
    streamed = spark.read.parquet(f"{target}/data").select("day", "value_ahead_hat")
    assert streamed.exceptAll(T.score(model, kept, ["value_ahead"]).select("day", "value_ahead_hat")).count() == 0


def test_model_queries_leave_nothing_out(spark, monkeypatch):
    """All features and targets, the library's own settings; the fits themselves are replaced."""
    from catalog import models
    from tidemark.schema import FEATURES

    asked = []
    monkeypatch.setattr(models, "train_run", lambda rows, **k: (None, None, asked.append(k)))
    monkeypatch.setattr(models.T, "tune_forest", lambda rows, **k: (None, asked.append(k) or []))
    models.train_compare(spark, "/root/testdata/sf0.001")
    models.tune_forest(spark, "/root/testdata/sf0.001")
    for k in asked:
        assert list(k["features"]) == FEATURES and list(k["targets"]) == ["value_ahead", "high_ahead", "low_ahead"]
        assert not {"params", "trials", "ranges"} & set(k)
    scored = models.batch_scoring(spark, "/root/testdata/sf0.001")
    assert scored.columns == ["series_key", "day", "value_ahead_hat", "high_ahead_hat", "low_ahead_hat"]
    assert scored.dropna().count() == scored.count() > 0


def test_saved_scaler_gives_equal_results(spark, rows):
    from tidemark.plans.stages import SeriesScaler, SeriesScalerModel

    train = rows.where("split = 'train'")
    fitted = SeriesScaler(features=NAMES, targets=["value_ahead"]).fit(train)
    path = work_path(spark, "test-scaler")
    fitted.write().save(path)
    again = SeriesScalerModel.load(path)
    assert again.getOrDefault("features") == NAMES and again.getOrDefault("targets") == ["value_ahead"]
    assert again.transform(rows).exceptAll(fitted.transform(rows)).count() == 0
    new = rows.withColumn("series_key", F.lit("unseen"))
    assert again.transform(new).count() == 0
    pipeline = Pipeline(stages=[SeriesScaler(features=NAMES), VectorAssembler(inputCols=NAMES, outputCol="features")]).fit(train)
    folder = work_path(spark, "test-scaler-pipeline")
    T.save_pipeline(pipeline, folder)
    assert T.load_pipeline(folder).transform(rows).count() == rows.count()


@pytest.mark.parametrize("name", ["train_compare", "topk_importance", "batch_scoring", "ts_cross_validation"])
def test_fits_take_tasks_by_size_not_by_shuffle_partitions(spark, monkeypatch, name):
    """A few thousand rows are not fitted and scored in as many tasks as the shuffle before them has partitions."""
    from catalog import models

    monkeypatch.setitem(T.FOREST, "numTrees", 2)
    monkeypatch.setitem(T.BOOSTING, "maxIter", 2)
    tracker, before = spark.sparkContext.statusTracker(), spark.conf.get("spark.sql.shuffle.partitions")
    earlier = set(tracker.getJobIdsForGroup())
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    try:
        assert getattr(models, name)(spark, "/root/testdata/sf0.001").count() > 0
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    jobs = [tracker.getJobInfo(j) for j in set(tracker.getJobIdsForGroup()) - earlier]
    stages = [tracker.getStageInfo(s) for j in jobs if j for s in j.stageIds]
    assert stages and max(s.numTasks for s in stages if s) < 64


def test_targets_are_boosted_side_by_side(spark, rows):
    """Small groups are not merged into one task."""
    from tidemark.operators import trees

    tracker = spark.sparkContext.statusTracker()
    earlier = set(tracker.getJobIdsForGroup())
    targets = ["value_ahead", *NAMES[:2]]
    assert trees.fit_boosting(rows.where("split = 'train'"), features=NAMES, targets=targets, rounds=2, step=0.1, depth=2)
    last = tracker.getJobInfo(max(set(tracker.getJobIdsForGroup()) - earlier))
    assert tracker.getStageInfo(max(last.stageIds)).numTasks == 3
