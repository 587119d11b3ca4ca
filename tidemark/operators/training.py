"""Fitting, tuning, scoring and storing Spark ML regressors."""

from __future__ import annotations

import math
import random
import time
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.regression import GBTRegressor, LinearRegression
from pyspark.sql import Column, DataFrame, functions as F

from ..functions.scalars import name_predictions, season_fallback, vector_values
from ..schema import require_columns
from ..session import durable
from . import metrics as M, trees

# Settings of the three model families.
FOREST = {"numTrees": 200, "maxDepth": 15, "minSplit": 5, "minInstancesPerNode": 2, "seed": 42}
BOOSTING = {"maxIter": 150, "stepSize": 0.1, "maxDepth": 6, "seed": 42}
LINEAR = {"regParam": 0.0, "solver": "normal"}

# Search ranges of the forest (both ends included).
FOREST_RANGES = {"numTrees": (50, 500), "maxDepth": (5, 30), "minSplit": (2, 20), "minInstancesPerNode": (1, 10)}

FAMILIES = ("LinearRegression", "GradientBoosting", "RandomForest")


def assembled(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Add the feature vector column; the matrix sink is this frame written as Parquet."""
    require_columns(df, features)
    return VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="error").transform(df)


def fit_models(
    train: DataFrame,
    *,
    family: str,
    features: Sequence[str],
    targets: Sequence[str],
    params: Mapping[str, object] | None = None,
) -> PipelineModel:
    """A fitted model of all targets; predictions go to ``<target>_hat``.

    A forest is one model for all targets, and small tables are boosted in a task per target
    (``trees``).  The engine's learners fit linear models and boost larger tables, one regressor
    per target behind a shared assembler and scaler, submitted together over one cached table.
    ``train`` is read several times: give a stored table (``durable``), whose parts follow its size;
    a frame behind a shuffle is computed again, and cached in as many parts as the shuffle has.
    """
    require_columns(train, [*features, *targets])
    params = dict(params or {})
    if family == "RandomForest":
        settings = [{**FOREST, **params}]
        return PipelineModel(stages=trees.fit_forests(train, features=features, targets=targets, settings=settings))
    if family == "GradientBoosting":
        own = {**BOOSTING, **params}
        boosted = trees.fit_boosting(
            train, features=features, targets=targets, rounds=own["maxIter"], step=own["stepSize"], depth=own["maxDepth"]
        )
        if boosted:
            return PipelineModel(stages=[boosted])
        regressor, params = GBTRegressor, own
    else:
        regressor, params = LinearRegression, {**LINEAR, **params}
    prepare = Pipeline(
        stages=[
            VectorAssembler(inputCols=list(features), outputCol="features"),
            StandardScaler(inputCol="features", outputCol="scaled", withMean=True, withStd=True),
        ]
    ).fit(train)
    vectors = prepare.transform(train).select("scaled", *targets).cache()

    def fit(target: str):
        settings = {"featuresCol": "scaled", "labelCol": target, "predictionCol": f"{target}_hat"}
        return regressor(**settings, **params).fit(vectors)

    try:
        with ThreadPoolExecutor(len(targets)) as pool:
            fitted = list(pool.map(fit, targets))
    finally:
        vectors.unpersist()
    return PipelineModel(stages=[*prepare.stages, *fitted])


def score(model: PipelineModel, df: DataFrame, targets: Sequence[str]) -> DataFrame:
    """Batch scoring in one pass; works on streams as well."""
    kept = [*df.columns, *[f"{t}_hat" for t in targets]]
    return model.transform(df).select(*kept)


def score_maps(
    model: PipelineModel, requests: DataFrame, *, features: Sequence[str], targets: Sequence[str], values: str = "features_map"
) -> DataFrame:
    """Score requests given as name->value maps; a missing feature counts as 0.0."""
    vector = vector_values(F.col(values), features)
    wide = requests.withColumn("_vector", vector).select(
        *requests.columns, *[F.col("_vector")[i].alias(f) for i, f in enumerate(features)]
    )
    scored = score(model, wide, targets)
    answer = name_predictions(F.array(*[F.col(f"{t}_hat") for t in targets]), targets, len(targets))
    return scored.select(*requests.columns, answer.alias("predictions"))


def fallback_scores(df: DataFrame, *, year: str, month: str, targets: Sequence[str]) -> DataFrame:
    """Predictions when no model is available: the seasonal formula for every target."""
    value: Column = season_fallback(F.col(year), F.col(month))
    return df.withColumns({f"{t}_hat": value for t in targets})


def score_or_fallback(
    models: Mapping[str, PipelineModel], name: str, df: DataFrame, targets: Sequence[str], *, year: str, month: str
) -> DataFrame:
    """The named model, else the first available one, else the seasonal formula."""
    model = models.get(name) or next(iter(models.values()), None)
    if model is None:
        return fallback_scores(df, year=year, month=month, targets=targets)
    return score(model, df, targets)


def evaluate(scored: DataFrame, ids: Sequence[str], targets: Sequence[str]) -> DataFrame:
    """Per-target metrics of scored rows; ``ids`` name the groups (split, series, ...)."""
    long = M.predictions_to_long(scored, ids, {t: (t, f"{t}_hat") for t in targets})
    return M.regression_metrics(long, [*ids, "target"])


def train_and_compare(
    matrix: DataFrame,
    *,
    features: Sequence[str],
    targets: Sequence[str],
    params: Mapping[str, Mapping[str, object]] | None = None,
    families: Sequence[str] = tuple(FAMILIES),
) -> tuple[dict[str, PipelineModel], DataFrame]:
    """Fit every family on the train split, score both splits, return models and metrics.

    ``matrix`` carries the column ``split``; it is stored first, so that its parts follow its size and
    not the number of shuffle partitions, which a cached frame keeps.  Driver-side work is the loop
    over the few families; data stays in Spark.
    """
    require_columns(matrix, ["split", *features, *targets])
    matrix = durable(matrix)
    models, results = {}, []
    train = matrix.where(F.col("split") == "train")
    for family in families:
        began = time.monotonic()
        models[family] = fit_models(
            train, family=family, features=features, targets=targets, params=(params or {}).get(family)
        )
        seconds = time.monotonic() - began
        scored = evaluate(score(models[family], matrix, targets), ["split"], targets)
        results.append(scored.select(F.lit(family).alias("model"), F.lit(seconds).alias("training_seconds"), "*"))
    # The metrics table has families x splits x targets rows.
    return models, durable(reduce(DataFrame.unionByName, results))


def results_table(metrics: DataFrame, experiment: Mapping[str, object]) -> DataFrame:
    """Test averages per model in the shape the selection operators expect."""
    test = metrics.where(F.col("split") == "test")
    out = test.groupBy("model").agg(
        F.avg("rmse").alias("avg_rmse"),
        F.avg("mae").alias("avg_mae"),
        F.avg("r2").alias("avg_r2"),
        F.max("training_seconds").alias("training_seconds"),
        F.max("n_rows").alias("test_rows"),
    )
    return out.select(*[F.lit(v).alias(k) for k, v in experiment.items()], *out.columns)


def _weights(model: PipelineModel, targets: Sequence[str]) -> dict:
    """Feature importances by target; empty for models that have none."""
    if isinstance(model.stages[0], trees.TreeModel):
        return model.stages[0].importances()
    own = zip(targets, model.stages[2:], strict=True)
    return {t: stage.featureImportances.toArray() for t, stage in own if hasattr(stage, "featureImportances")}


def importances(models: Mapping[str, PipelineModel], spark, *, features: Sequence[str], targets: Sequence[str]) -> DataFrame:
    """Feature importances of tree models as a long table: (model, target, feature, importance).

    Its size is models x targets x features, whatever the data volume.
    """
    weights = [(family, target, w) for family, model in models.items() for target, w in _weights(model, targets).items()]
    rows = [(family, target, f, float(w)) for family, target, own in weights for f, w in zip(features, own, strict=True)]
    return spark.createDataFrame(rows, "model string, target string, feature string, importance double")


# Settings of the search: trials before proposals, trials of a round, share of trials that count as
# good, values drawn for each proposal, trees of an early trial, trials that are grown in full.
STARTUP, ROUND, GOOD, DRAWN, EARLY, FINALISTS = 8, 4, 0.25, 24, 20, 3


def _density(x: int, points: Sequence[int], low: int, high: int) -> float:
    """Parzen estimate over ``points`` with a flat share of one point."""
    width = max(1.0, (high - low) / (1 + math.sqrt(len(points))))
    bumps = sum(math.exp(-(((x - p) / width) ** 2) / 2) / (width * math.sqrt(2 * math.pi)) for p in points)
    return (bumps + 1 / (high - low + 1)) / (len(points) + 1)


def propose(
    outcomes: Sequence[tuple[Mapping[str, int], float]], ranges: Mapping[str, tuple[int, int]], draw: random.Random, count: int
) -> list[dict[str, int]]:
    """Settings that good trials make likelier than bad ones (a tree of Parzen estimators, one per parameter)."""
    ranked = [s for s, _ in sorted(outcomes, key=lambda o: o[1])]
    cut = max(2, math.ceil(GOOD * len(ranked)))
    good, bad = ranked[:cut], ranked[cut:]

    def value(name: str) -> int:
        low, high = ranges[name]
        width = max(1.0, (high - low) / (1 + math.sqrt(len(good))))
        near = [round(draw.gauss(draw.choice(good)[name], width)) for _ in range(DRAWN)]
        inside = [x for x in near if low <= x <= high] or [draw.randint(low, high)]
        return max(inside, key=lambda x: _density(x, [s[name] for s in good], low, high) / _density(x, [s[name] for s in bad], low, high))

    return [{name: value(name) for name in ranges} for _ in range(count)]


def tune_forest(
    train: DataFrame,
    *,
    features: Sequence[str],
    targets: Sequence[str],
    valid: Column,
    trials: int = 20,
    seed: int = 42,
    ranges: Mapping[str, tuple[int, int]] = FOREST_RANGES,
) -> tuple[dict[str, int], list[tuple[dict[str, int], float]]]:
    """Seeded informed search; each trial is scored by pooled RMSE on a validation tail of train.

    ``valid`` marks the validation rows (the latest part of the training rows), so the test rows play
    no part in choosing parameters.  The first trials are drawn evenly, later ones proposed by what
    good trials have in common.  Trials are compared on ``EARLY`` trees each; the best ``FINALISTS``
    are then grown to their own number of trees and scored again.  The forests of a round grow
    together.  Returns the best setting and all trials with their last score.
    """
    draw = random.Random(seed)
    fit_rows, check_rows = durable(train.where(~valid)), durable(train.where(valid))

    def scored(settings: Sequence[Mapping[str, int]]) -> list[float]:
        models = trees.fit_forests(fit_rows, features=features, targets=targets, settings=settings)
        long = [
            M.predictions_to_long(score(PipelineModel(stages=[m]), check_rows, targets), [], {t: (t, f"{t}_hat") for t in targets})
            .select(F.lit(i).alias("trial"), "y", "yhat")
            for i, m in enumerate(models)
        ]
        found = M.pooled_rmse(reduce(DataFrame.unionByName, long), ["trial"]).collect()  # one row per trial
        return [r["pooled_rmse"] for r in sorted(found, key=lambda r: r["trial"])]

    outcomes: list[tuple[dict[str, int], float]] = []
    while len(outcomes) < trials:
        count = min(ROUND if len(outcomes) >= STARTUP else STARTUP, trials - len(outcomes))
        if len(outcomes) < STARTUP:
            settings = [{n: draw.randint(*ranges[n]) for n in ranges} for _ in range(count)]
        else:
            settings = propose(outcomes, ranges, draw, count)
        early = scored([{**s, "numTrees": min(EARLY, s["numTrees"])} for s in settings])
        outcomes += zip(settings, early, strict=True)
    best = sorted(range(trials), key=lambda i: outcomes[i][1])[:FINALISTS]
    for i, error in zip(best, scored([outcomes[i][0] for i in best]), strict=True):
        outcomes[i] = (outcomes[i][0], error)
    return min(outcomes, key=lambda o: o[1])[0], outcomes


def tune_and_refit(
    train: DataFrame, *, features: Sequence[str], targets: Sequence[str], valid: Column, **search: object
) -> tuple[PipelineModel, dict[str, int], list[tuple[dict[str, int], float]]]:
    """The search, and a forest with its best setting fitted to all training rows."""
    best, outcomes = tune_forest(train, features=features, targets=targets, valid=valid, **search)
    return fit_models(train, family="RandomForest", features=features, targets=targets, params=best), best, outcomes


def cross_validate(
    rows: DataFrame,
    *,
    family: str,
    features: Sequence[str],
    targets: Sequence[str],
    fold: str = "fold",
    folds: int = 5,
    params: Mapping[str, object] | None = None,
) -> DataFrame:
    """Expanding-window validation: fold k is scored by a model fitted on the folds before it."""
    results = []
    for k in range(2, folds + 1):
        model = fit_models(
            rows.where(F.col(fold) < k), family=family, features=features, targets=targets, params=params
        )
        results.append(evaluate(score(model, rows.where(F.col(fold) == k), targets), [fold], targets))
    return durable(reduce(DataFrame.unionByName, results))


def univariate_ols(df: DataFrame, *, key: str, x: Column, y: Column) -> DataFrame:
    """Least-squares line per series in one aggregation."""
    return df.groupBy(key).agg(
        F.regr_slope(y, x).alias("slope"), F.regr_intercept(y, x).alias("intercept"), F.regr_r2(y, x).alias("r2")
    )


def save_pipeline(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_pipeline(path: str) -> PipelineModel:
    return PipelineModel.load(path)
