"""Trees for several targets against plain searches over all splits; forests, boosting, proposals."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.operators import training, trees
from tidemark.session import work_path

NAMES, TARGETS = ["a", "b", "c"], ["u", "v"]


def _plain(bins, y, w, depth, least_split, least_leaf):
    """Prediction of every row and the gains of all splits, by trying every split of every node."""
    guess, gains = np.zeros(y.shape), []

    def error(rows):
        mean = (y[rows] * w[rows, None]).sum(axis=0) / w[rows].sum()
        return ((y[rows] - mean) ** 2 * w[rows, None]).sum()

    def split(rows, levels):
        guess[rows] = (y[rows] * w[rows, None]).sum(axis=0) / w[rows].sum()
        best = (1e-9, None)
        if levels and len(rows) >= max(least_split, 2 * least_leaf):
            for f in range(bins.shape[1]):
                for b in np.unique(bins[rows, f])[:-1]:
                    left, right = rows[bins[rows, f] <= b], rows[bins[rows, f] > b]
                    if min(len(left), len(right)) >= least_leaf:
                        gain = error(rows) - error(left) - error(right)
                        best = (gain, (left, right)) if gain > best[0] + 1e-9 else best
        if best[1]:
            gains.append(best[0])
            split(best[1][0], levels - 1)
            split(best[1][1], levels - 1)

    split(np.arange(len(bins)), depth)
    return guess, sorted(gains)


def _ensemble(nodes, width):
    own = trees.Ensemble(width)
    own.add(nodes, [np.arange(256.0)] * 8, 1.0)
    return trees.unpacked(own.packed())


@pytest.mark.parametrize("seed", range(12))
def test_tree_equals_a_search_over_all_splits(seed):
    draw = np.random.default_rng(seed)
    bins = draw.integers(0, 12, (80, 4)).astype(np.uint8)
    y, w = draw.normal(size=(80, 3)), draw.integers(1, 4, 80).astype(float)
    depth, split, leaf = 5, int(draw.integers(2, 8)), int(draw.integers(1, 4))
    nodes = trees.grow(bins, y, w, depth, split, leaf)
    guess, gains = _plain(bins, y, w, depth, split, leaf)
    assert sorted(n[4] for n in nodes if n[0] >= 0) == pytest.approx(gains)
    assert trees.predict(_ensemble(nodes, 3), bins.astype(float)) == pytest.approx(guess)


def test_tree_of_equal_rows_is_a_leaf():
    assert len(trees.grow(np.zeros((9, 2), np.uint8), np.arange(9.0)[:, None], np.ones(9), 4, 2, 1)) == 1
    assert len(trees.grow(np.arange(9, dtype=np.uint8)[:, None], np.full((9, 1), 3.0), np.ones(9), 4, 2, 1)) == 1
    assert len(trees.grow(np.zeros((1, 1), np.uint8), np.ones((1, 1)), np.ones(1), 4, 2, 1)) == 1


@pytest.fixture(scope="module")
def rows(spark):
    draw = np.random.default_rng(1)
    x = draw.integers(0, 40, (3000, 3)).astype(float)
    u, v = x[:, 0] * 2 - x[:, 1], np.where(x[:, 2] > 20, 5.0, -5.0) + draw.normal(size=3000)
    data = [(*map(float, r), float(p), float(q)) for r, p, q in zip(x, u, v)]
    return spark.createDataFrame(data, "a double, b double, c double, u double, v double").repartition(4).cache()


@pytest.mark.parametrize("at_most", [100_000, 150])
def test_levels_by_histogram_equal_local_growth(rows, monkeypatch, at_most):
    """Without sampling a forest is one tree, whether its upper levels are jobs of their own or not."""
    monkeypatch.setattr(trees, "LOCAL_ROWS", at_most)
    monkeypatch.setattr(trees, "NODES_AT_ONCE", 3)
    setting = {"numTrees": 1, "maxDepth": 8, "minSplit": 5, "minInstancesPerNode": 2, "bootstrap": False}
    model = trees.fit_forests(rows, features=NAMES, targets=TARGETS, settings=[setting])[0]
    own = rows.toPandas()
    bins = own[NAMES].to_numpy()
    values = [np.unique(bins[:, i]) for i in range(3)]
    codes = np.stack([np.searchsorted(v, bins[:, i]) for i, v in enumerate(values)], axis=1).astype(np.uint8)
    nodes = trees.grow(codes, own[TARGETS].to_numpy(), np.ones(len(own)), 8, 5, 2)
    want = trees.predict(_ensemble(nodes, 2), codes.astype(float))
    got = model.transform(rows).select("u_hat", "v_hat").toPandas().to_numpy()
    assert np.abs(got - want).mean() < 0.02 * np.abs(want).mean()


def test_forests_of_several_settings_grow_together(rows):
    settings = [{"numTrees": 5, "maxDepth": 3}, {"numTrees": 30, "maxDepth": 10, "minInstancesPerNode": 2, "seed": 7}]
    models = trees.fit_forests(rows, features=NAMES, targets=TARGETS, settings=settings)
    errors = [m.transform(rows).agg(F.avg((F.col("u") - F.col("u_hat")) ** 2)).first()[0] for m in models]
    assert errors[1] < 5 < errors[0]
    again = trees.fit_forests(rows, features=NAMES, targets=TARGETS, settings=settings)
    assert [m.getOrDefault(m.trees) for m in models] == [m.getOrDefault(m.trees) for m in again]
    weights = models[1].importances()
    assert weights["u"].sum() == pytest.approx(1) and weights["u"][0] > weights["u"][2]


def test_copies_are_a_sample_with_replacement():
    drawn = trees.copies(np.arange(100_000), 5)
    assert abs(drawn.mean() - 1) < 0.02 and abs((drawn == 0).mean() - np.exp(-1)) < 0.01
    assert not np.array_equal(drawn, trees.copies(np.arange(100_000), 6))


def test_boosting_learns_each_target_and_survives_saving(spark, rows):
    model = training.fit_models(rows, family="GradientBoosting", features=NAMES, targets=TARGETS, params={"maxIter": 60})
    path = work_path(spark, "test-boosting")
    training.save_pipeline(model, path)
    scored = training.load_pipeline(path).transform(rows)
    errors = scored.agg(*(F.avg((F.col(t) - F.col(f"{t}_hat")) ** 2) for t in TARGETS)).first()
    assert errors[0] < 4 and errors[1] < 1.1
    weights = training.importances({"GradientBoosting": model}, spark, features=NAMES, targets=TARGETS)
    best = {r["target"]: r["feature"] for r in weights.groupBy("target").agg(F.max_by("feature", "importance").alias("feature")).collect()}
    assert best == {"u": "a", "v": "c"}


def test_larger_tables_are_boosted_by_the_engine(rows, monkeypatch):
    monkeypatch.setattr(trees, "LOCAL_ROWS", 100)
    model = training.fit_models(rows, family="GradientBoosting", features=NAMES, targets=["v"], params={"maxIter": 3})
    assert len(model.stages) == 3 and model.transform(rows).where("v_hat is null").count() == 0


def test_proposals_gather_where_trials_are_good():
    ranges, draw = {"numTrees": (50, 500), "maxDepth": (5, 30)}, random.Random(3)
    outcomes = [({"numTrees": 50 + 22 * i, "maxDepth": 5 + i * 25 // 19}, abs(i - 11.5)) for i in range(20)]
    found = training.propose(outcomes, ranges, draw, 30)
    assert all(50 <= s["numTrees"] <= 500 and 5 <= s["maxDepth"] <= 30 for s in found)
    assert abs(np.mean([s["maxDepth"] for s in found]) - 20) < 4


def test_search_refits_the_best(rows):
    ranges = {"numTrees": (3, 8), "maxDepth": (2, 6), "minSplit": (2, 5), "minInstancesPerNode": (1, 3)}
    model, best, outcomes = training.tune_and_refit(rows, features=NAMES, targets=TARGETS, valid=F.col("a") > 30, trials=10, ranges=ranges)
    assert len(outcomes) == 10 and best == min(outcomes, key=lambda o: o[1])[0]
    assert model.transform(rows).where("u_hat is null").count() == 0


def test_an_ensemble_holds_arrays_only():
    """The driver keeps some ten numbers for each node, not an object for each."""
    import tracemalloc

    draw = np.random.default_rng(2)
    nodes = trees.grow(draw.integers(0, 64, (4000, 3)).astype(np.uint8), draw.normal(size=(4000, 3)), np.ones(4000), 15, 2, 1)
    own = trees.Ensemble(3)
    tracemalloc.start()
    for _ in range(5):
        own.add(nodes, [np.arange(256.0)] * 3, 1.0)
    held = tracemalloc.get_traced_memory()[0]
    tracemalloc.stop()
    assert held < 100 * 5 * len(nodes)
    assert len(trees.unpacked(own.packed())["feature"]) == 5 * len(nodes)
