"""Regression trees for several targets at once, grown from histograms of binned features.

A forest is one model for all targets: a split gains what it takes off the squared errors of all of
them together.  Features are cut into at most ``BINS`` bins at quantiles.  All trees grow side by
side: while a node of any tree has more than ``LOCAL_ROWS`` rows, its level is one job, in which a
task adds up one histogram per node (rows, weights, and weighted sums of every target in every bin)
and the histograms of a node meet to name its split.  A node with fewer rows is handed over whole,
with a group of its own, and its subtree is grown where its rows are.  So a small training table
takes a single job for the whole forest, and no task ever holds more than ``LOCAL_ROWS`` rows.

Bootstrap weights are drawn from the number of the row and of the tree, so that a task run again
draws the same.  Boosting adds trees of one target after each other; a training table of up to
``LOCAL_ROWS`` rows is boosted in one task per target, a larger one is left to the engine's learner.

The model is a table of nodes; its size is that of the trees, whatever the data.
"""

from __future__ import annotations

import base64
import io
from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import keyword_only
from pyspark.ml import Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame, functions as F

from ..session import durable, ship

BINS = 64
LOCAL_ROWS = 100_000
NODES_AT_ONCE = 500  # nodes whose histograms one pass adds up
CELLS_AT_ONCE = 150_000  # numbers that a pass over the sorted rows holds, so that they stay in the processor's cache
# Poisson(1): chances of at most 0, 1, 2, ... copies of a row in a bootstrap sample.
_CHANCES = np.cumsum(np.exp(-1) / np.cumprod(np.r_[1.0, np.arange(1, 12)]))


def binned(rows: DataFrame, features: Sequence[str], targets: Sequence[str]) -> tuple[DataFrame, list[np.ndarray]]:
    """(row, bins, y): a stored table with a byte per feature; and the cuts of every feature."""
    ship(rows.sparkSession)
    shares = [i / BINS for i in range(1, BINS)]
    found = rows.agg(*(F.percentile_approx(F.col(f).cast("double"), shares, 100 * BINS).alias(f) for f in features)).first()
    cuts = [np.unique(np.array(found[f] or [], float)) for f in features]
    values = [F.col(c).cast("double") for c in features]
    truth = F.array(*(F.col(c).cast("double") for c in targets))
    frame = rows.select(F.monotonically_increasing_id().alias("row"), F.array(*values).alias("x"), truth.alias("y"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = batch.column(1).flatten().to_numpy().reshape(batch.num_rows, -1)
                codes = np.stack([np.searchsorted(c, x[:, i], "left") for i, c in enumerate(cuts)], axis=1).astype(np.uint8)
                yield pa.RecordBatch.from_arrays([batch.column(0), _rows_of(codes), batch.column(2)], names=["row", "bins", "y"])

    return durable(frame.mapInArrow(run, "row long, bins binary, y array<double>")), cuts


def _rows_of(codes: np.ndarray) -> pa.Array:
    return pa.array([r.tobytes() for r in codes], pa.binary())


def _codes(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(len(column), -1)


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy().reshape(len(column), -1)


def copies(rows: np.ndarray, seed: int) -> np.ndarray:
    """How often each row is drawn into the sample of one tree."""
    x = rows.astype(np.uint64) + np.uint64((seed * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) % 2**64)
    for shift, times in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(times)
    u = (x ^ (x >> np.uint64(31))).astype(np.float64) / 2.0**64
    return np.searchsorted(_CHANCES, u, "right").astype(np.int64)


def histogram(bins: np.ndarray, y: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """(2 + targets, features, BINS): rows, weights and weighted sums of every target."""
    n, features = bins.shape
    cells = (bins + np.arange(features) * BINS).ravel()
    values = [np.ones(n), weight, *(weight * t for t in y.T)]
    return np.stack([np.bincount(cells, np.repeat(v, features), features * BINS).reshape(features, BINS) for v in values])


def best_split(cells: np.ndarray, least: int) -> tuple[float, int, int]:
    """(gain, feature, bin) of the split that takes most off the squared errors; rows up to the bin go left."""
    left = np.cumsum(cells, axis=2)[:, :, :-1]
    right = cells.sum(axis=2, keepdims=True) - left
    fits = (left[0] >= least) & (right[0] >= least)
    if not fits.any():
        return 0.0, -1, -1
    whole = (cells[2:, 0].sum(axis=1) ** 2).sum() / cells[1, 0].sum()
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = (left[2:] ** 2).sum(axis=0) / left[1] + (right[2:] ** 2).sum(axis=0) / right[1] - whole
    gain = np.where(fits, gain, -np.inf)
    at = int(gain.argmax())
    feature, place = divmod(at, gain.shape[1])
    return float(gain[feature, place]), feature, place


def _splits(order: np.ndarray, codes: np.ndarray, stats: np.ndarray, sizes: np.ndarray, least: int) -> tuple[np.ndarray, ...]:
    """(gain, feature, bin) of the best split of each node; ``order`` holds, for every feature, the rows by node and bin."""
    m, nodes = order.shape[1], len(sizes)
    start = np.cumsum(sizes) - sizes
    node = np.repeat(np.arange(nodes), sizes)
    rank = np.arange(m) - start[node] + 1
    inner = (rank >= least) & (sizes[node] - rank >= least)
    best = np.full(nodes, -np.inf), np.full(nodes, -1), np.zeros(nodes, np.int64)
    step = max(1, CELLS_AT_ONCE // (len(stats) * m))
    for first in range(0, len(order), step):
        own = order[first : first + step]
        bins = np.take_along_axis(codes[first : first + step], own, axis=1)
        upto = np.cumsum(stats[:, own], axis=2)
        before = np.where(start > 0, upto[:, :, start - 1], 0.0)
        left = upto - before[:, :, node]
        whole = (upto[:, :, start + sizes - 1] - before)[:, :, node]
        with np.errstate(divide="ignore", invalid="ignore"):
            gain = ((left[1:] ** 2).sum(axis=0) / left[0]) + (((whole - left)[1:] ** 2).sum(axis=0) / (whole - left)[0])
        gain -= (whole[1:] ** 2).sum(axis=0) / whole[0]
        ends = np.c_[bins[:, 1:] != bins[:, :-1], np.zeros(len(own), bool)]
        gain[~(ends & inner)] = -np.inf
        feature = gain.argmax(axis=0)
        top = gain[feature, np.arange(m)]
        most = np.maximum.reduceat(top, start)
        # The first place of each node with its greatest gain.
        places = np.flatnonzero(top == most[node])
        at = places[np.unique(node[places], return_index=True)[1]]
        better = most > best[0]
        best[0][better], best[1][better] = most[better], first + feature[at][better]
        best[2][better] = bins[feature[at], at][better]
    return best


def _splits_of_few(bins: np.ndarray, slot: np.ndarray, stats: np.ndarray, nodes: int, least: int) -> tuple[np.ndarray, ...]:
    """As ``_splits`` from histograms, which needs no order but ``BINS`` cells for each node and feature."""
    n, features = bins.shape
    cells = (bins + np.arange(features) * BINS + slot[:, None] * (features * BINS)).ravel()
    size, shape = nodes * features * BINS, (nodes, features, BINS)
    counts = np.cumsum(np.bincount(cells, minlength=size).reshape(shape), axis=2)
    upto = np.cumsum(np.stack([np.bincount(cells, np.repeat(s, features), size).reshape(shape) for s in stats]), axis=3)
    left, whole = upto[..., :-1], upto[..., -1:]
    right = whole - left
    fits = (counts[..., :-1] >= least) & (counts[..., -1:] - counts[..., :-1] >= least)
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = (left[1:] ** 2).sum(axis=0) / left[0] + (right[1:] ** 2).sum(axis=0) / right[0] - (whole[1:] ** 2).sum(axis=0) / whole[0]
    gain = np.where(fits, gain, -np.inf).reshape(nodes, -1)
    at = gain.argmax(axis=1)
    best = gain[np.arange(nodes), at]
    feature, place = np.divmod(at, BINS - 1)
    return best, np.where(np.isfinite(best), feature, -1), place


def grow(bins: np.ndarray, y: np.ndarray, weight: np.ndarray, depth: int, least_split: int, least_leaf: int) -> list[list]:
    """Nodes [feature or -1, bin, left, right, gain, rows' mean of every target] of a tree, its root first.

    All nodes of a level are split together, from histograms while they are few against their rows, later
    from rows that every feature keeps sorted by node and bin.
    """
    stats = np.stack([weight, *(weight * t for t in y.T)])
    codes, order = np.ascontiguousarray(bins.T), None
    slot, nodes, rows = np.zeros(len(bins), np.int64), [], np.arange(len(bins))

    def add(total: np.ndarray) -> int:
        nodes.append([-1, 0, -1, -1, 0.0, (total[1:] / total[0]).tolist()])
        return len(nodes) - 1

    open_ = [add(stats.sum(axis=1))]
    squares = (y**2 * weight[:, None]).sum(axis=1)
    for _ in range(depth):
        sizes = np.bincount(slot[rows], minlength=len(open_))
        if 4 * BINS * len(open_) <= len(rows):
            gain, feature, place = _splits_of_few(bins[rows], slot[rows], stats[:, rows], len(open_), least_leaf)
        else:
            if order is None:
                order = np.argsort(codes, axis=1, kind="stable")
            kept = np.zeros(len(bins), bool)
            kept[rows] = True
            order = order[kept[order]].reshape(len(order), -1)
            # 16-bit numbers are sorted by their digits.
            kind = np.int16 if len(open_) < 2**15 else np.int64
            order = np.take_along_axis(order, np.argsort(slot.astype(kind)[order], axis=1, kind="stable"), axis=1)
            gain, feature, place = _splits(order, codes, stats, sizes, least_leaf)
        noise = 1e-9 * np.bincount(slot[rows], squares[rows], len(open_))
        split = (feature >= 0) & (gain > noise) & (sizes >= max(least_split, 2 * least_leaf))
        rows = rows[split[slot[rows]]]
        if not len(rows):
            break
        own = slot[rows]
        goes = 2 * (np.cumsum(split) - 1)[own] + (bins[rows, feature[own]] > place[own])
        following = []
        sums = np.stack([np.bincount(goes, s[rows], 2 * split.sum()) for s in stats], axis=1)
        for i, j in enumerate(np.flatnonzero(split)):
            left, right = add(sums[2 * i]), add(sums[2 * i + 1])
            nodes[open_[j]][:5] = [int(feature[j]), int(place[j]), left, right, float(gain[j])]
            following += [left, right]
        slot[rows] = goes
        open_ = following
    return nodes


class Ensemble:
    """Trees as arrays: feature (-1 at a leaf), threshold, children, gain and value of every node, and the roots."""

    def __init__(self, targets: int):
        self.targets, self.columns, self.size, self.roots, self.base = targets, [], 0, [], np.zeros(targets)

    def add(self, nodes: list[tuple], cuts: list[np.ndarray], scale: float, own: int | None = None) -> None:
        """A tree whose values count ``scale`` times; ``own`` is the target of a tree with a single one."""
        feature, place, left, right, gain, value = zip(*nodes)
        threshold = [float(cuts[f][p]) if f >= 0 else 0.0 for f, p in zip(feature, place)]
        whole = np.zeros((len(nodes), self.targets))
        whole[:, slice(None) if own is None else slice(own, own + 1)] = np.array(value) * scale
        self.columns.append(
            {"feature": np.array(feature, np.int16), "threshold": np.array(threshold), "left": np.array(left, np.int32) + np.int32(self.size),
             "right": np.array(right, np.int32) + np.int32(self.size), "gain": np.array(gain, float), "value": whole,
             "own": np.full(len(nodes), -1 if own is None else own)}
        )
        self.roots.append(self.size)
        self.size += len(nodes)

    def packed(self) -> str:
        out = io.BytesIO()
        joined = {name: np.concatenate([c[name] for c in self.columns]) for name in self.columns[0]}
        np.savez_compressed(out, **joined, roots=np.array(self.roots), base=self.base)
        return base64.b64encode(out.getvalue()).decode()


def unpacked(text: str) -> dict[str, np.ndarray]:
    with np.load(io.BytesIO(base64.b64decode(text))) as held:
        return dict(held)


def predict(model: Mapping[str, np.ndarray], x: np.ndarray) -> np.ndarray:
    out, every = np.tile(model["base"], (len(x), 1)), np.arange(len(x))
    for root in model["roots"]:
        at, rows = np.full(len(x), root), every
        while len(rows):
            feature = model["feature"][at[rows]]
            rows, feature = rows[feature >= 0], feature[feature >= 0]
            node = at[rows]
            at[rows] = np.where(x[rows, feature] <= model["threshold"][node], model["left"][node], model["right"][node])
        out += model["value"][at]
    return out


class TreeModel(Model, DefaultParamsReadable, DefaultParamsWritable):
    """A fitted ensemble as a pipeline stage; adds ``<target>_hat``."""

    features = Param(Params._dummy(), "features", "feature columns", TypeConverters.toListString)
    targets = Param(Params._dummy(), "targets", "predicted columns", TypeConverters.toListString)
    trees = Param(Params._dummy(), "trees", "the packed nodes", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, features=None, targets=None, trees=None):
        super().__init__()
        self._set(**{n: v for n, v in self._input_kwargs.items() if v is not None})

    def _transform(self, dataset: DataFrame) -> DataFrame:
        ship(dataset.sparkSession)
        text, targets = self.getOrDefault(self.trees), self.getOrDefault(self.targets)

        def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            model = unpacked(text)
            for x in batches:
                yield pd.Series(list(predict(model, np.stack(x.to_numpy())) if len(x) else []))

        hats = F.pandas_udf(score, "array<double>")
        x = F.array(*(F.col(f).cast("double") for f in self.getOrDefault(self.features)))
        out = dataset.withColumn("_hats", hats(x))
        return out.withColumns({f"{t}_hat": F.get("_hats", F.lit(i)) for i, t in enumerate(targets)}).drop("_hats")

    def importances(self) -> dict[str, np.ndarray]:
        """Share of the squared error that each feature took off, by target; one tree for all targets counts for each."""
        model, features = unpacked(self.getOrDefault(self.trees)), self.getOrDefault(self.features)
        out = {}
        for i, target in enumerate(self.getOrDefault(self.targets)):
            inner = (model["feature"] >= 0) & np.isin(model["own"], (-1, i))
            tree = np.searchsorted(model["roots"], np.flatnonzero(inner), "right") - 1
            total = np.zeros((len(model["roots"]), len(features)))
            np.add.at(total, (tree, model["feature"][inner]), model["gain"][inner])
            shares = total / np.maximum(total.sum(axis=1, keepdims=True), 1e-300)
            out[target] = shares.sum(axis=0) / max(shares.sum(), 1e-300)
        return out


_TREES = "tree int, node long, feature array<int>, place array<int>, left array<int>, right array<int>, gain array<double>, value array<double>"
_TREES_ARROW = pa.schema(
    [("tree", pa.int32()), ("node", pa.int64()), *((c, pa.list_(pa.int32())) for c in ("feature", "place", "left", "right")),
     ("gain", pa.list_(pa.float64())), ("value", pa.list_(pa.float64()))]
)
_SPLITS = "tree int, node long, feature int, place int, gain double, left long, right long"
_SPLITS_ARROW = pa.schema(
    [("tree", pa.int32()), ("node", pa.int64()), ("feature", pa.int32()), ("place", pa.int32()), ("gain", pa.float64()),
     ("left", pa.int64()), ("right", pa.int64())]
)


def _table(rows: list[tuple], schema: pa.Schema) -> pa.Table:
    return pa.table([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)


def _placed(splits: Mapping[int, tuple[int, int]], bins: np.ndarray) -> np.ndarray:
    """The node (1, its children 2 and 3, ...) of the upper part of a tree that each row falls into."""
    node = np.ones(len(bins), np.int64)
    moving = np.arange(len(bins))
    while len(moving):
        known = np.array([n in splits for n in node[moving].tolist()])
        moving = moving[known]
        for n in np.unique(node[moving]):
            here = moving[node[moving] == n]
            feature, place = splits[int(n)]
            node[here] = 2 * n + (bins[here, feature] > place)
    return node


def _upper(table: DataFrame, total: int, trees: Sequence[Mapping[str, int]], width: int) -> list[dict[int, tuple]]:
    """Splits (feature, bin, gain) of the nodes with more than ``LOCAL_ROWS`` rows, by tree."""
    splits: list[dict[int, tuple]] = [{} for _ in trees]
    open_ = [(t, 1) for t in range(len(trees))] if total > LOCAL_ROWS else []
    while open_:
        following = []
        for start in range(0, len(open_), NODES_AT_ONCE):
            wanted = open_[start : start + NODES_AT_ONCE]
            upper = {t: {n: s[:2] for n, s in splits[t].items()} for t, _ in wanted}

            def add_up(batches: Iterator[pa.RecordBatch], wanted=wanted, upper=upper) -> Iterator[pa.RecordBatch]:
                held: dict[tuple, np.ndarray] = {}
                for batch in batches:
                    if not batch.num_rows:
                        continue
                    rows, bins, y = batch.column(0).to_numpy(), _codes(batch.column(1)), _matrix(batch.column(2))
                    for t in upper:
                        weight = copies(rows, trees[t]["seed"]) if trees[t]["bootstrap"] else np.ones(len(rows), np.int64)
                        node = np.where(weight > 0, _placed(upper[t], bins), 0)
                        for n in (n for tree, n in wanted if tree == t):
                            own = node == n
                            if own.any():
                                cells = histogram(bins[own], y[own], weight[own].astype(float))
                                held[t, n] = held[t, n] + cells if (t, n) in held else cells
                keys = list(held)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([t for t, _ in keys], pa.int32()), pa.array([n for _, n in keys], pa.int64()),
                     pa.array([held[k].tobytes() for k in keys], pa.binary())], names=["tree", "node", "cells"],
                )

            def split(key: tuple, part: pa.Table) -> pa.Table:
                t, n = key[0].as_py(), key[1].as_py()
                cells = sum(np.frombuffer(c, float) for c in part["cells"].to_pylist()).reshape(-1, width, BINS)
                gain, feature, place = best_split(cells, trees[t]["least_leaf"])
                left = int(cells[0, feature, : place + 1].sum()) if feature >= 0 else 0
                count = int(cells[0, 0].sum())
                return _table([(t, n, feature, place, gain, left, count - left)], _SPLITS_ARROW)

            found = table.mapInArrow(add_up, "tree int, node long, cells binary").groupBy("tree", "node").applyInArrow(split, _SPLITS)
            for r in found.collect():  # one row for each node of the upper trees
                t, n = r["tree"], r["node"]
                if r["feature"] < 0 or r["gain"] <= 0 or n.bit_length() > trees[t]["depth"]:
                    continue
                splits[t][n] = (r["feature"], r["place"], r["gain"])
                following += [(t, 2 * n + side) for side, k in enumerate((r["left"], r["right"])) if k > LOCAL_ROWS]
        open_ = [(t, n) for t, n in following if n.bit_length() <= trees[t]["depth"]]
    return splits


def fit_forests(
    rows: DataFrame, *, features: Sequence[str], targets: Sequence[str], settings: Sequence[Mapping[str, int]]
) -> list[TreeModel]:
    """One forest for all targets per setting (numTrees, maxDepth, minSplit, minInstancesPerNode, seed); all trees grow together."""
    table, cuts = binned(rows, features, targets)
    trees = [
        {"forest": f, "seed": s.get("seed", 42) * 1_000_003 + i, "bootstrap": s.get("bootstrap", True), "depth": s["maxDepth"],
         "least_split": s.get("minSplit", 2), "least_leaf": s.get("minInstancesPerNode", 1)}
        for f, s in enumerate(settings) for i in range(s["numTrees"])
    ]
    upper = _upper(table, table.count(), trees, len(features))

    def hand_over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            numbers, bins = batch.column(0).to_numpy(), _codes(batch.column(1))
            for t, tree in enumerate(trees):
                weight = copies(numbers, tree["seed"]) if tree["bootstrap"] else np.ones(len(numbers), np.int64)
                kept = np.flatnonzero(weight)
                node = _placed({n: s[:2] for n, s in upper[t].items()}, bins[kept]) if upper[t] else np.ones(len(kept), np.int64)
                some = batch.take(pa.array(kept))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(kept), t, np.int32)), pa.array(node), pa.array(weight[kept].astype(np.int32)), some.column(1), some.column(2)],
                    names=["tree", "node", "weight", "bins", "y"],
                )

    def finish(key: tuple, part: pa.Table) -> pa.Table:
        t, n = key[0].as_py(), key[1].as_py()
        tree, part = trees[t], part.combine_chunks()
        left = tree["depth"] + 1 - n.bit_length()
        nodes = grow(
            _codes(part["bins"].chunk(0)), _matrix(part["y"].chunk(0)), part["weight"].to_numpy().astype(float), left,
            tree["least_split"], tree["least_leaf"],
        )
        feature, place, lefts, rights, gain, value = zip(*nodes)
        return _table([(t, n, feature, place, lefts, rights, gain, [v for x in value for v in x])], _TREES_ARROW)

    moved = table.mapInArrow(hand_over, "tree int, node long, weight int, bins binary, y array<double>")
    found = moved.groupBy("tree", "node").applyInArrow(finish, _TREES).toArrow()  # the model
    places: dict[int, list[int]] = {}
    for i, t in enumerate(found["tree"].to_pylist()):
        places.setdefault(t, []).append(i)
    ensembles = [Ensemble(len(targets)) for _ in settings]
    for t, tree in enumerate(trees):
        parts = {}
        for i in places.get(t, []):  # lists of one tree at a time: they take far more room than arrays
            r = found.slice(i, 1).to_pylist()[0]
            value = np.array(r["value"]).reshape(len(r["feature"]), -1).tolist()
            parts[r["node"]] = [list(x) for x in zip(r["feature"], r["place"], r["left"], r["right"], r["gain"], value)]
        if parts:
            ensembles[tree["forest"]].add(_joined(1, upper[t], parts), cuts, 1 / settings[tree["forest"]]["numTrees"])
    return [TreeModel(features=list(features), targets=list(targets), trees=e.packed()) for e in ensembles]


def _joined(node: int, splits: Mapping[int, tuple], parts: Mapping[int, list]) -> list[list]:
    """The nodes of a tree from its upper splits and the subtrees below them."""
    if node not in splits:
        return parts[node]
    feature, place, gain = splits[node]
    left, right = (_joined(2 * node + side, splits, parts) for side in (0, 1))

    def moved(nodes: list[list], by: int) -> list[list]:
        return [[f, p, a + by if f >= 0 else -1, b + by if f >= 0 else -1, g, v] for f, p, a, b, g, v in nodes]

    root = [feature, place, 1, 1 + len(left), gain, [0.0] * len(left[0][5])]
    return [root, *moved(left, 1), *moved(right, 1 + len(left))]


def fit_boosting(
    rows: DataFrame, *, features: Sequence[str], targets: Sequence[str], rounds: int, step: float, depth: int
) -> TreeModel | None:
    """Boosted trees of every target, a task each; None if the table has more than ``LOCAL_ROWS`` rows.

    The first tree counts in full and the others ``step`` times, as with the engine's learner.
    """
    table, cuts = binned(rows, features, targets)
    if table.count() > LOCAL_ROWS:
        return None
    every = F.explode(F.sequence(F.lit(0), F.lit(len(targets) - 1))).alias("tree")

    def boost(key: tuple, part: pa.Table) -> pa.Table:
        own, part = key[0].as_py(), part.combine_chunks()
        bins, y = _codes(part["bins"].chunk(0)), part["y"].to_numpy()
        base, weight, out = y.mean(), np.ones(len(y)), []
        rest = y - base
        for i in range(rounds):
            nodes = grow(bins, rest[:, None], weight, depth, 2, 1)
            at, moving = np.zeros(len(y), np.int64), np.arange(len(y))
            feature, place, left, right, gain, value = map(np.array, zip(*nodes))
            while len(moving):
                moving = moving[feature[at[moving]] >= 0]
                node = at[moving]
                at[moving] = np.where(bins[moving, feature[node]] <= place[node], left[node], right[node])
            rest = rest - (step if i else 1.0) * value[at, 0]
            out.append((own, i, feature.tolist(), place.tolist(), left.tolist(), right.tolist(), gain.tolist(), value[:, 0].tolist()))
        out.append((own, -1, [], [], [], [], [], [float(base)]))
        return _table(out, _TREES_ARROW)

    own = table.select(every, "bins", "y").select("tree", "bins", F.get("y", F.col("tree")).alias("y"))
    own = own.repartitionById(len(targets), F.col("tree"))  # so small a table would be merged into one task
    ensemble = Ensemble(len(targets))
    for r in sorted(own.groupBy("tree").applyInArrow(boost, _TREES).collect(), key=lambda r: (r["tree"], r["node"])):  # the model
        if r["node"] < 0:
            ensemble.base[r["tree"]] = r["value"][0]
        else:
            nodes = list(zip(r["feature"], r["place"], r["left"], r["right"], r["gain"], [[v] for v in r["value"]]))
            ensemble.add(nodes, cuts, step if r["node"] else 1.0, r["tree"])
    return TreeModel(features=list(features), targets=list(targets), trees=ensemble.packed())
