"""Least squares for every series at once, from cross products that add up.

A series' rows become one matrix of cross products of its features and labels, in one
aggregation; any number of labels (targets, horizons) shares it.  Matrices of disjoint rows add
up, so the training matrix of fold k is the sum of those of the folds before it, and the squared
error on a fold follows from that fold's own matrix: neither a refit nor a scoring pass reads
the rows again.  The systems are solved by elimination inside expressions, one row per series.

Features and labels are centred and scaled within the series beforehand, so that the products
stay well conditioned.  A feature that the features before it determine (as lag plus difference
do) has a pivot of nothing and gets the coefficient 0; predictions do not depend on that choice.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..schema import require_columns
from .framing import series_window
from .split_scale import SPLIT_RATIO, temporal_split

# Share of a feature's own sum of squares below which the features before it determine it.
DETERMINED = 1e-9


def _once(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _complete(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows without a missing value.  One condition over an array: from many single ones the optimizer
    would infer conditions on all their combinations."""
    values = F.array(*(F.col(f"`{c}`").cast("double") for c in columns))
    return df.where(F.forall(values, lambda v: v.isNotNull()))


def standardised(df: DataFrame, *, key: str, columns: Sequence[str]) -> DataFrame:
    """Columns centred and scaled within their series, and ``_scale``: (mean, std) of each by name."""
    whole = Window.partitionBy(key)
    value = {c: F.col(f"`{c}`").cast("double") for c in columns}
    stats = {c: (F.avg(v).over(whole), F.stddev_pop(v).over(whole)) for c, v in value.items()}
    out = df.withColumns({f"_m{i}": m for i, (m, _) in enumerate(stats.values())} | {f"_s{i}": s for i, (_, s) in enumerate(stats.values())})
    spread = [F.when(F.col(f"_s{i}") > 0, F.col(f"_s{i}")).otherwise(1.0) for i in range(len(columns))]
    scale = F.array(*(F.struct(F.col(f"_m{i}").alias("mean"), s.alias("std")) for i, s in enumerate(spread)))
    scaled = {c: (value[c] - F.col(f"_m{i}")) / spread[i] for i, c in enumerate(columns)}
    return out.withColumn("_scale", scale).withColumns(scaled).drop(*(f"_{k}{i}" for k in "ms" for i in range(len(columns))))


def cross_products(df: DataFrame, *, groups: Sequence[str], features: Sequence[str], labels: Sequence[str]) -> DataFrame:
    """One row per group: ``xy``, the products of (1, features) with (1, features, labels), and ``yy`` of each label.

    ``df`` comes from ``standardised`` and has no missing values.
    """
    require_columns(df, [*groups, *features, *labels])
    names = [*features, *labels]
    whole = df.select(*groups, *(F.col(c).cast("double").alias(f"_{i}") for i, c in enumerate(names)), "_scale")
    # One row per regressor keeps the sums few; they are added up before anything moves.
    regressors = F.array(F.lit(1.0), *(F.col(f"_{i}") for i in range(len(features))))
    spread = whole.select("*", F.posexplode(regressors).alias("_row", "_u"))
    products = [F.sum("_u"), *(F.sum(F.col("_u") * F.col(f"_{i}")) for i in range(len(names)))]
    first = F.when(F.col("_row") == 0, 1.0)
    squares = [F.sum(first * F.col(f"_{i}") * F.col(f"_{i}")) for i in range(len(features), len(names))]
    sums = spread.groupBy(*groups, "_row").agg(
        *(e.alias(f"_p{i}") for i, e in enumerate(products)), *(e.alias(f"_q{i}") for i, e in enumerate(squares)),
        F.first("_scale").alias("_scale"),
    )
    line = F.struct(
        "_row", F.array(*(F.col(f"_p{i}") for i in range(len(products)))).alias("line"),
        F.array(*(F.col(f"_q{i}") for i in range(len(squares)))).alias("squares"),
    )
    gathered = sums.groupBy(*groups).agg(F.array_sort(F.collect_list(line)).alias("lines"), F.first("_scale").alias("_scale"))
    return gathered.select(
        *groups, F.transform("lines", lambda x: x["line"]).alias("xy"), F.get("lines", F.lit(0))["squares"].alias("yy"), "_scale"
    )


def added(a: Column, b: Column) -> Column:
    """The sum of two matrices."""
    return F.zip_with(a, b, lambda p, q: F.zip_with(p, q, lambda x, y: x + y))


def solved(xy: Column, size: int) -> Column:
    """Coefficients, a row for each of ``size`` regressors with one for every label, by Gauss-Jordan elimination."""

    def eliminated(matrix: Column, k: Column, rows: Column) -> Column:
        def by(own: Column) -> Column:
            pivot = F.get(own, k)

            def clear(r: Column, i: Column) -> Column:
                gone = F.zip_with(r, own, lambda a, b: a - F.get(r, k) / pivot * b)
                return F.when(i == k, F.transform(own, lambda v: v / pivot)).otherwise(gone)

            def leave_out(r: Column, i: Column) -> Column:
                return F.transform(r, lambda v, j: F.when((i == k) | (j == k), 0.0).otherwise(v))

            # A scaled feature's own sum of squares is about the number of rows.
            return F.when(pivot > DETERMINED * rows, F.transform(matrix, clear)).otherwise(F.transform(matrix, leave_out))

        return _once(F.get(matrix, k), by)

    steps = F.sequence(F.lit(0), F.lit(size - 1))
    whole = _once(F.get(F.get(xy, F.lit(0)), F.lit(0)), lambda n: F.aggregate(steps, xy, lambda m, k: eliminated(m, k, n)))
    return F.transform(whole, lambda r: F.slice(r, F.lit(size + 1), F.size(r)))


def _dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, v: s + v)


def squared_errors(coefficients: Column, xy: Column, yy: Column, size: int) -> Column:
    """Sum of squared errors of every label on the rows that the products stand for."""

    def of(total: Column, t: Column) -> Column:
        def with_own(b: Column) -> Column:
            cross = _dot(b, F.transform(xy, lambda r: F.get(r, t + size)))
            inner = F.transform(xy, lambda r: _dot(b, F.slice(r, F.lit(1), F.lit(size))))
            return F.greatest(total - 2 * cross + _dot(b, inner), F.lit(0.0))

        return _once(F.transform(coefficients, lambda r: F.get(r, t)), with_own)

    return F.transform(yy, of)


def expanding(products: DataFrame, *, key: str, fold: str) -> DataFrame:
    """For every fold but the first of a series: the sum of the matrices before it, and its own.

    A series has a handful of folds, so its matrices meet in one row.
    """
    entry = F.struct(F.col(fold).alias("fold"), "xy", "yy")
    gathered = products.groupBy(key).agg(F.array_sort(F.collect_list(entry)).alias("entries"), F.first("_scale").alias("_scale"))

    def with_sum(state: Column, x: Column) -> Column:
        found = F.struct(x["fold"].alias("fold"), state["sum"].alias("train"), x["xy"].alias("test"), x["yy"].alias("yy"))
        return F.struct(added(state["sum"], x["xy"]).alias("sum"), F.concat(state["found"], F.array(found)).alias("found"))

    kind = dict(products.dtypes)
    none = F.array().cast(f"array<struct<fold:{kind[fold]},train:{kind['xy']},test:{kind['xy']},yy:{kind['yy']}>>")
    start = F.struct(F.get("entries", F.lit(0))["xy"].alias("sum"), none.alias("found"))
    later = F.slice("entries", F.lit(2), F.greatest(F.size("entries") - 1, F.lit(0)))
    pairs = F.aggregate(later, start, with_sum, lambda s: s["found"])
    return gathered.select(key, "_scale", F.inline(pairs))


def fitted(pairs: DataFrame, *, key: str, features: Sequence[str], labels: Sequence[str]) -> DataFrame:
    """(key, fold, label, n_train, n_test, intercept, coefficients, rmse, r2) of every series, fold and label.

    Coefficients are in the units of the features; errors are those on the fold.
    """
    size = len(features) + 1
    with_b = pairs.withColumn("b", solved(F.col("train"), size))
    with_e = with_b.withColumn("sse", squared_errors(F.col("b"), F.col("test"), F.col("yy"), size))

    def corner(matrix: str) -> Column:
        return F.get(F.get(matrix, F.lit(0)), F.lit(0))

    own = F.slice("_scale", F.lit(1), F.lit(size - 1))

    def result(label: Column, t: Column) -> Column:
        spread = F.get("_scale", t + (size - 1))
        raw = F.transform(own, lambda x, i: F.get(F.get("b", i + 1), t) * spread["std"] / x["std"])
        shift = _dot(raw, F.transform(own, lambda x: x["mean"]))
        n, sse = corner("test"), F.get("sse", t)
        total = F.get(F.get("test", F.lit(0)), t + size)
        sst = F.get("yy", t) - total * total / n
        # A label that does not vary leaves nothing to explain.
        r2 = F.when(sst > DETERMINED * n, 1 - sse / sst).when(sse <= DETERMINED * n, 1.0).otherwise(0.0)
        return F.struct(
            label.alias("label"),
            corner("train").cast("long").alias("n_train"),
            n.cast("long").alias("n_test"),
            (spread["mean"] + spread["std"] * F.get(F.get("b", F.lit(0)), t) - shift).alias("intercept"),
            F.map_from_arrays(F.array(*map(F.lit, features)), raw).alias("coefficients"),
            (F.sqrt(sse / n) * spread["std"]).alias("rmse"),
            r2.alias("r2"),
        )

    return with_e.select(key, "fold", F.inline(F.transform(F.array(*map(F.lit, labels)), result)))


def validate(df: DataFrame, *, key: str, fold: str, features: Sequence[str], labels: Sequence[str]) -> DataFrame:
    """Expanding-window validation of every series and label: fold k against a fit on the folds before it.

    The rows are read once, whatever the number of folds, and shuffled by series once.
    """
    scaled = standardised(_complete(df, [*features, *labels]), key=key, columns=[*features, *labels])
    products = cross_products(scaled, groups=[key, fold], features=features, labels=labels)
    return fitted(expanding(products, key=key, fold=fold), key=key, features=features, labels=labels)


def models_by_series(
    df: DataFrame, *, key: str, day: str, features: Sequence[str], targets: Sequence[str], horizons: Sequence[int], ratio: float = SPLIT_RATIO
) -> DataFrame:
    """One linear model for each series, target and number of days ahead, with its errors on the test rows.

    Labels are the targets that many rows ahead; the first ``ratio`` of a series' complete rows trains.
    """
    window = series_window([key], day)
    names = {f"{t}:{h}": (t, h) for t in targets for h in horizons}
    rows = df.withColumns({n: F.lead(t, h).over(window) for n, (t, h) in names.items()})
    rows = temporal_split(_complete(rows, [*features, *names]), key=key, order=[day], ratio=ratio)
    rows = rows.withColumn("fold", F.when(F.col("split") == "train", 1).otherwise(2))
    found = validate(rows, key=key, fold="fold", features=features, labels=list(names))
    parts = F.split("label", ":(?=[0-9]+$)")
    return found.select(
        key, F.get(parts, F.lit(0)).alias("target"), F.get(parts, F.lit(1)).cast("int").alias("horizon"),
        "n_train", "n_test", "intercept", "coefficients", "rmse", "r2",
    )
