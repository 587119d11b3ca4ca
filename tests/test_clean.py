import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from tidemark.operators import clean as C
from tidemark.operators.quantiles import daily_quantiles, modes, raw_quantiles
from tidemark.operators.resample import HOURLY_RULES, daily_rollup, densify_daily
from tidemark.plans.preparation import preprocess
from tidemark.schema import nan_to_null

QUICK = settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
VALUES = st.lists(st.one_of(st.none(), st.integers(-50, 50)), min_size=1, max_size=25)


@pytest.mark.parametrize("blocks", [False, True])
def test_interpolation_fixture(spark, series, column, blocks):
    df = series({"a": [None, 1, None, None, 4, None]})
    out = C.interpolate_linear(df, key="series_key", order=["day"], columns=["value"], blocks=blocks)
    assert column(out, "value") == [1, 1, 2, 3, 4, 4]


@QUICK
@given(values=st.dictionaries(st.sampled_from("abc"), VALUES, min_size=1))
def test_interpolation_equals_pandas(spark, series, column, values):
    expected = []
    for k in sorted(values):
        s = pd.Series(values[k], dtype=float).interpolate("linear", limit_direction="both")
        expected += [None if pd.isna(v) else v for v in s]
    for blocks in (False, True):
        out = C.interpolate_linear(series(values), key="series_key", order=["day"], columns=["value"], blocks=blocks)
        got = column(out, "value")
        assert [v is None for v in got] == [v is None for v in expected]
        assert np.allclose([v for v in got if v is not None], [v for v in expected if v is not None])


def test_interpolation_across_many_blocks(spark, column):
    rows = spark.range(0, 5000, numPartitions=4).select(
        F.lit("a").alias("series_key"),
        F.col("id").alias("day"),
        F.when((F.col("id") < 700) | (F.col("id") > 4100), F.col("id").cast("double")).alias("value"),
    )
    out = C.interpolate_linear(rows, key="series_key", order=["day"], columns=["value"], blocks=True)
    assert out.where(F.abs(F.col("value") - F.col("day")) > 1e-6).count() == 0


def test_fill_forward_backward(spark, series, column):
    out = C.fill_forward_backward(series({"a": [None, 2, None, 5, None]}), key="series_key", order=["day"], columns=["value"])
    assert column(out, "value") == [2, 2, 2, 5, 5]


@pytest.mark.parametrize("quantiles", [daily_quantiles, raw_quantiles])
def test_quantiles_fixture(spark, series, quantiles):
    out = quantiles(series({"a": [1, 2, 4, 8], "b": [0] * 9 + [5]}), ["series_key"], ["value"], [0.25, 0.5, 0.75])
    got = {r.series_key: list(r.quantiles) for r in out.collect()}
    assert got == {"a": [1.75, 3, 5], "b": [0, 0, 0]}


@QUICK
@given(values=st.lists(st.integers(-20, 20), min_size=1, max_size=40))
def test_raw_quantiles_equal_numpy(spark, series, values):
    probs = [0.0, 0.1, 0.25, 0.5, 0.9, 1.0]
    got = raw_quantiles(series({"a": values}), ["series_key"], ["value"], probs).first().quantiles
    assert np.allclose(got, np.quantile(values, probs))


def test_raw_quantiles_with_enclosures(spark):
    """A sketch this coarse leaves most readings outside the enclosures."""
    rng = np.random.default_rng(11)
    values = {"hot": rng.normal(0, 50, 8000).round(2), "tied": rng.integers(0, 3, 1500) * 1.0, "small": rng.normal(0, 1, 30)}
    rows = [(k, float(v)) for k, vs in values.items() for v in vs]
    df = spark.createDataFrame(rows, "series_key string, value double").repartition(5)
    probs = [0.0, 0.1, 0.25, 0.26, 0.5, 0.75, 0.99, 1.0]
    got = raw_quantiles(df, ["series_key"], ["value"], probs, accuracy=200).collect()
    assert len(got) == 3
    for r in got:
        assert np.allclose(r.quantiles, np.quantile(values[r.series_key], probs))


@pytest.mark.parametrize("daily", [True, False])
@pytest.mark.parametrize("mode,last", [("replace", 0.0), ("skip", 5.0)])
def test_zero_iqr(spark, series, column, daily, mode, last):
    df = series({"a": [0] * 9 + [5]})
    out = C.replace_outliers(df, key="series_key", columns=["value"], zero_iqr=mode, daily=daily)
    assert column(out, "value") == [0.0] * 9 + [last]


def test_outliers_replaced_and_counted_per_series(spark, series, column):
    df = series({"a": [1, 2, 3, 4, 100], "b": [100, 101, 102, 103, None]})
    out = C.replace_outliers(df, key="series_key", columns=["value"])
    assert column(out, "value") == [1, 2, 3, 4, 3, 100, 101, 102, 103, None]
    counts = C.count_outliers(df, key="series_key", columns=["value"]).orderBy("series_key").collect()
    assert [(r.n_values, r.n_outliers) for r in counts] == [(5, 1), (4, 0)]


def test_limits_can_be_learned_from_a_part(spark, series):
    df = series({"a": [1, 2, 3, 4, 100, 100, 100, 100]})
    fitted = C.iqr_bounds(df, key="series_key", columns=["value"], fit_on=F.col("day") < "2023-01-05").first()
    assert (fitted.q1, fitted.median, fitted.q3) == (1.75, 2.5, 3.25)


def test_bad_mode_is_an_error(spark, series):
    with pytest.raises(ValueError):
        C.replace_outliers(series({"a": [1]}), key="series_key", columns=["value"], zero_iqr="other")


def test_exact_duplicates(spark):
    df = spark.createDataFrame([(1, "x"), (1, "x"), (1, None), (1, None), (2, "y")], "a int, b string")
    assert C.drop_exact_duplicates(df).count() == 3
    assert C.count_exact_duplicates(df).first().asDict() == {"n_rows": 5, "n_distinct": 3, "n_duplicates": 2}


def test_keep_last_does_not_depend_on_order(spark):
    rows = [("a", 1, 10), ("a", 2, 20), ("a", 3, 5), ("b", 1, 7)]
    for order in (rows, rows[::-1]):
        df = spark.createDataFrame(order, "k string, version int, v int")
        got = C.keep_last(df, keys=["k"], priority=["version"]).collect()
        assert sorted(map(tuple, got)) == [("a", 3, 5), ("b", 1, 7)]


def test_preprocess(spark, series, column):
    # Repeats disappear at the end; until then gaps are filled by row position, so a repeated
    # gap counts as two rows and its fillings differ.
    whole = series({"a": [1, 2, 3, 4]})
    assert preprocess(whole.union(whole), key="series_key", day="day", columns=["value"]).count() == 4
    df = series({"a": [1, None, 3, 4, 500, 4, 3, 2, 1]})
    assert preprocess(df.union(df), key="series_key", day="day", columns=["value"]).count() == 10
    out = preprocess(df, key="series_key", day="day", columns=["value"])
    assert column(out, "value") == [1, 2, 3, 4, 3, 4, 3, 2, 1]


def test_nan_becomes_null(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),)], "v double")
    assert nan_to_null(df).where("v is null").count() == 1


def test_mode_takes_the_smallest_tie(spark):
    df = spark.createDataFrame([("a", v) for v in (3, 1, 1, 3, 2)], "k string, v int")
    assert modes(df, ["k"], "v", "top").first().top == 1


def test_rollup_of_missing_and_tied_readings(spark):
    columns = sorted({c for _, c in HOURLY_RULES.values()})
    schema = "k string, ts timestamp, " + ", ".join(f"{c} double" for c in columns)
    import datetime

    def reading(hour, **values):
        return ("a", datetime.datetime(2024, 1, 1, hour), *[values.get(c) for c in columns])

    rows = [
        reading(0, temperature_2m=10.0, winddirection_10m=3.0, weathercode=2.0, precipitation=0.0),
        reading(1, temperature_2m=14.0, winddirection_10m=1.0, precipitation=1.5),
        reading(2, winddirection_10m=1.0, precipitation=0.5),
        reading(3, winddirection_10m=3.0),
    ]
    out = daily_rollup(spark.createDataFrame(rows, schema), key="k", ts="ts", rules=HOURLY_RULES).first()
    assert (out.temperature_2m_max, out.temperature_2m_min, out.temperature_2m_mean) == (14.0, 10.0, 12.0)
    assert (out.precipitation_sum, out.precipitation_hours) == (2.0, 2)
    assert out.snowfall_sum == 0.0  # all readings missing
    assert out.winddirection_10m_dominant == 1.0
    assert out.weathercode == 2.0
    assert out.relative_humidity_2m is None


def test_rollup_with_only_mode_rules(spark):
    df = spark.createDataFrame([("a", 1, 5)], "k string, t int, v int").withColumn("ts", F.lit("2024-01-01").cast("timestamp"))
    out = daily_rollup(df, key="k", ts="ts", rules={"m": ("mode_or_mean", "v")}).collect()
    assert [r.m for r in out] == [5]


def test_densify(spark, series):
    df = series({"a": [1], "b": [5]}).union(series({"a": [4]}, first="2023-01-04"))
    out = densify_daily(df, key="series_key").orderBy("series_key", "day").collect()
    assert [(r.series_key, r.day.day, r.value) for r in out] == [
        ("a", 1, 1.0), ("a", 2, None), ("a", 3, None), ("a", 4, 4.0), ("b", 1, 5.0),
    ]
