import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark import schema as T
from tidemark.operators import drift as X
from tidemark.operators import quality as Q
from tidemark.operators import report as P


def test_completeness_and_validation(spark, series):
    df = series({"a": [1, None, 3, None], "b": range(120)})
    got = {r.series_key: (r.missing_cells, r.completeness) for r in Q.completeness(df, key="series_key", columns=["value"]).collect()}
    assert got == {"a": (2, 50.0), "b": (0, 100.0)}
    wide = df.withColumns({f"c{i}": F.col("value") for i in range(5)})
    checked = {r.series_key: r for r in Q.validate_series(wide, key="series_key").collect()}
    assert checked["b"].valid and checked["b"].errors == []
    assert checked["a"].errors == ["too few rows", "too many missing values"]


def test_staleness(spark):
    series = spark.createDataFrame([("a",), ("b",), ("c",)], "k string")
    trained = spark.createDataFrame([("a", "2024-01-01"), ("a", "2024-01-08"), ("b", "2024-01-03")], "k string, at string")
    trained = trained.withColumn("at", F.to_date("at"))
    out = Q.staleness(series, trained, key="k", trained_at="at", as_of=F.lit("2024-01-10").cast("date"))
    got = {r.k: (r.days_since_training, r.should_retrain, r.next_retrain_in) for r in out.collect()}
    assert got == {"a": (2, False, 5), "b": (7, True, 0), "c": (999, True, 0)}


def test_quality_report_and_alerts(spark):
    df = spark.createDataFrame(
        [("a", i, float(i % 5)) for i in range(20)] + [("a", 19, 500.0), ("a", 21, None)], "k string, id int, v double"
    )
    out = Q.quality_report(df, key="k", columns=["v"], identity=["id"], ranges={"v": (0, 10)}).first()
    assert math.isclose(out.null_share, 1 / 22) and math.isclose(out.duplicate_share, 1 / 22)
    assert math.isclose(out.outlier_share, 1 / 21) and out.outlier_ok and not out.range_ok
    measures = spark.createDataFrame([("drift", 0.6), ("drift", 0.4), ("data_quality", 0.6), ("data_quality", 0.8), ("other", 9.0)], "kind string, value double")
    assert {(r.kind, r.value) for r in Q.alerts(measures, kind="kind", value="value").collect()} == {("drift", 0.6), ("data_quality", 0.6)}


@pytest.fixture(scope="module")
def samples(spark):
    rng = np.random.default_rng(3)
    base, recent = rng.integers(0, 60, 400), rng.integers(10, 80, 150)
    rows = [("a", float(v), False) for v in base] + [("a", float(v), True) for v in recent]
    return base, recent, spark.createDataFrame(rows, "k string, v double, is_recent boolean").cache()


def test_ks_and_wasserstein_equal_brute_force(samples):
    base, recent, df = samples
    points = np.arange(0, 81)
    f, g = ((s[None, :] <= points[:, None]).mean(1) for s in (base, recent))
    shares = X.cumulative_shares(df, key="k", value="v", recent="is_recent").cache()
    assert math.isclose(X.kolmogorov_smirnov(shares, key="k").first().ks, np.abs(f - g).max())
    assert math.isclose(X.wasserstein(shares, key="k", value="v").first().wasserstein, np.abs(f - g)[:-1].sum())
    shares.unpersist()


def test_binned_statistics_equal_brute_force(samples):
    base, recent, df = samples
    edges = np.quantile(base, [i / 10 for i in range(1, 10)])
    p, q = (np.bincount(np.searchsorted(edges, s, side="left"), minlength=10) / len(s) for s in (base, recent))
    counts = X.binned_counts(df, key="k", value="v", recent="is_recent").cache()
    pp, qq = np.maximum(p, X.EPSILON), np.maximum(q, X.EPSILON)
    assert math.isclose(X.psi(counts, key="k").first().psi, ((qq - pp) * np.log(qq / pp)).sum())
    m = (p + q) / 2
    js = sum(x * np.log2(x / y) for s in (p, q) for x, y in zip(s, m) if x > 0) / 2
    assert math.isclose(X.js_divergence(counts, key="k").first().js_divergence, js)
    counts.unpersist()


def test_chi_square_and_verdict(spark):
    rows = [("a", "x", False)] * 50 + [("a", "y", False)] * 50 + [("a", "x", True)] * 15 + [("a", "y", True)] * 5
    df = spark.createDataFrame(rows + [("a", "z", True)], "k string, c string, is_recent boolean")
    out = X.chi_square(df, key="k", category="c", recent="is_recent").first()
    assert math.isclose(out.chi_square, (15 - 10.5) ** 2 / 10.5 + (5 - 10.5) ** 2 / 10.5)
    assert (out.degrees, out.new_categories) == (1, 1)
    scored = spark.createDataFrame([(0.2, 99), (0.2, 100), (0.05, 100)], "psi double, n int")
    got = [r.drifted for r in X.drift_verdict(scored, "psi", threshold=0.1, enough=["n"]).collect()]
    assert got == [None, True, False]


def test_overall_drift(spark):
    rows = [("a", True), ("a", False), ("a", None), ("b", False), ("b", False), ("c", None)]
    out = X.overall_drift(spark.createDataFrame(rows, "k string, drifted boolean"), key="k").collect()
    assert {r.k: (r.n_verdicts, r.drift_share, r.overall_drift) for r in out} == {
        "a": (2, 0.5, True), "b": (2, 0.0, False), "c": (0, None, False),
    }


def test_recent_window(spark, series):
    df = X.label_samples(series({"a": range(40)}), key="series_key", day="day")
    assert df.where("is_recent").count() == 30


def test_dashboard(spark, series):
    df = series({"a": [1.25, None, 0.35]})
    shown = P.dashboard_series(df, key="series_key", day="day", columns={"t": "value"}, n=2).orderBy("day").collect()
    assert [r.t for r in shown] == [0.0, 0.4]
    packed = P.chart_arrays(df, key="series_key", day="day", columns=["value"]).first()
    assert packed.value == [1.25, None, 0.35]
    today = df.where("value = 0.35")
    assert P.append_today(df, today, keys=["series_key", "day"]).count() == 3
    predicted = spark.createDataFrame([("b", 1.0)], "series_key string, temperature_2m_max double")
    latest = spark.createDataFrame([("a",)], "series_key string")
    assert P.headline(latest, predicted, key="series_key", columns=["temperature_2m_max"]).first()[1] == 25.0


def test_retention_and_range(spark, series):
    df = series({"a": range(100)})
    kept = P.retention_split(df, day="day", as_of=F.lit("2023-04-10").cast("date"), keep_days=30, archive_days=90)
    assert {r.retention: r["count"] for r in kept.groupBy("retention").count().collect()} == {"keep": 31, "archive": 60, "delete": 9}
    assert P.history_range(df, day="day", first="2023-01-02", last="2023-01-04").count() == 3


def test_schema_helpers(spark):
    df = spark.createDataFrame([], "humid double, `Max Temp` double, temp_lag_1 double, rain_sum double, wind_a int, wind_b int, wind_c int, name string")
    assert T.columns_named(df, ["TEMP"]) == ["Max Temp", "temp_lag_1"]
    assert T.detect_targets(df) == ["Max Temp"]
    assert T.detect_measures(df) == {"value": "Max Temp", "rain": "rain_sum", "wind": ["wind_a", "wind_b"]}
    listed = spark.createDataFrame([], "temperature_2m_max double, temperature_2m_mean double")
    assert T.detect_targets(listed) == ["temperature_2m_mean", "temperature_2m_max"]
    assert "name" not in T.numeric_columns(df)
    with pytest.raises(ValueError):
        T.require_columns(df, ["absent"])
    expected = T.daily_schema()
    assert T.schema_differences(spark.createDataFrame([], expected), expected) == []
    assert "missing column day" in T.schema_differences(df, expected)
