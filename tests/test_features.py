import datetime
import math

import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from tidemark.functions import calendar as K
from tidemark.operators import features as W
from tidemark.operators.framing import blocked, running_totals, series_window, with_positions
from tidemark.operators.ingest import with_scenarios
from tidemark.operators.split_scale import apply_scaler, fit_scaler, split_by_date, temporal_split, temporal_split_raw, time_folds
from tidemark.schema import FEATURES

QUICK = settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
NUMBERS = st.lists(st.integers(-100, 100), min_size=1, max_size=45)


def window():
    return series_window(["series_key"], "day")


def close(got, expected):
    expected = [None if pd.isna(v) else v for v in expected]
    assert [v is None for v in got] == [v is None for v in expected]
    assert np.allclose([v for v in got if v is not None], [v for v in expected if v is not None])


@QUICK
@given(values=NUMBERS)
def test_window_features_equal_pandas(spark, series, column, values):
    s = pd.Series(values, dtype=float)

    def slope(x):
        return np.polyfit(np.arange(len(x)), x, 1)[0] if len(x) > 1 else 0.0

    df = series({"a": values}).withColumn("pos", F.row_number().over(window()))
    out = W.window_features(df, value="value", position="pos", window=window()).cache()
    for k in W.LAGS:
        close(column(out, f"f_lag_{k}"), s.shift(k))
    for n in W.MEANS:
        close(column(out, f"f_ma_{n}"), s.rolling(n, min_periods=1).mean())
    close(column(out, "f_trend_30"), s.rolling(30, min_periods=1).apply(slope, raw=True))
    close(column(out, "f_volatility_7"), s.rolling(7, min_periods=1).std())
    for k in W.DIFFERENCES:
        close(column(out, f"f_diff_{k}"), s.diff(k))
    out.unpersist()


@QUICK
@given(values=st.lists(st.one_of(st.none(), st.integers(0, 9)), min_size=1, max_size=40))
def test_full_windows_equal_pandas(spark, series, column, values):
    s = pd.Series(values, dtype=float)
    df = series({"a": values})
    out = df.withColumns(W.rolling_sums("value", window()) | W.rolling_means_full(["value"], window()))
    close(column(out, "f_sum_7"), s.rolling(7).sum())
    close(column(out, "f_sum_30"), s.rolling(30).sum())
    close(column(out, "f_value_mean_7"), s.rolling(7).mean())


def test_short_slopes_and_deviation(spark, series, column):
    df = series({"a": [1, 3, 7, 4]}).withColumn("pos", F.row_number().over(window()))
    out = df.withColumns(W.rolling_trend("value", "pos", window(), 3))
    close(column(out, "f_trend_3"), [0, 2, 3, 0.5])
    out = series({"a": [5, 6]}).withColumns(W.rolling_volatility("value", window()))
    close(column(out, "f_volatility_7"), [None, 0.70711067])


def test_rows_and_days_differ_on_gaps_only(spark, series, column):
    df = series({"a": [1, 2, 3, 4, 5, 6, 7, 8]}).where(F.dayofmonth("day") != 4)
    days = df.withColumn("n", F.unix_date("day"))
    by_day = days.withColumns(W.moving_averages("value", series_window(["series_key"], "n"), [3], "days"))
    close(column(by_day, "f_ma_3"), [1, 1.5, 2, 4, 5.5, 6, 7])
    by_row = df.withColumns(W.moving_averages("value", window(), [3]))
    close(column(by_row, "f_ma_3"), [1, 1.5, 2, 10 / 3, 14 / 3, 6, 7])
    with pytest.raises(ValueError):
        W.frame_of(window(), 3, "weeks")


@pytest.mark.parametrize("rows_per_block", [40, 128, 100_000])
def test_blocks_with_halo_equal_whole_windows(spark, rows_per_block):
    rows = spark.range(0, 1500, numPartitions=6).select(
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 50 == 1, "small").otherwise("warm").alias("series_key"),
        F.col("id").alias("day"),
        (F.sin("id") * 100).alias("value"),
    )

    def compute(df, w):
        return W.window_features(df, value="value", position="_pos", window=w)

    pieces = blocked(rows, ["series_key"], ["day"], halo=30, rows_per_block=rows_per_block, compute=compute)
    whole = compute(rows.withColumn("_pos", F.row_number().over(window())), window())
    names = [c for c in pieces.columns if c.startswith("f_")]
    both = pieces.alias("p").join(whole.alias("w"), ["series_key", "day"])
    unequal = [
        F.count_if(
            F.col(f"p.{n}").isNull() != F.col(f"w.{n}").isNull()
        ) + F.count_if(F.abs(F.col(f"p.{n}") - F.col(f"w.{n}")) > 1e-9)
        for n in ["_pos", *names]
    ]
    result = both.agg(F.count("*").alias("n"), *[u.alias(f"u{i}") for i, u in enumerate(unequal)]).first()
    assert result.n == 1500 and not any(result[1:])


def test_block_shorter_than_halo_is_an_error(spark, series):
    with pytest.raises(ValueError):
        blocked(series({"a": [1]}), ["series_key"], ["day"], halo=30, rows_per_block=10, compute=lambda d, w: d)


def test_running_totals_and_positions_of_a_hot_key(spark):
    rows = spark.range(0, 3000, numPartitions=5).select(
        F.when(F.col("id") < 2500, "hot").otherwise("cold").alias("k"), "id", (F.col("id") % 7).alias("v")
    )
    got = running_totals(
        rows, ["k"], ["id"], {"upto": F.col("v")}, overall={"upto": "everything"}, following={"next_id": F.col("id")}
    ).toPandas().sort_values(["k", "id"])
    for _, part in got.groupby("k"):
        assert (part["upto"] == part["v"].cumsum()).all()
        assert (part["everything"] == part["v"].sum()).all()
        assert part["next_id"].tolist()[:-1] == part["id"].tolist()[1:] and pd.isna(part["next_id"].iloc[-1])
    placed = with_positions(rows, ["k"], ["id"], "pos", total="n").toPandas().sort_values(["k", "id"])
    for _, part in placed.groupby("k"):
        assert part["pos"].tolist() == list(range(1, len(part) + 1)) and (part["n"] == len(part)).all()


def test_matrix_keeps_complete_rows_and_shows_the_leak(spark, series):
    df = series({"a": range(50), "b": range(20)})
    out = W.feature_matrix(df, key="series_key", day="day", value="value")
    assert out.count() == 20 and set(FEATURES) <= set(out.columns)
    leak = out.where((F.col("f_lag_1") + F.col("f_diff_1") != F.col("value")) | (F.col("f_lag_7") + F.col("f_diff_7") != F.col("value")))
    assert leak.count() == 0
    ahead = W.feature_matrix(df, key="series_key", day="day", value="value", horizon=2, targets=["value"])
    assert ahead.where("value_ahead != value + 2").count() == 0 and ahead.count() == 18
    assert "day" in out.columns and "f_day" in out.columns  # names do not clash


def test_rain_and_wind_features(spark, series):
    df = series({"a": range(40)}).withColumn("rain", F.lit(1.0)).withColumn("wind", F.lit(2.0))
    out = W.feature_matrix(df, key="series_key", day="day", value="value", rain="rain", wind=["wind"])
    assert out.select("f_sum_30", "f_wind_mean_7").distinct().collect() == [(30.0, 2.0)]


def test_last_rows_and_latest(spark, series):
    df = series({"a": range(10), "b": range(3)})
    assert W.last_rows(df, key="series_key", order="day", n=4).count() == 7
    newest = W.latest_row(df, key="series_key", order=["day"]).orderBy("series_key").collect()
    assert [r.value for r in newest] == [9, 2]


def test_calendar(spark):
    df = spark.sql("select explode(array(date'2021-01-03', date'2024-12-31', date'2024-06-15')) day")
    out = K.with_calendar_features(df, "day").orderBy("day").collect()
    assert (out[0].f_week_of_year, out[2].f_day_of_year, out[1].f_quarter) == (53, 366, 2)
    seasons = spark.range(1, 13).select(K.season(F.col("id")).alias("s")).collect()
    assert [r.s for r in seasons] == [1, 1, 2, 2, 2, 3, 3, 3, 4, 4, 4, 1]
    angle = K.with_cyclic_features(df, "day").orderBy("day").collect()[2]
    assert math.isclose(angle.f_day_of_year_sin, math.sin(2 * math.pi * 366 / 365))


def test_scenario_features_equal_appending_to_history(spark, series):
    history = series({"a": [(i * 7) % 31 for i in range(60)], "b": [(i * 5) % 29 for i in range(45)]})
    next_day = W.latest_row(history, key="series_key", order=["day"]).withColumn("day", F.date_add("day", 1))
    scenarios = next_day.select("series_key", "day", F.lit(99.0).alias("value"), F.lit("hot").alias("scenario_id"))
    joined = with_scenarios(history, scenarios, key="series_key")
    got = W.feature_matrix(joined, key="series_key", day="day", value="value").where("is_scenario")
    whole = history.union(scenarios.select("series_key", "day", "value"))
    expected = W.feature_matrix(whole, key="series_key", day="day", value="value").join(scenarios, ["series_key", "day"], "left_semi")
    a, b = (d.orderBy("series_key").select(*FEATURES).toPandas().astype(float) for d in (got, expected))
    assert len(a) == 2 and np.allclose(a, b)


def test_scenarios_take_the_days_before_their_first_one(spark, series):
    history = series({"a": range(60)})
    days = [("a", datetime.date(2023, 1, 1), 9.0, "at the start"), ("a", datetime.date(2023, 2, 10), 9.0, "within")]
    scenarios = spark.createDataFrame(days, "series_key string, day date, value double, scenario_id string")
    joined = with_scenarios(history, scenarios, key="series_key").where("not is_scenario")
    taken = {r.scenario_id: (r.n, r.a, r.b) for r in joined.groupBy("scenario_id").agg(
        F.count("*").alias("n"), F.min("value").alias("a"), F.max("value").alias("b")).collect()}
    assert taken == {"within": (W.feature_reach(), 10.0, 39.0)} and W.feature_reach() == 30
    with pytest.raises(ValueError):
        with_scenarios(history, scenarios, key="series_key", reach=W.feature_reach() - 1)


@pytest.mark.parametrize("split", [temporal_split, temporal_split_raw])
def test_temporal_split(spark, series, split):
    df = series({"a": range(10), "b": range(7), "c": [1]}).withColumn("day", F.col("day").cast("timestamp"))
    out = split(df, key="series_key", order=["day"])
    train = {r.series_key: r["count"] for r in out.where("split = 'train'").groupBy("series_key").count().collect()}
    assert train == {"a": 8, "b": 5} and out.count() == 18
    latest_train = out.where("split = 'train'").agg(F.max("value")).first()[0]
    assert latest_train == 7


def test_raw_split_cuts_inside_a_crowded_hour(spark):
    rows = spark.range(0, 1000, numPartitions=3).select(
        F.lit("hot").alias("k"), "id", F.expr("timestamp'2024-01-01 00:00:00' + make_interval(0,0,0,0,0,0,id)").alias("ts")
    )
    rows = rows.withColumn("ts", F.when(F.col("id") >= 100, F.lit("2024-01-01 05:30:00").cast("timestamp")).otherwise(F.col("ts")))
    out = temporal_split_raw(rows, key="k", order=["ts", "id"], ratio=0.5)
    ids = [r.id for r in out.where("split = 'train'").orderBy("id").collect()]
    assert ids == list(range(500)) and out.count() == 1000


def test_split_by_date_and_folds(spark, series, column):
    df = series({"a": range(10)})
    assert split_by_date(df, day="day", first_test_day="2023-01-04").where("split = 'train'").count() == 3
    assert column(time_folds(df, key="series_key", order=["day"]), "fold") == [1, 1, 2, 2, 3, 3, 4, 4, 5, 5]


def test_scaler_uses_training_rows_and_population_deviation(spark, series):
    df = temporal_split(series({"a": range(10)}), key="series_key", order=["day"]).withColumn("constant", F.lit(3.0))
    fitted = fit_scaler(df, key="series_key", features=["value", "constant"], fit_on=F.col("split") == "train")
    out = apply_scaler(df, fitted, key="series_key", features=["value", "constant"])
    train = out.where("split = 'train'").agg(F.avg("value"), F.stddev_pop("value"), F.max("constant")).first()
    assert np.allclose(list(train), [0, 1, 0])


def test_documented_extras(spark, series):
    df = series({"a": [5, 15, 40]}, first="2024-01-05")  # a Friday
    out = W.observation_extras(df, key="series_key", day="day", pressure="value", wind="value").orderBy("day").collect()
    assert [r.is_weekend for r in out] == [False, True, True]
    assert [r.pressure_change for r in out] == [None, 10, 25]
    assert [r.wind_category for r in out] == ["calm", "breeze", "strong"]
