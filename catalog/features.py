"""Window features, splits and scaling on the order series."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions.calendar import with_calendar_columns, with_calendar_features, with_cyclic_features
from tidemark.operators import features as W
from tidemark.operators.framing import blocked, series_window
from tidemark.operators.ingest import with_scenarios
from tidemark.operators.split_scale import apply_scaler, fit_scaler, split_by_date, temporal_split, temporal_split_raw, time_folds
from tidemark.plans.stages import SeriesScaler, SeriesScalerModel
from tidemark.schema import FEATURES
from tidemark.session import durable, work_path
from tidemark.sources.store import stage

from . import inputs as I
from .register import query, with_

KEY, DAY = "series_key", "day"
D = "double"

# Shared SQL of the value features over window names o, w3 ... w30.
WINDOWS = """WINDOW o AS (PARTITION BY series_key ORDER BY day),
  w3 AS (PARTITION BY series_key ORDER BY day ROWS 2 PRECEDING),
  w7 AS (PARTITION BY series_key ORDER BY day ROWS 6 PRECEDING),
  w14 AS (PARTITION BY series_key ORDER BY day ROWS 13 PRECEDING),
  w30 AS (PARTITION BY series_key ORDER BY day ROWS 29 PRECEDING)"""


def by_day():
    return series_window([KEY], DAY)


def _lags_sql() -> str:
    return ", ".join(f"CAST(LAG(value, {k}) OVER o AS DOUBLE) AS f_lag_{k}" for k in W.LAGS)


def _means_sql() -> str:
    return ", ".join(f"CAST(SUM(value) OVER w{n} AS DOUBLE) / COUNT(value) OVER w{n} AS f_ma_{n}" for n in W.MEANS)


def _diffs_sql() -> str:
    return ", ".join(f"CAST(value - LAG(value, {k}) OVER o AS DOUBLE) AS f_diff_{k}" for k in W.DIFFERENCES)


TREND_SQL = """ROUND(CASE WHEN COUNT(*) OVER w30 > 1
  THEN REGR_SLOPE(CAST(value AS DOUBLE), CAST(rn AS DOUBLE)) OVER w30 ELSE 0 END, 5) AS f_trend_30"""
VOLATILITY_SQL = "ROUND(STDDEV_SAMP(CAST(value AS DOUBLE)) OVER w7, 5) AS f_volatility_7"
NUMBERED = """numbered AS (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY series_key ORDER BY day) AS rn FROM filled)"""


def _doubles(names, digits=None):
    """Columns as doubles; computed floating-point results are rounded for the comparison."""
    digits = digits or {}
    return [
        (F.round(F.col(n), digits[n]) + 0.0 if n in digits else F.col(n).cast(D)).alias(n)  # no -0.0
        for n in names
    ]


@query(with_(*I.SERIES) + f"SELECT series_key, day, {_lags_sql()} FROM filled {WINDOWS}")
def lag_features(spark, sf_dir):
    out = I.filled(spark, sf_dir).withColumns(W.lags("value", by_day()))
    return out.select(KEY, DAY, *_doubles([f"f_lag_{k}" for k in W.LAGS]))


@query(with_(*I.SERIES) + f"SELECT series_key, day, {_means_sql()} FROM filled {WINDOWS}")
def moving_averages(spark, sf_dir):
    out = I.filled(spark, sf_dir).withColumns(W.moving_averages("value", by_day()))
    return out.select(KEY, DAY, *[f"f_ma_{n}" for n in W.MEANS])


@query(with_(*I.SERIES, NUMBERED) + f"SELECT series_key, day, {TREND_SQL} FROM numbered {WINDOWS}")
def rolling_trend(spark, sf_dir):
    placed = I.filled(spark, sf_dir).withColumn("rn", F.row_number().over(by_day()))
    out = placed.withColumns(W.rolling_trend("value", "rn", by_day()))
    return out.select(KEY, DAY, F.round("f_trend_30", 5).alias("f_trend_30"))


@query(with_(*I.SERIES) + f"SELECT series_key, day, {VOLATILITY_SQL} FROM filled {WINDOWS}")
def rolling_volatility(spark, sf_dir):
    out = I.filled(spark, sf_dir).withColumns(W.rolling_volatility("value", by_day()))
    return out.select(KEY, DAY, F.round("f_volatility_7", 5).alias("f_volatility_7"))


@query(with_(*I.SERIES) + f"SELECT series_key, day, {_diffs_sql()} FROM filled {WINDOWS}")
def diff_features(spark, sf_dir):
    out = I.filled(spark, sf_dir).withColumns(W.differences("value", by_day()))
    return out.select(KEY, DAY, *_doubles([f"f_diff_{k}" for k in W.DIFFERENCES]))


@query(
    with_(*I.SERIES)
    + f"""SELECT series_key, day,
  CASE WHEN COUNT(value) OVER w7 = 7 THEN CAST(SUM(value) OVER w7 AS DOUBLE) END AS f_sum_7,
  CASE WHEN COUNT(value) OVER w30 = 30 THEN CAST(SUM(value) OVER w30 AS DOUBLE) END AS f_sum_30
FROM dense {WINDOWS}"""
)
def rolling_sums(spark, sf_dir):
    """Over the series with gaps: a window with a missing day has no sum."""
    out = I.dense(spark, sf_dir).withColumns(W.rolling_sums("value", by_day()))
    return out.select(KEY, DAY, *_doubles(["f_sum_7", "f_sum_30"]))


@query(
    with_(I.DAILY)
    + f"""SELECT series_key, day,
  CASE WHEN COUNT(high) OVER w7 = 7 THEN CAST(SUM(high) OVER w7 AS DOUBLE) / 7 END AS f_high_mean_7,
  CASE WHEN COUNT(low) OVER w7 = 7 THEN CAST(SUM(low) OVER w7 AS DOUBLE) / 7 END AS f_low_mean_7
FROM daily {WINDOWS}"""
)
def rolling_mean_full(spark, sf_dir):
    out = I.daily(spark, sf_dir).withColumns(W.rolling_means_full(["high", "low"], by_day()))
    return out.select(KEY, DAY, "f_high_mean_7", "f_low_mean_7")


@query(
    with_(I.DAILY)
    + """SELECT series_key, day,
  CAST(SUM(value) OVER d7 AS DOUBLE) / COUNT(value) OVER d7 AS f_ma_7,
  CAST(SUM(value) OVER d30 AS DOUBLE) / COUNT(value) OVER d30 AS f_ma_30
FROM daily
WINDOW d7 AS (PARTITION BY series_key ORDER BY day RANGE BETWEEN INTERVAL 6 DAYS PRECEDING AND CURRENT ROW),
       d30 AS (PARTITION BY series_key ORDER BY day RANGE BETWEEN INTERVAL 29 DAYS PRECEDING AND CURRENT ROW)"""
)
def moving_averages_by_days(spark, sf_dir):
    """Calendar frames on the series with gaps."""
    by_number = series_window([KEY], "_n")
    out = I.daily(spark, sf_dir).withColumn("_n", F.unix_date(DAY))
    out = out.withColumns(W.moving_averages("value", by_number, [7, 30], frame="days"))
    return out.select(KEY, DAY, "f_ma_7", "f_ma_30")


CALENDAR_SQL = """CAST(YEAR(day) AS INTEGER) AS f_year, CAST(MONTH(day) AS INTEGER) AS f_month,
  CAST(DAY(day) AS INTEGER) AS f_day, CAST(DAYOFYEAR(day) AS INTEGER) AS f_day_of_year,
  CAST(WEEKOFYEAR(day) AS INTEGER) AS f_week_of_year, CAST(QUARTER(day) AS INTEGER) AS f_quarter"""
CYCLIC_SQL = """ROUND(SIN(2 * PI() * MONTH(day) / 12), 6) + 0.0 AS f_month_sin,
  ROUND(COS(2 * PI() * MONTH(day) / 12), 6) + 0.0 AS f_month_cos,
  ROUND(SIN(2 * PI() * DAYOFYEAR(day) / 365), 6) + 0.0 AS f_day_of_year_sin,
  ROUND(COS(2 * PI() * DAYOFYEAR(day) / 365), 6) + 0.0 AS f_day_of_year_cos"""
CYCLIC = ["f_month_sin", "f_month_cos", "f_day_of_year_sin", "f_day_of_year_cos"]

MATRIX = f"""derived AS (
  SELECT *, {CALENDAR_SQL}, {CYCLIC_SQL}, {_lags_sql()}, {_means_sql()}, {_diffs_sql()}, {TREND_SQL}, {VOLATILITY_SQL}
  FROM numbered {WINDOWS}),
matrix AS (SELECT * FROM derived WHERE rn > 30)"""
ROUNDED = {"f_trend_30": 5, "f_volatility_7": 5, **dict.fromkeys(CYCLIC, 6)}
INTEGERS = {"f_year", "f_month", "f_quarter", "f_day_of_year", "f_week_of_year"}


def matrix(spark, sf_dir):
    return W.feature_matrix(I.filled(spark, sf_dir), key=KEY, day=DAY, value="value")


def shown(names):
    whole = [n for n in names if n in INTEGERS]
    return whole + _doubles([n for n in names if n not in INTEGERS], ROUNDED)


@query(
    with_(*I.SERIES, NUMBERED, MATRIX)
    + f"SELECT series_key, day, CAST(value AS DOUBLE) AS value, {', '.join(FEATURES)} FROM matrix"
)
def feature_matrix(spark, sf_dir):
    """Flagship: scan, roll up, fill the calendar, interpolate, derive all 22 features."""
    return matrix(spark, sf_dir).select(KEY, DAY, F.col("value").cast(D).alias("value"), *shown(FEATURES))


SUPPLIER_MATRIX = """sup AS (
  SELECT series_key, day, value, ROW_NUMBER() OVER (PARTITION BY series_key ORDER BY day) AS rn FROM supplier_daily)"""


@query(
    with_(I.SUPPLIER_DAILY, SUPPLIER_MATRIX)
    + f"""SELECT series_key, day, f_lag_1, f_lag_30, f_ma_7, f_ma_30, f_trend_30, f_diff_7, f_week_of_year FROM (
  SELECT *, {CALENDAR_SQL}, {_lags_sql()}, {_means_sql()}, {_diffs_sql()}, {TREND_SQL} FROM sup {WINDOWS}) m
WHERE rn > 30"""
)
def feature_matrix_suppliers(spark, sf_dir):
    """The feature builder over one series per supplier."""
    out = W.feature_matrix(I.supplier_daily(spark, sf_dir), key=KEY, day=DAY, value="value")
    names = ["f_lag_1", "f_lag_30", "f_ma_7", "f_ma_30", "f_trend_30", "f_diff_7"]
    return out.select(KEY, DAY, *_doubles(names, ROUNDED), "f_week_of_year")


@query(
    with_(*I.SERIES, NUMBERED, MATRIX)
    + f"""SELECT series_key, day, CAST(ahead AS DOUBLE) AS value_ahead, f_lag_1, f_ma_7
FROM (SELECT *, LEAD(value, 1) OVER (PARTITION BY series_key ORDER BY day) AS ahead FROM derived) a
WHERE rn > 30 AND ahead IS NOT NULL"""
)
def feature_matrix_ahead(spark, sf_dir):
    """Labels one day ahead: the leak-free training table."""
    out = W.feature_matrix(
        I.filled(spark, sf_dir), key=KEY, day=DAY, value="value", horizon=1, targets=["value"]
    )
    return out.select(KEY, DAY, *_doubles(["value_ahead", "f_lag_1", "f_ma_7"]))


READING_ORDER = ["ts", "event_id"]
RAW_WINDOWS = """WINDOW o AS (PARTITION BY series_key ORDER BY ts, event_id),
  w7 AS (PARTITION BY series_key ORDER BY ts, event_id ROWS 6 PRECEDING),
  w30 AS (PARTITION BY series_key ORDER BY ts, event_id ROWS 29 PRECEDING)"""


@query(
    with_(I.READINGS)
    + f"""SELECT series_key, event_id, rn, CAST(LAG(v, 30) OVER o AS DOUBLE) AS f_lag_30,
  CAST(SUM(v) OVER w30 AS DOUBLE) / COUNT(v) OVER w30 AS f_ma_30,
  CAST(v - LAG(v, 7) OVER o AS DOUBLE) AS f_diff_7,
  ROUND(STDDEV_SAMP(CAST(v AS DOUBLE)) OVER w7, 6) AS f_volatility_7,
  ROUND(CASE WHEN COUNT(*) OVER w30 > 1 THEN REGR_SLOPE(CAST(v AS DOUBLE), CAST(rn AS DOUBLE)) OVER w30 ELSE 0 END, 6) AS f_trend_30
FROM (SELECT series_key, ts, event_id, COALESCE(value, 0) AS v,
        ROW_NUMBER() OVER (PARTITION BY series_key ORDER BY ts, event_id) AS rn FROM readings) r {RAW_WINDOWS}"""
)
def long_series_features(spark, sf_dir):
    """Row-window features over raw readings: blocks with a halo, no series in one task."""
    rows = I.readings(spark, sf_dir).select(KEY, "ts", "event_id", F.coalesce("value", F.lit(0).cast("decimal(18,2)")).alias("v"))

    def compute(df, window):
        return W.window_features(df, value="v", position="_pos", window=window)

    out = blocked(rows, [KEY], READING_ORDER, halo=30, rows_per_block=500_000, compute=compute)
    return out.select(
        KEY,
        "event_id",
        F.col("_pos").alias("rn"),
        *_doubles(["f_lag_30", "f_ma_30", "f_diff_7", "f_volatility_7", "f_trend_30"], {"f_volatility_7": 6, "f_trend_30": 6}),
    )


@query(
    with_(*I.SERIES, NUMBERED, MATRIX)
    + f"SELECT series_key, day, {', '.join(FEATURES)} FROM matrix"
)
def staged_features(spark, sf_dir):
    """Stage tables written one after the other; a second run reads them instead of building."""
    folder = work_path(spark, "stages")
    for _ in range(2):
        raw = stage(spark, f"{folder}/raw", lambda: I.filled(spark, sf_dir))
        built = stage(spark, f"{folder}/features", lambda: W.feature_matrix(raw, key=KEY, day=DAY, value="value"))
    return built.select(KEY, DAY, *shown(FEATURES))


@query(with_(I.DAILY) + f"SELECT series_key, day, {CALENDAR_SQL} FROM daily")
def calendar_features(spark, sf_dir):
    out = with_calendar_features(I.daily(spark, sf_dir).select(KEY, DAY), DAY)
    return out


@query(
    """SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day, CAST(YEAR(o_orderdate) AS INTEGER) AS year,
  CAST(MONTH(o_orderdate) AS INTEGER) AS month, CAST(DAY(o_orderdate) AS INTEGER) AS day_of_month,
  CAST(DAYOFYEAR(o_orderdate) AS INTEGER) AS day_of_year,
  CASE WHEN MONTH(o_orderdate) IN (12, 1, 2) THEN 1 WHEN MONTH(o_orderdate) IN (3, 4, 5) THEN 2
       WHEN MONTH(o_orderdate) IN (6, 7, 8) THEN 3 ELSE 4 END AS season
FROM orders"""
)
def calendar_columns(spark, sf_dir):
    dated = I.read(spark, sf_dir, "orders").select("o_orderkey", F.to_date("o_orderdate").alias(DAY))
    return with_calendar_columns(dated, DAY)


@query(with_(I.DAILY) + f"SELECT series_key, day, {CYCLIC_SQL} FROM daily")
def cyclic_features(spark, sf_dir):
    out = with_cyclic_features(I.daily(spark, sf_dir).select(KEY, DAY), DAY)
    return out.select(KEY, DAY, *_doubles(CYCLIC, ROUNDED))


@query(
    with_(*I.SERIES)
    + """SELECT series_key, day, CAST(value AS DOUBLE) AS value FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY series_key ORDER BY day DESC) AS r FROM filled) t WHERE r <= 30"""
)
def last_n_rows(spark, sf_dir):
    return W.last_rows(I.filled(spark, sf_dir), key=KEY, order=DAY, n=30).select(KEY, DAY, *_doubles(["value"]))


@query(
    with_(I.READINGS)
    + """SELECT series_key, ts, event_id, CAST(value AS DOUBLE) AS value, k FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY series_key ORDER BY ts DESC, event_id DESC) AS r FROM readings) t WHERE r = 1"""
)
def latest_row(spark, sf_dir):
    out = W.latest_row(I.readings(spark, sf_dir), key=KEY, order=READING_ORDER)
    return out.select(KEY, "ts", "event_id", F.col("value").cast(D).alias("value"), "k")


SCENARIOS = """scenarios AS (
  SELECT series_key, day + 1 AS day, CAST(value * 2 AS DECIMAL(18,6)) AS value, 'double' AS scenario_id
  FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY series_key ORDER BY day DESC) AS r FROM filled) a WHERE r = 1
  UNION ALL
  SELECT series_key, day + 1, CAST(0 AS DECIMAL(18,6)), 'nothing'
  FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY series_key ORDER BY day DESC) AS r FROM filled) a WHERE r = 1),
filled_s AS (
  SELECT f.series_key, f.day, f.value, s.scenario_id FROM filled f JOIN scenarios s ON s.series_key = f.series_key
  UNION ALL SELECT series_key, day, value, scenario_id FROM scenarios)"""


@query(
    with_(*I.SERIES, SCENARIOS)
    + f"""SELECT series_key, scenario_id, day, CAST(value AS DOUBLE) AS value, f_lag_1, f_lag_30, f_ma_30, f_diff_1,
  {CALENDAR_SQL} FROM (
  SELECT *, {_lags_sql()}, {_means_sql()}, {_diffs_sql()},
    ROW_NUMBER() OVER (PARTITION BY series_key, scenario_id ORDER BY day DESC) AS r FROM filled_s
  {WINDOWS.replace('PARTITION BY series_key', 'PARTITION BY series_key, scenario_id')}) t WHERE r = 1"""
)
def scenario_features(spark, sf_dir):
    """Features of hypothetical next days appended to each series."""
    history = durable(I.filled(spark, sf_dir))
    newest = W.latest_row(history, key=KEY, order=[DAY])
    next_day = newest.withColumn(DAY, F.date_add(DAY, 1))
    scenarios = next_day.select(
        KEY, DAY, (F.col("value") * 2).cast("decimal(18,6)").alias("value"), F.lit("double").alias("scenario_id")
    ).unionByName(
        next_day.select(KEY, DAY, F.lit(0).cast("decimal(18,6)").alias("value"), F.lit("nothing").alias("scenario_id"))
    )
    joined = with_scenarios(history, scenarios, key=KEY).withColumn("_series", F.concat_ws("|", KEY, "scenario_id"))
    built = W.feature_matrix(joined, key="_series", day=DAY, value="value", complete=False).where("is_scenario")
    names = ["value", "f_lag_1", "f_lag_30", "f_ma_30", "f_diff_1"]
    parts = ["f_year", "f_month", "f_day", "f_day_of_year", "f_week_of_year", "f_quarter"]
    return built.select(KEY, "scenario_id", DAY, *_doubles(names), *parts)


@query(
    with_(*I.SERIES)
    + "SELECT series_key, day, "
    + ", ".join(f"CAST(LEAD(value, {h}) OVER o AS DOUBLE) AS y_{h}" for h in range(1, 8))
    + " FROM filled WINDOW o AS (PARTITION BY series_key ORDER BY day)"
)
def multi_horizon_labels(spark, sf_dir):
    out = I.filled(spark, sf_dir).withColumns(W.future_values("value", by_day(), range(1, 8)))
    return out.select(KEY, DAY, *_doubles([f"y_{h}" for h in range(1, 8)]))


@query(
    with_(I.DAILY)
    + """SELECT series_key, day, DAYOFWEEK(day) IN (0, 6) AS is_weekend,
  CAST(high - LAG(high) OVER o AS DOUBLE) AS pressure_change, CAST(low - LAG(low) OVER o AS DOUBLE) AS humidity_change,
  CASE WHEN n_orders < 10 THEN 'calm' WHEN n_orders < 30 THEN 'breeze' ELSE 'strong' END AS wind_category
FROM daily WINDOW o AS (PARTITION BY series_key ORDER BY day)"""
)
def doc_features(spark, sf_dir):
    out = W.observation_extras(
        I.daily(spark, sf_dir), key=KEY, day=DAY, pressure="high", humidity="low", wind="n_orders"
    )
    return out.select(KEY, DAY, "is_weekend", *_doubles(["pressure_change", "humidity_change"]), "wind_category")


@query(
    with_(*I.SERIES)
    + """SELECT series_key, day, CASE WHEN r <= FLOOR(n * 0.8::DOUBLE) THEN 'train' ELSE 'test' END AS split FROM (
  SELECT series_key, day, ROW_NUMBER() OVER (PARTITION BY series_key ORDER BY day) AS r,
    COUNT(*) OVER (PARTITION BY series_key) AS n FROM filled) t"""
)
def temporal_split_(spark, sf_dir):
    return temporal_split(I.filled(spark, sf_dir), key=KEY, order=[DAY]).select(KEY, DAY, "split")


@query(
    with_(I.READINGS)
    + """SELECT series_key, event_id, CASE WHEN r <= FLOOR(n * 0.8::DOUBLE) THEN 'train' ELSE 'test' END AS split FROM (
  SELECT series_key, event_id, ROW_NUMBER() OVER (PARTITION BY series_key ORDER BY ts, event_id) AS r,
    COUNT(*) OVER (PARTITION BY series_key) AS n FROM readings) t"""
)
def temporal_split_raw_(spark, sf_dir):
    """The split of raw readings: counts per hour, only the cutting hour is ranked."""
    rows = I.readings(spark, sf_dir).select(KEY, "ts", "event_id")
    return temporal_split_raw(rows, key=KEY, order=READING_ORDER).select(KEY, "event_id", "split")


@query(
    with_(*I.SERIES)
    + """SELECT series_key, day, CASE WHEN day < DATE '2000-01-01' THEN 'train' ELSE 'test' END AS split FROM filled"""
)
def split_by_date_(spark, sf_dir):
    out = split_by_date(I.filled(spark, sf_dir), day=DAY, first_test_day="2000-01-01")
    return out.select(KEY, DAY, "split")


@query(
    with_(*I.SERIES)
    + "SELECT series_key, day, CAST(NTILE(5) OVER (PARTITION BY series_key ORDER BY day) AS INTEGER) AS fold FROM filled"
)
def ts_folds(spark, sf_dir):
    return time_folds(I.filled(spark, sf_dir), key=KEY, order=[DAY]).select(KEY, DAY, "fold")


SCALED = ["f_lag_1", "f_ma_7", "f_ma_30", "f_diff_1", "f_month"]


SCALED_ROWS = (
    with_(*I.SERIES, NUMBERED, MATRIX)
    + """, parted AS (
  SELECT *, CASE WHEN ROW_NUMBER() OVER (PARTITION BY series_key ORDER BY day)
    <= FLOOR(COUNT(*) OVER (PARTITION BY series_key) * 0.8::DOUBLE) THEN 'train' ELSE 'test' END AS split FROM matrix),
fitted AS (SELECT series_key, """
    + ", ".join(f"AVG(CAST({f} AS DOUBLE)) AS m_{f}, STDDEV_POP(CAST({f} AS DOUBLE)) AS s_{f}" for f in SCALED)
    + """ FROM parted WHERE split = 'train' GROUP BY 1)
SELECT p.series_key, p.day, p.split, """
    + ", ".join(f"ROUND(({f} - m_{f}) / CASE WHEN s_{f} = 0 THEN 1 ELSE s_{f} END, 6) AS {f}" for f in SCALED)
    + " FROM parted p JOIN fitted f ON f.series_key = p.series_key"
)


@query(SCALED_ROWS)
def scale_features(spark, sf_dir):
    split = temporal_split(matrix(spark, sf_dir), key=KEY, order=[DAY])
    fitted = fit_scaler(split, key=KEY, features=SCALED, fit_on=F.col("split") == "train")
    out = apply_scaler(split, fitted, key=KEY, features=SCALED)
    return out.select(KEY, DAY, "split", *_doubles(SCALED, dict.fromkeys(SCALED, 6)))


@query(SCALED_ROWS)
def saved_scaler(spark, sf_dir):
    """A fitted scaler written, read again and applied to the rows as new data."""
    split = durable(temporal_split(matrix(spark, sf_dir), key=KEY, order=[DAY]).select(KEY, DAY, "split", *SCALED))
    path = work_path(spark, "scaler")
    scaler = SeriesScaler(key=KEY, features=SCALED, targets=["value"]).fit(split.where("split = 'train'"))
    scaler.write().save(path)
    out = SeriesScalerModel.load(path).transform(split)
    return out.select(KEY, DAY, "split", *_doubles(SCALED, dict.fromkeys(SCALED, 6)))
