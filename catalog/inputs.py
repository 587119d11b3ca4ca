"""What the driver tables stand for, in Spark and in SQL.

* ``orders``: daily series per order priority (sum, highest, lowest price and order count).
* ``events``: raw readings per event type; a value below the detection limit is missing.
* ``lineitem``: daily series per supplier (many series).
* naive forecasts of the order series play the part of trained models.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tidemark.operators.clean import interpolate_linear
from tidemark.operators.metrics import regression_metrics
from tidemark.operators.resample import daily_rollup, densify_daily
from tidemark.operators.selection import (
    composite_scores,
    deployment_gate,
    select_composite,
    with_previous_run,
)
from tidemark.session import durable

DAILY_RULES = {
    "value": ("sum", "price"),
    "high": ("max", "price"),
    "low": ("min", "price"),
    "n_orders": ("count", "price"),
}

# Readings below this value count as missing.
DETECTION_LIMIT = 1.0

# Stand-in models: name -> (look-back rows, rows averaged); the look-back doubles as "time".
MODELS = {
    "naive_1": (1, 1),
    "naive_7": (7, 1),
    "mean_7": (7, 7),
    "mean_30": (30, 30),
    "season_364": (364, 1),
}


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    prices = read(spark, sf_dir, "orders").select(
        F.col("o_orderpriority").alias("series_key"),
        F.col("o_orderdate").alias("ts"),
        F.col("o_totalprice").cast("decimal(18,2)").alias("price"),
    )
    return daily_rollup(prices, key="series_key", ts="ts", rules=DAILY_RULES)


def stored_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The daily series written once, for queries that read them several times."""
    return durable(daily(spark, sf_dir))


DAILY = """daily AS (
  SELECT o_orderpriority AS series_key, CAST(o_orderdate AS DATE) AS day,
         SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS value,
         MAX(CAST(o_totalprice AS DECIMAL(18,2))) AS high,
         MIN(CAST(o_totalprice AS DECIMAL(18,2))) AS low,
         COUNT(o_totalprice) AS n_orders
  FROM orders GROUP BY 1, 2)"""


def dense(spark: SparkSession, sf_dir: str) -> DataFrame:
    return densify_daily(daily(spark, sf_dir).select("series_key", "day", "value"), key="series_key")


DENSE = """dense AS (
  SELECT c.series_key, c.day, d.value
  FROM (SELECT series_key, CAST(UNNEST(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS day
        FROM (SELECT series_key, CAST(MIN(day) AS TIMESTAMP) AS lo, CAST(MAX(day) AS TIMESTAMP) AS hi
              FROM daily GROUP BY 1)) c
  LEFT JOIN daily d ON d.series_key = c.series_key AND d.day = c.day)"""


def filled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gap-free series; values in millionths, so that sums do not depend on their order."""
    whole = interpolate_linear(dense(spark, sf_dir), key="series_key", order=["day"], columns=["value"])
    millionths = F.floor(F.col("value") * 1e6 + 0.5).cast("decimal(18,0)")
    return whole.withColumn("value", (millionths * F.lit(Decimal("0.000001"))).cast("decimal(18,6)"))


def interpolated_sql(source: str, name: str, order: str, extra: str = "") -> str:
    """Linear interpolation by row position as SQL; NULLs at the ends take the nearest value."""
    return f"""{name}_p AS (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY series_key ORDER BY {order}) AS rn FROM {source}),
{name}_k AS (
  SELECT *,
    MAX(CASE WHEN value IS NOT NULL THEN rn END) OVER b AS at_lo,
    MIN(CASE WHEN value IS NOT NULL THEN rn END) OVER f AS at_hi,
    CAST(LAST_VALUE(value IGNORE NULLS) OVER b AS DOUBLE) AS v_lo,
    CAST(FIRST_VALUE(value IGNORE NULLS) OVER f AS DOUBLE) AS v_hi
  FROM {name}_p
  WINDOW b AS (PARTITION BY series_key ORDER BY rn ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
         f AS (PARTITION BY series_key ORDER BY rn ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
{name} AS (
  SELECT {extra} series_key, {order}, COALESCE(CAST(value AS DOUBLE),
      CASE WHEN at_hi > at_lo THEN v_lo + (v_hi - v_lo) / CAST(at_hi - at_lo AS DOUBLE) * CAST(rn - at_lo AS DOUBLE) END,
      v_lo, v_hi) AS value
  FROM {name}_k)"""


FILLED = (
    interpolated_sql("dense", "whole", "day")
    + """,
filled AS (
  SELECT series_key, day,
    CAST(CAST(FLOOR(value * 1e6 + 0.5) AS DECIMAL(18,0)) * CAST(0.000001 AS DECIMAL(7,6)) AS DECIMAL(18,6)) AS value
  FROM whole)"""
)
SERIES = (DAILY, DENSE, FILLED)


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    value = F.col("value").cast("decimal(18,2)")
    return read(spark, sf_dir, "events").select(
        F.col("event_type").alias("series_key"),
        "ts",
        "event_id",
        F.when(F.col("value") >= DETECTION_LIMIT, value).alias("value"),
        F.get_json_object("props", "$.k").cast("int").alias("k"),
    )


READINGS = """readings AS (
  SELECT event_type AS series_key, ts, event_id,
         CASE WHEN value >= 1.0 THEN CAST(value AS DECIMAL(18,2)) END AS value,
         CAST(json_extract_string(props, '$.k') AS INTEGER) AS k
  FROM events)"""


def hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings under the names of the hourly payload."""
    value, k = F.col("value"), F.col("k")
    return readings(spark, sf_dir).select(
        "series_key",
        "ts",
        value.alias("temperature_2m"),
        k.alias("apparent_temperature"),
        k.alias("relative_humidity_2m"),
        F.greatest(value - 100, F.lit(0).cast("decimal(18,2)")).cast("decimal(18,2)").alias("precipitation"),
        F.when(value > 100, value).alias("rain"),
        F.when(value > 300, value).alias("snowfall"),
        F.floor(k / 10).cast("int").alias("weathercode"),
        value.alias("windspeed_10m"),
        (value + k).alias("windgusts_10m"),
        k.alias("winddirection_10m"),
        value.alias("shortwave_radiation"),
        k.alias("et0_fao_evapotranspiration"),
    )


HOURLY = """hourly AS (
  SELECT series_key, ts, value AS temperature_2m, k AS apparent_temperature, k AS relative_humidity_2m,
         CASE WHEN value IS NULL THEN CAST(0 AS DECIMAL(18,2))
              ELSE GREATEST(value - 100, CAST(0 AS DECIMAL(18,2))) END AS precipitation,
         CASE WHEN value > 100 THEN value END AS rain,
         CASE WHEN value > 300 THEN value END AS snowfall,
         CAST(FLOOR(k / 10.0) AS INTEGER) AS weathercode,
         value AS windspeed_10m, value + k AS windgusts_10m, k AS winddirection_10m,
         value AS shortwave_radiation, k AS et0_fao_evapotranspiration
  FROM readings)"""


def supplier_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One series per supplier: many series, the case that scales by key."""
    prices = read(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").alias("series_key"),
        F.col("l_shipdate").alias("ts"),
        F.col("l_extendedprice").cast("decimal(18,2)").alias("price"),
    )
    rules = {"value": ("sum", "price"), "n_items": ("count", "price")}
    return daily_rollup(prices, key="series_key", ts="ts", rules=rules)


SUPPLIER_DAILY = """supplier_daily AS (
  SELECT l_suppkey AS series_key, CAST(l_shipdate AS DATE) AS day,
         SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS value, COUNT(l_extendedprice) AS n_items
  FROM lineitem GROUP BY 1, 2)"""


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Forecasts of every stand-in model: series_key, day, model, y, yhat."""
    order = Window.partitionBy("series_key").orderBy("day")
    columns = {}
    for name, (back, width) in MODELS.items():
        if width == 1:
            columns[name] = F.lag("value", back).over(order).cast("double")
        else:
            span = order.rowsBetween(-back, -1)
            columns[name] = F.when(
                F.count("value").over(span) == width, F.sum("value").over(span).cast("double") / width
            )
    wide = filled(spark, sf_dir).withColumns(columns)
    long = wide.select("series_key", "day", F.col("value").cast("double").alias("y"), *MODELS)
    return long.unpivot(["series_key", "day", "y"], list(MODELS), "model", "yhat").where("yhat is not null")


PREDICTIONS = """wide AS (
  SELECT series_key, day, CAST(value AS DOUBLE) AS y,
    CAST(LAG(value, 1) OVER o AS DOUBLE) AS naive_1,
    CAST(LAG(value, 7) OVER o AS DOUBLE) AS naive_7,
    CASE WHEN COUNT(value) OVER w7 = 7 THEN CAST(SUM(value) OVER w7 AS DOUBLE) / 7 END AS mean_7,
    CASE WHEN COUNT(value) OVER w30 = 30 THEN CAST(SUM(value) OVER w30 AS DOUBLE) / 30 END AS mean_30,
    CAST(LAG(value, 364) OVER o AS DOUBLE) AS season_364
  FROM filled
  WINDOW o AS (PARTITION BY series_key ORDER BY day),
         w7 AS (PARTITION BY series_key ORDER BY day ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING),
         w30 AS (PARTITION BY series_key ORDER BY day ROWS BETWEEN 30 PRECEDING AND 1 PRECEDING)),
predictions AS (
  SELECT series_key, day, y, model, yhat FROM (
    SELECT series_key, day, y, 'naive_1' AS model, naive_1 AS yhat FROM wide UNION ALL
    SELECT series_key, day, y, 'naive_7', naive_7 FROM wide UNION ALL
    SELECT series_key, day, y, 'mean_7', mean_7 FROM wide UNION ALL
    SELECT series_key, day, y, 'mean_30', mean_30 FROM wide UNION ALL
    SELECT series_key, day, y, 'season_364', season_364 FROM wide) u
  WHERE yhat IS NOT NULL)"""


def results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per (series, year, model) with rounded test metrics: a run per year."""
    scored = predictions(spark, sf_dir).withColumn("run_year", F.year("day"))
    measured = regression_metrics(scored, ["series_key", "run_year", "model"])
    seconds = F.element_at(
        F.create_map(*[F.lit(x) for n, (back, _) in MODELS.items() for x in (n, float(back))]), F.col("model")
    )
    return measured.select(
        "series_key",
        "run_year",
        "model",
        F.round("rmse", 4).alias("avg_rmse"),
        F.round("mae", 4).alias("avg_mae"),
        F.round("r2", 6).alias("avg_r2"),
        seconds.alias("training_seconds"),
        F.col("n_rows").alias("test_rows"),
    )


def stored_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The results table written once, for queries that read it several times."""
    return durable(results(spark, sf_dir))


RESULTS = """results AS (
  SELECT series_key, CAST(YEAR(day) AS INTEGER) AS run_year, model,
    ROUND(SQRT(AVG((y - yhat) * (y - yhat))), 4) AS avg_rmse,
    ROUND(AVG(ABS(y - yhat)), 4) AS avg_mae,
    CASE WHEN VAR_POP(y) = 0 THEN CASE WHEN SUM((y - yhat) * (y - yhat)) = 0 THEN 1.0 ELSE 0.0 END
         ELSE ROUND(1 - SUM((y - yhat) * (y - yhat)) / (VAR_POP(y) * COUNT(y)), 6) END AS avg_r2,
    CASE model WHEN 'naive_1' THEN 1.0::DOUBLE WHEN 'naive_7' THEN 7.0 WHEN 'mean_7' THEN 7.0
               WHEN 'mean_30' THEN 30.0 ELSE 364.0 END AS training_seconds,
    COUNT(*) AS test_rows
  FROM predictions GROUP BY 1, 2, 3)"""

RUNS = (*SERIES, PREDICTIONS, RESULTS)
EXPERIMENT = ["series_key", "run_year"]


def scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return composite_scores(results(spark, sf_dir), EXPERIMENT)


SCORES = """parts AS (
  SELECT *,
    COALESCE(100 * (1 - (avg_rmse - MIN(avg_rmse) OVER e) / NULLIF(MAX(avg_rmse) OVER e - MIN(avg_rmse) OVER e, 0)), 100) AS rmse_score,
    COALESCE(100 * ((avg_r2 - MIN(avg_r2) OVER e) / NULLIF(MAX(avg_r2) OVER e - MIN(avg_r2) OVER e, 0)), 100) AS r2_score,
    COALESCE(100 * (1 - (avg_mae - MIN(avg_mae) OVER e) / NULLIF(MAX(avg_mae) OVER e - MIN(avg_mae) OVER e, 0)), 100) AS mae_score,
    COALESCE(100 * (1 - (training_seconds - MIN(training_seconds) OVER e)
      / NULLIF(MAX(training_seconds) OVER e - MIN(training_seconds) OVER e, 0)), 100) AS time_score
  FROM results WINDOW e AS (PARTITION BY series_key, run_year)),
scores AS (
  SELECT *, rmse_score * 0.4::DOUBLE + r2_score * 0.3::DOUBLE + mae_score * 0.2::DOUBLE + time_score * 0.1::DOUBLE AS composite_score
  FROM parts)"""


def gated(spark: SparkSession, sf_dir: str) -> DataFrame:
    best = select_composite(scores(spark, sf_dir), EXPERIMENT)
    return deployment_gate(with_previous_run(best, ["series_key"], "run_year"), extra=True)


GATED = """best AS (
  SELECT * EXCLUDE (place) FROM (
    SELECT *, ROW_NUMBER() OVER (PARTITION BY series_key, run_year ORDER BY composite_score DESC, model) AS place
    FROM scores) s WHERE place = 1),
previous AS (
  SELECT *, LAG(TRUE, 1, FALSE) OVER o AS has_previous, LAG(avg_rmse) OVER o AS previous_rmse,
         LAG(avg_r2) OVER o AS previous_r2, LAG(composite_score) OVER o AS previous_score
  FROM best WINDOW o AS (PARTITION BY series_key ORDER BY run_year)),
checked AS (
  SELECT *,
    avg_r2 >= 0.7 AS ok_performance,
    CASE WHEN NOT has_previous THEN TRUE END AS ok_first,
    CASE WHEN has_previous THEN rmse_gain >= 0.05 END AS ok_rmse_gain,
    CASE WHEN has_previous THEN r2_gain >= 0.02 END AS ok_r2_gain,
    test_rows >= 100 AS ok_rows,
    training_seconds <= 3600 AS ok_time,
    CASE WHEN has_previous THEN composite_score - previous_score >= 5.0 END AS ok_score_gain
  FROM (SELECT *, (previous_rmse - avg_rmse) / NULLIF(previous_rmse, 0) AS rmse_gain,
               (avg_r2 - previous_r2) / NULLIF(ABS(previous_r2), 0) AS r2_gain FROM previous) p),
gated AS (
  SELECT *,
    ok_performance AND COALESCE(ok_first, TRUE) AND COALESCE(ok_rmse_gain, TRUE) AND COALESCE(ok_r2_gain, TRUE)
      AND ok_rows AND ok_time AND COALESCE(ok_score_gain, TRUE) AS should_deploy,
    CONCAT_WS('; ',
      CASE WHEN ok_performance THEN 'performance:met' ELSE 'performance:missed' END,
      CASE WHEN ok_first THEN 'first:met' END,
      CASE ok_rmse_gain WHEN TRUE THEN 'rmse_gain:met' WHEN FALSE THEN 'rmse_gain:missed' END,
      CASE ok_r2_gain WHEN TRUE THEN 'r2_gain:met' WHEN FALSE THEN 'r2_gain:missed' END,
      CASE WHEN ok_rows THEN 'rows:met' ELSE 'rows:missed' END,
      CASE WHEN ok_time THEN 'time:met' ELSE 'time:missed' END,
      CASE ok_score_gain WHEN TRUE THEN 'score_gain:met' WHEN FALSE THEN 'score_gain:missed' END) AS reasons
  FROM checked)"""

DECISIONS = (*RUNS, SCORES, GATED)
