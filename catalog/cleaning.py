"""Rollups, gap filling, outliers and duplicates."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import clean as C
from tidemark.operators.quantiles import approximate_quantiles, modes
from tidemark.operators.resample import HOURLY_RULES, daily_rollup
from tidemark.plans.preparation import preprocess

from . import inputs as I
from .register import query, with_

KEY, DAY = "series_key", "day"
D = "double"


@query(
    with_(I.READINGS, I.HOURLY)
    + """, codes AS (
  SELECT series_key, CAST(ts AS DATE) AS day, weathercode AS v, COUNT(*) AS n FROM hourly WHERE weathercode IS NOT NULL GROUP BY 1, 2, 3),
directions AS (
  SELECT series_key, CAST(ts AS DATE) AS day, winddirection_10m AS v, COUNT(*) AS n FROM hourly
  WHERE winddirection_10m IS NOT NULL GROUP BY 1, 2, 3),
code AS (SELECT series_key, day, v FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY series_key, day ORDER BY n DESC, v) AS r FROM codes) t WHERE r = 1),
direction AS (SELECT series_key, day, v FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY series_key, day ORDER BY n DESC, v) AS r FROM directions) t WHERE r = 1),
plain AS (
  SELECT series_key, CAST(ts AS DATE) AS day,
    CAST(MAX(temperature_2m) AS DOUBLE) AS temperature_2m_max, CAST(MIN(temperature_2m) AS DOUBLE) AS temperature_2m_min,
    CAST(SUM(temperature_2m) AS DOUBLE) / COUNT(temperature_2m) AS temperature_2m_mean,
    CAST(MAX(apparent_temperature) AS DOUBLE) AS apparent_temperature_max,
    CAST(MIN(apparent_temperature) AS DOUBLE) AS apparent_temperature_min,
    CAST(SUM(relative_humidity_2m) AS DOUBLE) / COUNT(relative_humidity_2m) AS relative_humidity_2m,
    CAST(COALESCE(SUM(precipitation), 0) AS DOUBLE) AS precipitation_sum, CAST(COALESCE(SUM(rain), 0) AS DOUBLE) AS rain_sum,
    CAST(COALESCE(SUM(snowfall), 0) AS DOUBLE) AS snowfall_sum,
    CAST(COUNT(*) FILTER (WHERE precipitation > 0) AS DOUBLE) AS precipitation_hours,
    CAST(MAX(windspeed_10m) AS DOUBLE) AS windspeed_10m_max, CAST(MAX(windgusts_10m) AS DOUBLE) AS windgusts_10m_max,
    CAST(COALESCE(SUM(shortwave_radiation), 0) AS DOUBLE) AS shortwave_radiation_sum,
    CAST(COALESCE(SUM(et0_fao_evapotranspiration), 0) AS DOUBLE) AS et0_fao_evapotranspiration
  FROM hourly GROUP BY 1, 2)
SELECT p.*, CAST(d.v AS DOUBLE) AS winddirection_10m_dominant, CAST(c.v AS DOUBLE) AS weathercode
FROM plain p LEFT JOIN direction d ON d.series_key = p.series_key AND d.day = p.day
LEFT JOIN code c ON c.series_key = p.series_key AND c.day = p.day"""
)
def daily_rollup_(spark, sf_dir):
    """The 16 daily aggregates of the hourly payload."""
    out = daily_rollup(I.hourly(spark, sf_dir), key=KEY, ts="ts", rules=HOURLY_RULES)
    return out.select(KEY, DAY, *[F.col(c).cast(D).alias(c) for c in HOURLY_RULES])


@query(
    with_(I.SUPPLIER_DAILY)
    + "SELECT series_key, day, CAST(value AS DOUBLE) AS value, n_items FROM supplier_daily"
)
def daily_rollup_suppliers(spark, sf_dir):
    out = I.supplier_daily(spark, sf_dir)
    return out.select(KEY, DAY, F.col("value").cast(D).alias("value"), "n_items")


@query(
    """SELECT series_key, value AS top_value, n FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY series_key ORDER BY n DESC, value) AS r FROM (
    SELECT l_returnflag AS series_key, l_quantity AS value, COUNT(*) AS n FROM lineitem GROUP BY 1, 2) c) t WHERE r = 1"""
)
def daily_mode(spark, sf_dir):
    """Most frequent quantity per return flag, smallest on ties: three groups over all line items."""
    items = I.read(spark, sf_dir, "lineitem").select(F.col("l_returnflag").alias(KEY), "l_quantity")
    top = modes(items, [KEY], "l_quantity", "top_value")
    counts = items.groupBy(KEY, F.col("l_quantity").alias("top_value")).agg(F.count("*").alias("n"))
    return top.join(counts, [KEY, "top_value"]).select(KEY, "top_value", "n")


@query(with_(I.DAILY, I.DENSE) + "SELECT series_key, day, CAST(value AS DOUBLE) AS value FROM dense")
def densify_daily(spark, sf_dir):
    return I.dense(spark, sf_dir).select(KEY, DAY, F.col("value").cast(D).alias("value"))


@query(
    with_(I.READINGS, I.interpolated_sql("readings", "smooth", "ts, event_id"))
    + "SELECT series_key, event_id, ROUND(value, 6) AS value FROM smooth"
)
def interpolate_linear(spark, sf_dir):
    """Gaps in raw readings, filled block by block with values carried across blocks."""
    rows = I.readings(spark, sf_dir).select(KEY, "ts", "event_id", "value")
    out = C.interpolate_linear(rows, key=KEY, order=["ts", "event_id"], columns=["value"], blocks=True)
    return out.select(KEY, "event_id", F.round("value", 6).alias("value"))


@query(with_(*I.SERIES) + "SELECT series_key, day, CAST(value AS DOUBLE) AS value FROM filled")
def interpolate_daily(spark, sf_dir):
    return I.filled(spark, sf_dir).select(KEY, DAY, F.col("value").cast(D).alias("value"))


@query(
    with_(I.DAILY, I.DENSE)
    + """SELECT series_key, day, CAST(COALESCE(
  LAST_VALUE(value IGNORE NULLS) OVER (PARTITION BY series_key ORDER BY day ROWS UNBOUNDED PRECEDING),
  FIRST_VALUE(value IGNORE NULLS) OVER (PARTITION BY series_key ORDER BY day
    ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS DOUBLE) AS value FROM dense"""
)
def ffill_bfill(spark, sf_dir):
    out = C.fill_forward_backward(I.dense(spark, sf_dir), key=KEY, order=[DAY], columns=["value"])
    return out.select(KEY, DAY, F.col("value").cast(D).alias("value"))


BOUNDS = """long AS (
  SELECT series_key, 'value' AS "column", CAST(value AS DOUBLE) AS v FROM readings WHERE value IS NOT NULL
  UNION ALL SELECT series_key, 'k', CAST(k AS DOUBLE) FROM readings WHERE k IS NOT NULL),
quartiles AS (
  SELECT series_key, "column", QUANTILE_CONT(v, 0.25) AS q1, QUANTILE_CONT(v, 0.5) AS median, QUANTILE_CONT(v, 0.75) AS q3
  FROM long GROUP BY 1, 2),
bounds AS (SELECT *, q1 - (q3 - q1) * 3 AS lower, q3 + (q3 - q1) * 3 AS upper FROM quartiles)"""


@query(
    with_(I.READINGS, BOUNDS)
    + 'SELECT series_key, "column", '
    + ", ".join(f"ROUND({c}, 6) AS {c}" for c in ("q1", "median", "q3", "lower", "upper"))
    + " FROM bounds"
)
def iqr_bounds(spark, sf_dir):
    """Exact quartiles of raw readings without gathering a series in one task."""
    out = C.iqr_bounds(I.readings(spark, sf_dir), key=KEY, columns=["value", "k"], daily=False)
    return out.select(KEY, "column", *[F.round(c, 6).alias(c) for c in ("q1", "median", "q3", "lower", "upper")])


@query(
    with_(I.READINGS, BOUNDS)
    + """SELECT r.series_key, r.event_id, ROUND(CASE WHEN r.value < b.lower OR r.value > b.upper THEN b.median
  ELSE CAST(r.value AS DOUBLE) END, 6) AS value
FROM readings r JOIN bounds b ON b.series_key = r.series_key AND b."column" = 'value'"""
)
def iqr_replace(spark, sf_dir):
    rows = I.readings(spark, sf_dir).select(KEY, "event_id", "value")
    out = C.replace_outliers(rows, key=KEY, columns=["value"], daily=False)
    return out.select(KEY, "event_id", F.round("value", 6).alias("value"))


@query(
    with_(I.READINGS, BOUNDS)
    + """SELECT l.series_key, l."column", COUNT(*) AS n_values, COUNT(*) FILTER (WHERE v < lower OR v > upper) AS n_outliers
FROM long l JOIN bounds b ON b.series_key = l.series_key AND b."column" = l."column" GROUP BY 1, 2"""
)
def iqr_counts(spark, sf_dir):
    return C.count_outliers(I.readings(spark, sf_dir), key=KEY, columns=["value", "k"], daily=False)


def _delivered_twice(spark, sf_dir):
    items = I.read(spark, sf_dir, "lineitem")
    return items.unionByName(items)


@query("SELECT DISTINCT * FROM lineitem")
def exact_dedup(spark, sf_dir):
    """Whole line items, delivered twice."""
    return C.drop_exact_duplicates(_delivered_twice(spark, sf_dir))


@query(
    """SELECT n_rows, n_distinct, n_rows - n_distinct AS n_duplicates
FROM (SELECT 2 * COUNT(*) AS n_rows FROM lineitem) a, (SELECT COUNT(*) AS n_distinct FROM (SELECT DISTINCT * FROM lineitem) d) b"""
)
def exact_dedup_counts(spark, sf_dir):
    return C.count_exact_duplicates(_delivered_twice(spark, sf_dir))


@query(
    with_(
        I.DAILY,
        I.DENSE,
        I.FILLED,
    )
    + """, q AS (
  SELECT series_key, QUANTILE_CONT(value, 0.25) AS q1, QUANTILE_CONT(value, 0.5) AS median, QUANTILE_CONT(value, 0.75) AS q3
  FROM whole GROUP BY 1)
SELECT w.series_key, w.day, FLOOR(CASE WHEN w.value < q1 - (q3 - q1) * 3 OR w.value > q3 + (q3 - q1) * 3
  THEN median ELSE w.value END * 1e4 + 0.5) / 1e4 AS value FROM whole w JOIN q ON q.series_key = w.series_key"""
)
def preprocess_daily(spark, sf_dir):
    """Interpolate, replace outliers, drop repeats."""
    out = preprocess(I.dense(spark, sf_dir), key=KEY, day=DAY, columns=["value"])
    return out.select(KEY, DAY, (F.floor(F.col("value") * 1e4 + 0.5) / 1e4).alias("value"))


@query(
    with_(I.DAILY, I.DENSE)
    + "SELECT series_key, day, CAST(value AS DOUBLE) AS value FROM dense WHERE value IS NOT NULL"
)
def drop_incomplete(spark, sf_dir):
    out = C.drop_incomplete(I.dense(spark, sf_dir), ["value"])
    return out.select(KEY, DAY, F.col("value").cast(D).alias("value"))


@query()
def approximate_quartiles(spark, sf_dir):
    """One-pass sketch of the quartiles (approximate, hence without SQL)."""
    return approximate_quantiles(I.readings(spark, sf_dir), [KEY], ["value", "k"], [0.25, 0.5, 0.75])
