"""Data-quality checks, reports, metrics, selection and the model registry."""

from __future__ import annotations

from pyspark.sql import Window, functions as F

from tidemark.functions.scalars import clean_metric_name
from tidemark.operators import metrics as M
from tidemark.operators import quality as Q
from tidemark.operators import registry as R
from tidemark.operators import report as P
from tidemark.operators import selection as S
from tidemark.operators.clean import keep_last
from tidemark.operators.features import latest_row
from tidemark.operators.ingest import insert_absent
from tidemark.operators.resample import densify_daily
from tidemark.operators.split_scale import temporal_split
from tidemark.plans.lifecycle import register
from tidemark.session import durable

from . import inputs as I
from .register import query, with_

KEY, DAY = "series_key", "day"
D = "double"


def _even(value: str, digits: int) -> str:
    """SQL: a non-negative DECIMAL(.., 2) rounded half to even at 1 digit, exactly."""
    assert digits == 1
    cents = f"CAST({value} * 100 AS BIGINT)"
    return (
        f"CAST(CASE WHEN {cents} % 10 > 5 OR ({cents} % 10 = 5 AND ({cents} // 10) % 2 = 1)"
        f" THEN {cents} // 10 + 1 ELSE {cents} // 10 END AS DOUBLE) / 10"
    )


@query(
    with_(I.DAILY)
    + "SELECT series_key, MIN(day) AS first_day, MAX(day) AS last_day, COUNT(*) AS n_rows FROM daily GROUP BY 1"
)
def date_range(spark, sf_dir):
    return P.date_range(I.daily(spark, sf_dir), key=KEY, day=DAY)


@query(
    with_(I.READINGS)
    + """SELECT series_key, COUNT(*) AS n_rows, COUNT(*) FILTER (WHERE value IS NULL) + COUNT(*) FILTER (WHERE k IS NULL) AS missing_cells,
  ROUND(100 - (COUNT(*) FILTER (WHERE value IS NULL) + COUNT(*) FILTER (WHERE k IS NULL))::DOUBLE / (COUNT(*) * 2) * 100, 1) AS completeness
FROM readings GROUP BY 1"""
)
def completeness(spark, sf_dir):
    return Q.completeness(I.readings(spark, sf_dir), key=KEY, columns=["value", "k"])


@query(
    with_(I.DAILY, I.DENSE)
    + """SELECT series_key, COUNT(*) AS n_rows, 3 AS n_columns, MIN(day) AS first_day, MAX(day) AS last_day,
  1 AS numeric_columns, COUNT(*) FILTER (WHERE value IS NULL) AS missing_cells, COUNT(*) * 24 AS cell_bytes
FROM dense GROUP BY 1"""
)
def data_summary(spark, sf_dir):
    return P.data_summary(I.dense(spark, sf_dir), key=KEY, day=DAY, columns=["value"])


@query(
    with_(I.DAILY, I.DENSE)
    + """, joined AS (
  SELECT c.series_key, c.day, d.value, d.high, d.low, d.n_orders FROM dense c
  LEFT JOIN daily d ON d.series_key = c.series_key AND d.day = c.day),
counted AS (
  SELECT part AS series_key, COUNT(*) AS n_rows,
    (5 * COUNT(*) - COUNT(value) - COUNT(high) - COUNT(low) - COUNT(n_orders) - COUNT(high - low))::DOUBLE / (COUNT(*) * 5) AS missing_share
  FROM (SELECT *, series_key AS part FROM joined UNION ALL
    SELECT *, series_key || ' thin' FROM joined WHERE DAYOFYEAR(day) = 1 UNION ALL
    SELECT * REPLACE (NULL AS value, NULL AS high), series_key || ' holed' FROM joined) t GROUP BY 1),
judged AS (
  SELECT *, CONCAT_WS('; ', CASE WHEN n_rows < 100 THEN 'too few rows' END,
    CASE WHEN missing_share > 0.3 THEN 'too many missing values' END) AS errors FROM counted)
SELECT *, errors = '' AS valid FROM judged"""
)
def validate_series(spark, sf_dir):
    """Series as they are, reduced to one day a year, and with two lost columns: each verdict occurs."""
    gaps = densify_daily(I.daily(spark, sf_dir), key=KEY).select(KEY, DAY, "value", "high", "low", "n_orders")
    thin = gaps.where(F.dayofyear(DAY) == 1).withColumn(KEY, F.concat(KEY, F.lit(" thin")))
    holed = gaps.withColumns({KEY: F.concat(KEY, F.lit(" holed")), "value": F.lit(None).cast("decimal(28,2)"), "high": F.lit(None).cast("decimal(18,2)")})
    rows = gaps.unionByName(thin).unionByName(holed).withColumn("spread", F.col("high") - F.col("low"))
    out = Q.validate_series(rows, key=KEY, columns=["value", "high", "low", "n_orders", "spread"])
    return out.withColumn("errors", F.concat_ws("; ", "errors"))


PREPARED = """prepared AS (
  SELECT series_key, CAST(COUNT(*) FILTER (WHERE r <= FLOOR(n * 0.8::DOUBLE)) AS BIGINT) AS train_samples,
    CAST(COUNT(*) FILTER (WHERE r > FLOOR(n * 0.8::DOUBLE)) AS BIGINT) AS test_samples FROM (
    SELECT series_key, ROW_NUMBER() OVER (PARTITION BY series_key ORDER BY day) AS r,
      COUNT(*) OVER (PARTITION BY series_key) AS n FROM filled) t GROUP BY 1)"""


@query(
    with_(*I.SERIES, PREPARED)
    + """SELECT *, train_samples + test_samples AS total_samples, ROUND(train_samples::DOUBLE / test_samples, 2) AS train_test_ratio,
  CASE WHEN train_samples + test_samples < 1000 THEN 'Limited'
    WHEN ROUND(train_samples::DOUBLE / test_samples, 2) < 3 OR ROUND(train_samples::DOUBLE / test_samples, 2) > 5 THEN 'Fair'
    ELSE 'Good' END AS data_quality_score FROM prepared"""
)
def quality_label(spark, sf_dir):
    split = temporal_split(I.filled(spark, sf_dir), key=KEY, order=[DAY])
    prepared = split.groupBy(KEY).agg(
        F.count_if(F.col("split") == "train").alias("train_samples"),
        F.count_if(F.col("split") == "test").alias("test_samples"),
    )
    return Q.quality_label(prepared)


@query(
    with_(*I.DECISIONS)
    + """, trained AS (SELECT series_key, MAX(MAKE_DATE(run_year, 7, 28)) AS last FROM gated GROUP BY 1),
aged AS (
  SELECT s.series_key, COALESCE(CAST(DATE_DIFF('day', t.last, DATE '2001-08-01') AS INTEGER), 999) AS days_since_training
  FROM (SELECT DISTINCT series_key FROM daily UNION SELECT DISTINCT event_type FROM events) s LEFT JOIN trained t ON t.series_key = s.series_key)
SELECT *, days_since_training >= 7 AS should_retrain, GREATEST(0, 7 - days_since_training) AS next_retrain_in FROM aged"""
)
def staleness(spark, sf_dir):
    """Order series are trained every 28 July; the event series have never been trained."""
    trainings = I.gated(spark, sf_dir).select(KEY, F.make_date("run_year", F.lit(7), F.lit(28)).alias("trained"))
    events = I.readings(spark, sf_dir).select(KEY)
    series = I.daily(spark, sf_dir).select(KEY).unionByName(events).distinct()
    return Q.staleness(series, trainings, key=KEY, trained_at="trained", as_of=F.lit("2001-08-01").cast("date"))


@query(
    """WITH r AS (SELECT l_returnflag AS series_key, l_orderkey, l_linenumber, l_quantity, l_extendedprice, l_discount FROM lineitem),
facts AS (
  SELECT series_key, COUNT(*) AS n_rows,
    3 * COUNT(*) - COUNT(l_quantity) - COUNT(l_extendedprice) - COUNT(l_discount) AS missing,
    COUNT(*) FILTER (WHERE NOT l_quantity BETWEEN 1 AND 40) AS outside FROM r GROUP BY 1),
surplus AS (SELECT series_key, SUM(n - 1) AS s FROM (
  SELECT series_key, COUNT(*) AS n FROM r GROUP BY series_key, l_orderkey, l_linenumber) c GROUP BY 1),
long AS (
  SELECT series_key, 'q' AS c, l_quantity AS v FROM r UNION ALL SELECT series_key, 'p', l_extendedprice FROM r
  UNION ALL SELECT series_key, 'd', l_discount FROM r),
b AS (SELECT series_key, c, QUANTILE_CONT(v, 0.25) AS q1, QUANTILE_CONT(v, 0.75) AS q3 FROM long GROUP BY 1, 2),
o AS (SELECT l.series_key, COUNT(*) AS n_values,
    COUNT(*) FILTER (WHERE v < q1 - 3 * (q3 - q1) OR v > q3 + 3 * (q3 - q1)) AS n_out
  FROM long l JOIN b ON b.series_key = l.series_key AND b.c = l.c GROUP BY 1),
shares AS (
  SELECT f.series_key, n_rows, missing::DOUBLE / (n_rows * 3) AS null_share, s::DOUBLE / n_rows AS duplicate_share,
    outside::DOUBLE / n_rows AS out_of_range_share, n_out::DOUBLE / n_values AS outlier_share
  FROM facts f JOIN surplus s ON s.series_key = f.series_key JOIN o ON o.series_key = f.series_key)
SELECT *, null_share <= 0.1 AS null_ok, duplicate_share <= 0.05 AS duplicate_ok, out_of_range_share = 0 AS range_ok,
  outlier_share <= 0.05 AS outlier_ok, 1 - null_share >= 0.9 AS completeness_ok FROM shares"""
)
def dq_report(spark, sf_dir):
    rows = I.read(spark, sf_dir, "lineitem").select(
        F.col("l_returnflag").alias(KEY), "l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount"
    )
    return Q.quality_report(
        rows,
        key=KEY,
        columns=["l_quantity", "l_extendedprice", "l_discount"],
        identity=["l_orderkey", "l_linenumber"],
        ranges={"l_quantity": (1, 40)},
        daily=False,
    )


@query(
    with_(*I.RUNS)
    + """, unclear AS (SELECT * REPLACE (CASE WHEN model = 'naive_7' AND run_year = 1998 THEN NULL ELSE avg_rmse END AS avg_rmse) FROM results),
measured AS (
  SELECT series_key, run_year, model, 'performance_degradation' AS kind, avg_rmse / MIN(avg_rmse) OVER e - 1 AS value
  FROM unclear WINDOW e AS (PARTITION BY series_key, run_year)
  UNION ALL SELECT series_key, run_year, model, 'data_quality', test_rows / 365.0::DOUBLE FROM unclear
  UNION ALL SELECT series_key, run_year, model, 'error_rate', 1 - test_rows / 365.0::DOUBLE FROM unclear
  UNION ALL SELECT series_key, run_year, model, 'drift', value FROM (
    SELECT *, ABS(avg_mae / LAG(avg_mae) OVER o - 1) AS value, LAG(run_year) OVER o AS before
    FROM unclear WINDOW o AS (PARTITION BY series_key, model ORDER BY run_year)) d WHERE before IS NOT NULL)
SELECT *, CASE kind WHEN 'data_quality' THEN 0.7::DOUBLE WHEN 'drift' THEN 0.5 WHEN 'error_rate' THEN 0.05 ELSE 0.1 END AS threshold
FROM measured WHERE value IS NULL OR CASE kind WHEN 'data_quality' THEN value < 0.7 WHEN 'drift' THEN value > 0.5
  WHEN 'error_rate' THEN value > 0.05 ELSE value > 0.1 END"""
)
def alerts(spark, sf_dir):
    """Models behind the best, runs on too few days, days without a prediction, errors far from the year before;
    the error of one model is unknown in one year."""
    lost = (F.col("model") == "naive_7") & (F.col("run_year") == 1998)
    results = I.results(spark, sf_dir).withColumn("avg_rmse", F.when(~lost, F.col("avg_rmse")))
    best = F.min("avg_rmse").over(Window.partitionBy(*I.EXPERIMENT))
    years = Window.partitionBy(KEY, "model").orderBy("run_year")
    share = F.col("test_rows") / F.lit(365.0)
    values = {
        "performance_degradation": F.col("avg_rmse") / F.col("_best") - 1, "data_quality": share, "error_rate": 1 - share,
        "drift": F.abs(F.col("avg_mae") / F.col("_before") - 1),
    }
    kinds = F.array(*(F.struct(F.lit(k).alias("kind"), v.alias("value")) for k, v in values.items()))
    placed = results.withColumns({"_best": best, "_before": F.lag("avg_mae").over(years)})
    measured = placed.select(*I.EXPERIMENT, "model", "_before", F.inline(kinds))
    # The first year has no year before it.
    return Q.alerts(measured.where("kind <> 'drift' or _before is not null").drop("_before"), kind="kind", value="value")


UNCLEAR = ("unclear AS (SELECT * REPLACE ("
    + ", ".join(f"CASE WHEN model IN ('naive_7', 'mean_7') THEN NULL ELSE {c} END AS {c}" for c in ("avg_rmse", "avg_r2", "avg_mae"))
    + ") FROM results)")


@query(
    with_(*I.RUNS, UNCLEAR)
    + """SELECT series_key, run_year, model, ROUND(avg_rmse, 4) AS test_rmse,
  CASE WHEN avg_r2 IS NULL THEN NULL WHEN avg_r2 >= 0.95 THEN 'A+ (Excellent)' WHEN avg_r2 >= 0.9 THEN 'A (Très bon)'
    WHEN avg_r2 >= 0.8 THEN 'B (Bon)' WHEN avg_r2 >= 0.7 THEN 'C (Acceptable)' ELSE 'D (Insuffisant)' END AS performance_grade,
  CASE WHEN avg_rmse IS NULL THEN NULL WHEN MIN(avg_rmse) OVER e > 0 THEN ROUND((avg_rmse - MIN(avg_rmse) OVER e) / MIN(avg_rmse) OVER e * 100, 2) ELSE 0 END AS rmse_gap_percent,
  CASE WHEN avg_r2 IS NULL THEN NULL WHEN MAX(avg_r2) OVER e > 0 THEN ROUND((MAX(avg_r2) OVER e - avg_r2) / MAX(avg_r2) OVER e * 100, 2) ELSE 0 END AS r2_gap_percent
FROM unclear WINDOW e AS (PARTITION BY series_key, run_year)"""
)
def unknown_metrics(spark, sf_dir):
    """Grades and gaps where the metrics of one model are missing and those of another are NaN."""
    names = ["avg_rmse", "avg_r2", "avg_mae"]
    lost = F.when(F.col("model") == "mean_7", F.lit(float("nan"))).when(F.col("model") != "naive_7", F.lit(0.0))
    rows = I.results(spark, sf_dir).withColumn("_lost", lost)
    rows = rows.withColumns({c: F.when(F.col("_lost") == 0, F.col(c)).otherwise(F.col("_lost")) for c in names})
    out = S.performance_gaps(S.performance_summary(rows), I.EXPERIMENT)
    return out.select(*I.EXPERIMENT, "model", "test_rmse", "performance_grade", "rmse_gap_percent", "r2_gap_percent")


@query(
    with_(I.DAILY, """stored AS (SELECT series_key, day, value, high FROM daily WHERE day <= DATE '2001-06-30'),
batch AS (SELECT series_key, day, value, high FROM daily WHERE day >= DATE '2001-06-24')""")
    + """, added AS (SELECT * FROM batch b WHERE NOT EXISTS (
  SELECT 1 FROM stored s WHERE s.series_key = b.series_key AND s.day = b.day)),
total AS (SELECT series_key, day FROM stored UNION ALL SELECT series_key, day FROM added)
SELECT t.series_key, t.total_records, t.first_day, t.last_day, b.fetched, COALESCE(a.inserted, 0) AS inserted,
  b.newest_day, CAST(n.value AS DOUBLE) AS value, CAST(n.high AS DOUBLE) AS high
FROM (SELECT series_key, COUNT(*) AS total_records, MIN(day) AS first_day, MAX(day) AS last_day FROM total GROUP BY 1) t
JOIN (SELECT series_key, COUNT(*) AS fetched, MAX(day) AS newest_day FROM batch GROUP BY 1) b ON b.series_key = t.series_key
LEFT JOIN (SELECT series_key, COUNT(*) AS inserted FROM added GROUP BY 1) a ON a.series_key = t.series_key
JOIN batch n ON n.series_key = b.series_key AND n.day = b.newest_day"""
)
def collection_summary(spark, sf_dir):
    rows = I.stored_daily(spark, sf_dir).select(KEY, DAY, "value", "high")
    stored = rows.where(F.col(DAY) <= F.lit("2001-06-30").cast("date"))
    batch = rows.where(F.col(DAY) >= F.lit("2001-06-24").cast("date"))
    added = insert_absent(stored, batch, keys=[KEY, DAY])
    total = stored.unionByName(added)
    return P.collection_summary(total, batch, added, key=KEY, day=DAY, defaults={"value": 20.0, "high": 25.0})


@query(
    with_(I.READINGS)
    + """SELECT series_key, COUNT(*) AS total_collections, MAX(day) AS last_collection, CAST(SUM(n) AS BIGINT) AS collected_rows
FROM (SELECT series_key, CAST(ts AS DATE) AS day, COUNT(*) AS n FROM readings GROUP BY 1, 2) log GROUP BY 1"""
)
def collection_stats(spark, sf_dir):
    """A collection log (one entry per series and day) and its totals."""
    log = I.readings(spark, sf_dir).groupBy(KEY, F.to_date("ts").alias(DAY)).agg(F.count("*").alias("n"))
    return P.collection_stats(log, key=KEY, at=DAY, rows="n")


@query(
    with_(I.DAILY)
    + f"""SELECT series_key, day, metric, value FROM (
  SELECT series_key, day, 'max' AS metric, {_even('high', 1)} AS value, r FROM ranked UNION ALL
  SELECT series_key, day, 'min', {_even('low', 1)}, r FROM ranked) t WHERE r <= 30""".replace(
        "FROM ranked", "FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY series_key ORDER BY day DESC) AS r FROM daily) ranked"
    )
)
def dashboard_series(spark, sf_dir):
    """The last 30 days of each series for display, as (metric, value) rows."""
    shown = P.dashboard_series(
        I.daily(spark, sf_dir), key=KEY, day=DAY, columns={"max": "high", "min": "low"}, n=30
    )
    return P.metric_series(shown, ids=[KEY, DAY], metrics=["max", "min"])


@query(
    with_(*I.RUNS)
    + """SELECT series_key, run_year, model, avg_rmse, avg_mae, avg_r2, test_rows FROM results"""
)
def regression_metrics(spark, sf_dir):
    return I.results(spark, sf_dir).drop("training_seconds")


@query(
    with_(*I.SERIES, I.PREDICTIONS)
    + "SELECT series_key, ROUND(SQRT(AVG((y - yhat) * (y - yhat))), 4) AS pooled_rmse FROM predictions GROUP BY 1"
)
def pooled_rmse(spark, sf_dir):
    out = M.pooled_rmse(I.predictions(spark, sf_dir), [KEY])
    return out.select(KEY, F.round("pooled_rmse", 4).alias("pooled_rmse"))


@query(
    with_(*I.RUNS)
    + """SELECT model, ROUND(AVG(avg_rmse), 4) AS avg_rmse, ROUND(AVG(avg_mae), 4) AS avg_mae, ROUND(AVG(avg_r2), 4) AS avg_r2
FROM results GROUP BY 1"""
)
def average_over_targets(spark, sf_dir):
    """Averages over the series, as over several targets."""
    measured = I.results(spark, sf_dir).selectExpr("model", "avg_rmse rmse", "avg_mae mae", "avg_r2 r2")
    out = M.average_over_targets(measured, ["model"])
    return out.select("model", *[F.round(c, 4).alias(c) for c in ("avg_rmse", "avg_mae", "avg_r2")])


@query(
    with_(*I.SERIES, I.PREDICTIONS)
    + "SELECT series_key, model, ROUND(AVG(CASE WHEN y <> 0 THEN ABS((y - yhat) / y) END) * 100, 4) AS mape FROM predictions GROUP BY 1, 2"
)
def mape(spark, sf_dir):
    out = I.predictions(spark, sf_dir).groupBy(KEY, "model").agg(M.mape("y", "yhat").alias("mape"))
    return out.select(KEY, "model", F.round("mape", 4).alias("mape"))


@query(
    with_(*I.SERIES, I.PREDICTIONS)
    + """SELECT series_key, model, day, FLOOR(AVG(ABS(y - yhat)) OVER (PARTITION BY series_key, model ORDER BY day
  RANGE BETWEEN INTERVAL 6 DAYS PRECEDING AND CURRENT ROW) * 1000 + 0.2718) / 1000 AS mae_7d FROM predictions"""
)
def rolling_error(spark, sf_dir):
    """Logged predictions joined to what was observed, error of the last seven days."""
    log = durable(I.predictions(spark, sf_dir))
    each = [KEY, "model"]
    actual, log = log.select(*each, DAY, "y"), log.select(*each, DAY, "yhat")
    out = M.rolling_error(M.join_predictions(actual, log, [*each, DAY]), key=each, day=DAY, y="y", yhat="yhat")
    # Three digits, cut where no exact mean of cents falls: engines round ties differently.
    return out.select(*each, DAY, (F.floor(F.col("mae_7d") * 1000 + 0.2718) / 1000).alias("mae_7d"))


@query(
    with_(*I.SERIES, I.PREDICTIONS)
    + "SELECT series_key, model, day, yhat, yhat - 0.5 AS lower, yhat + 0.5 AS upper FROM predictions"
)
def prediction_band(spark, sf_dir):
    log = I.predictions(spark, sf_dir).select(KEY, "model", DAY, "yhat")
    return M.prediction_band(log, "yhat")


@query(
    """SELECT DISTINCT TRANSLATE(REPLACE(REPLACE(o_orderpriority || ' (' || o_orderstatus || ')/rmse', '(', ''), ')', ''), ' /', '__') AS metric
FROM orders"""
)
def clean_metric_names(spark, sf_dir):
    raw = F.concat("o_orderpriority", F.lit(" ("), "o_orderstatus", F.lit(")/rmse"))
    return I.read(spark, sf_dir, "orders").select(clean_metric_name(raw).alias("metric")).distinct()


@query(
    with_(*I.RUNS)
    + """SELECT m.series_key, m.model, y.metric, r.avg_rmse AS value
FROM (SELECT DISTINCT series_key, model FROM results) m CROSS JOIN (SELECT DISTINCT 'rmse_' || run_year AS metric FROM results) y
LEFT JOIN results r ON r.series_key = m.series_key AND r.model = m.model AND 'rmse_' || r.run_year = y.metric"""
)
def metrics_pivot(spark, sf_dir):
    """Model metrics over time, one column for each year of the runs, compared as rows."""
    runs = I.stored_results(spark, sf_dir).select(
        KEY, "model", F.format_string("rmse_%d", "run_year").alias("metric"), F.col("avg_rmse").alias("value")
    )
    wide = M.pivot_runs(runs, [KEY, "model"])
    return wide.unpivot([KEY, "model"], wide.columns[2:], "metric", "value")


@query(
    with_(*I.RUNS)
    + """SELECT series_key, run_year, best_model, best_rmse FROM (
  SELECT series_key, run_year, model AS best_model, avg_rmse AS best_rmse,
    ROW_NUMBER() OVER (PARTITION BY series_key, run_year ORDER BY avg_rmse, model) AS r FROM results) t WHERE r = 1"""
)
def select_simple(spark, sf_dir):
    return S.select_simple(I.results(spark, sf_dir), I.EXPERIMENT)


SCORE_COLUMNS = ["rmse_score", "r2_score", "mae_score", "time_score", "composite_score"]


@query(
    with_(*I.RUNS, I.SCORES)
    + "SELECT series_key, run_year, model, "
    + ", ".join(f"ROUND({c}, 6) AS {c}" for c in SCORE_COLUMNS)
    + " FROM scores"
)
def composite_score(spark, sf_dir):
    out = I.scores(spark, sf_dir)
    return out.select(*I.EXPERIMENT, "model", *[F.round(c, 6).alias(c) for c in SCORE_COLUMNS])


GATE_COLUMNS = [
    "ok_performance", "ok_first", "ok_rmse_gain", "ok_r2_gain", "ok_rows", "ok_time", "ok_score_gain", "should_deploy",
]


@query(with_(*I.DECISIONS) + f"SELECT series_key, run_year, model, {', '.join(GATE_COLUMNS)}, reasons FROM gated")
def deploy_gate(spark, sf_dir):
    out = I.gated(spark, sf_dir)
    return out.select(*I.EXPERIMENT, "model", *GATE_COLUMNS, F.concat_ws("; ", "reasons").alias("reasons"))


@query(
    with_(*I.RUNS)
    + """SELECT series_key, run_year, model, ROUND(avg_rmse, 4) AS test_rmse, ROUND_EVEN(avg_r2, 4) AS test_r2,
  ROUND(avg_mae, 4) AS test_mae, CASE WHEN avg_r2 >= 0.95 THEN 'A+ (Excellent)' WHEN avg_r2 >= 0.9 THEN 'A (Très bon)'
  WHEN avg_r2 >= 0.8 THEN 'B (Bon)' WHEN avg_r2 >= 0.7 THEN 'C (Acceptable)' ELSE 'D (Insuffisant)' END AS performance_grade
FROM results"""
)
def performance_summary(spark, sf_dir):
    out = S.performance_summary(I.results(spark, sf_dir))
    return out.select(*I.EXPERIMENT, "model", "test_rmse", "test_r2", "test_mae", "performance_grade")


@query(
    with_(*I.RUNS)
    + """SELECT series_key, run_year, model,
  CAST(ROW_NUMBER() OVER (PARTITION BY series_key, run_year ORDER BY avg_rmse, model) AS INTEGER) AS rank_rmse,
  CAST(ROW_NUMBER() OVER (PARTITION BY series_key, run_year ORDER BY avg_r2 DESC, model) AS INTEGER) AS rank_r2 FROM results"""
)
def rank_models(spark, sf_dir):
    return S.rank_models(I.results(spark, sf_dir), I.EXPERIMENT).select(*I.EXPERIMENT, "model", "rank_rmse", "rank_r2")


@query(
    with_(*I.RUNS)
    + """SELECT series_key, run_year, model,
  CASE WHEN MIN(avg_rmse) OVER e > 0 THEN ROUND((avg_rmse - MIN(avg_rmse) OVER e) / MIN(avg_rmse) OVER e * 100, 2) ELSE 0 END AS rmse_gap_percent,
  CASE WHEN MAX(avg_r2) OVER e > 0 THEN ROUND((MAX(avg_r2) OVER e - avg_r2) / MAX(avg_r2) OVER e * 100, 2) ELSE 0 END AS r2_gap_percent
FROM results WINDOW e AS (PARTITION BY series_key, run_year)"""
)
def performance_gaps(spark, sf_dir):
    out = S.performance_gaps(I.results(spark, sf_dir), I.EXPERIMENT)
    return out.select(*I.EXPERIMENT, "model", "rmse_gap_percent", "r2_gap_percent")


@query(
    with_(*I.DECISIONS)
    + """SELECT series_key, run_year, CONCAT_WS(' | ',
  CASE WHEN avg_r2 >= 0.95 THEN 'quality:excellent' WHEN avg_r2 >= 0.9 THEN 'quality:good'
    ELSE 'quality:limited' END,
  CASE WHEN should_deploy THEN 'deploy:yes' ELSE 'deploy:no ' || reasons END,
  CASE WHEN model IN ('naive_1', 'naive_7', 'season_364') THEN 'family:linear'
    ELSE 'family:trees' END) AS recommendations FROM gated"""
)
def recommendations(spark, sf_dir):
    out = S.recommendations(
        I.gated(spark, sf_dir), linear=["naive_1", "naive_7", "season_364"], trees=["mean_7", "mean_30"]
    )
    return out.select(*I.EXPERIMENT, F.concat_ws(" | ", "recommendations").alias("recommendations"))


@query(
    with_(*I.RUNS)
    + """SELECT series_key, model, run_year AS best_run, avg_rmse AS best_avg_rmse FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY series_key, model ORDER BY avg_rmse, run_year) AS r FROM results) t WHERE r = 1"""
)
def best_run(spark, sf_dir):
    return S.best_run(I.results(spark, sf_dir), [KEY, "model"], "avg_rmse", "run_year")


MODEL = [KEY, "model"]


def _versions(results):
    """Version rows: every (series, model) of the years before 1999, all approved, newest serving."""
    rows = results.where(F.col("run_year") < 1999)
    order = Window.partitionBy(*MODEL).orderBy("run_year")
    return rows.select(
        *MODEL,
        F.col("run_year").alias("run_id"),
        F.lit(True).alias("approved"),
        F.row_number().over(order).alias("version"),
    ).withColumn(
        "stage",
        F.when(F.col("version") == F.max("version").over(Window.partitionBy(*MODEL)), "Production").otherwise("Archived"),
    )


VERSIONS = """versions AS (
  SELECT *, CASE WHEN version = MAX(version) OVER (PARTITION BY series_key, model) THEN 'Production' ELSE 'Archived' END AS stage
  FROM (SELECT series_key, model, run_year AS run_id, TRUE AS approved,
    CAST(ROW_NUMBER() OVER (PARTITION BY series_key, model ORDER BY run_year) AS INTEGER) AS version
    FROM results WHERE run_year < 1999) v),
candidates AS (
  SELECT r.series_key, r.model, r.run_year AS run_id, r.avg_rmse <= b.avg_rmse AS approved
  FROM results r JOIN results b ON b.series_key = r.series_key AND b.run_year = r.run_year AND b.model = 'mean_30'
  WHERE r.run_year >= 1999),
numbered AS (
  SELECT c.*, CAST(COALESCE(h.highest, 0)
    + ROW_NUMBER() OVER (PARTITION BY c.series_key, c.model ORDER BY c.run_id) AS INTEGER) AS version
  FROM candidates c LEFT JOIN (SELECT series_key, model, MAX(version) AS highest FROM versions GROUP BY 1, 2) h
    ON h.series_key = c.series_key AND h.model = c.model),
together AS (
  SELECT series_key, model, run_id, approved, version, stage FROM versions UNION ALL
  SELECT series_key, model, run_id, approved, version, 'None' FROM numbered),
promoted AS (
  SELECT series_key, model, run_id, approved, version, CASE WHEN version = serving THEN 'Production'
    WHEN stage = 'Production' AND serving IS NOT NULL THEN 'Archived' ELSE stage END AS stage
  FROM (SELECT *, MAX(CASE WHEN approved THEN version END) OVER (PARTITION BY series_key, model) AS serving FROM together) t)"""


def _candidates(results):
    """Runs from 1999 on; approved where the model is no worse than the 30-day mean."""
    rows = results.where(F.col("run_year") >= 1999)
    limit = F.max(F.when(F.col("model") == "mean_30", F.col("avg_rmse"))).over(Window.partitionBy(*I.EXPERIMENT))
    return rows.withColumn("should_deploy", F.col("avg_rmse") <= limit)


def _promoted(spark, sf_dir):
    results = I.stored_results(spark, sf_dir)
    return register(_versions(results), _candidates(results), model=MODEL, run="run_year")


@query(with_(*I.RUNS, VERSIONS) + "SELECT series_key, model, run_id, approved, version FROM numbered")
def next_version(spark, sf_dir):
    results = I.stored_results(spark, sf_dir)
    candidates = _candidates(results).select(
        *MODEL, F.col("run_year").alias("run_id"), F.col("should_deploy").alias("approved")
    )
    return R.next_versions(_versions(results), candidates, MODEL, ["run_id"])


@query(with_(*I.RUNS, VERSIONS) + "SELECT series_key, model, run_id, approved, version, stage FROM promoted")
def promote_versions(spark, sf_dir):
    return _promoted(spark, sf_dir)


@query(
    with_(*I.RUNS, VERSIONS)
    + """SELECT series_key, model, stage, MAX(version) AS latest_version, MAX_BY(run_id, version) AS run_id,
  COUNT(*) AS n_versions FROM promoted GROUP BY 1, 2, 3"""
)
def list_models(spark, sf_dir):
    return R.list_models(_promoted(spark, sf_dir), MODEL)


@query(
    with_(*I.RUNS, VERSIONS)
    + """SELECT series_key, model, stage, latest_version, 'data_version=orders; deployment_ready=' || approved
  || '; mae=' || CAST(avg_mae AS DECIMAL(28,4)) || '; model_type=' || model || COALESCE('; r2_score=' || CAST(r2 AS DECIMAL(28,4)), '')
  || '; rmse=' || CAST(avg_rmse AS DECIMAL(28,4)) || '; training_date=' || run_id || '-12-31' AS tags
FROM (SELECT p.*, p.version AS latest_version, avg_mae, CASE WHEN p.run_id <> 1997 THEN avg_r2 END AS r2, avg_rmse,
    ROW_NUMBER() OVER (PARTITION BY p.series_key, p.model, stage ORDER BY version DESC) AS place
  FROM promoted p JOIN results r ON r.series_key = p.series_key AND r.model = p.model AND r.run_year = p.run_id) t
WHERE place = 1"""
)
def model_tags(spark, sf_dir):
    """The newest version of every stage with its tags; the R2 of one year is unknown and has no tag."""
    measured = I.stored_results(spark, sf_dir).withColumnRenamed("run_year", "run_id")
    measured = measured.withColumn("avg_r2", F.when(F.col("run_id") != 1997, F.col("avg_r2")))
    versions = _promoted(spark, sf_dir).join(measured, [*MODEL, "run_id"])
    tagged = R.with_tags(
        versions, metrics={"rmse": "avg_rmse", "r2_score": "avg_r2", "mae": "avg_mae"}, model_type="model", ready="approved",
        trained=F.make_date("run_id", F.lit(12), F.lit(31)), data="orders",
    )
    listed = R.list_models(tagged, MODEL)
    text = F.array_join(F.transform(F.array_sort(F.map_entries("tags")), lambda e: F.concat_ws("=", e["key"], e["value"])), "; ")
    return listed.select(*MODEL, "stage", "latest_version", text.alias("tags"))


@query(
    with_(*I.RUNS, VERSIONS)
    + """SELECT series_key, COUNT(DISTINCT model) AS models, COUNT(*) AS versions,
  COUNT(DISTINCT CASE WHEN stage = 'Production' THEN model END) AS serving FROM promoted GROUP BY 1"""
)
def model_counts(spark, sf_dir):
    return R.model_counts(_promoted(spark, sf_dir), [KEY], ["model"])


@query(
    with_(*I.RUNS, VERSIONS)
    + "SELECT series_key, model, MAX(version) AS version FROM promoted WHERE stage = 'Production' GROUP BY 1, 2"
)
def production_version(spark, sf_dir):
    return R.production_version(_promoted(spark, sf_dir), MODEL)


@query(
    with_(*I.RUNS)
    + " UNION ALL ".join(
        f"SELECT series_key, run_year, model, '{m}' AS metric, CAST({m} AS DOUBLE) AS value FROM results"
        for m in ("avg_rmse", "avg_mae", "avg_r2", "training_seconds", "test_rows")
    )
)
def run_log(spark, sf_dir):
    """Metrics as rows of the run log."""
    names = ["avg_rmse", "avg_mae", "avg_r2", "training_seconds", "test_rows"]
    return M.metrics_to_runs(I.results(spark, sf_dir), [*I.EXPERIMENT, "model"], names)


@query(
    with_(*I.SERIES, I.PREDICTIONS)
    + """SELECT f.series_key, f.day, p.model, CAST(f.value AS DOUBLE) AS value, COALESCE(p.yhat, 0) AS predicted_value FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY series_key ORDER BY day DESC) AS r FROM filled) f
LEFT JOIN (SELECT series_key, model, yhat, ROW_NUMBER() OVER (PARTITION BY series_key, model ORDER BY day DESC) AS r
  FROM predictions) p ON p.series_key = f.series_key AND p.r = 1 WHERE f.r = 1"""
)
def dashboard_headline(spark, sf_dir):
    """The newest day of each series with the newest prediction of every model beside it."""
    log = I.predictions(spark, sf_dir)
    newest = latest_row(I.filled(spark, sf_dir), key=KEY, order=[DAY]).withColumn("value", F.col("value").cast(D))
    predicted = keep_last(log, keys=[KEY, "model"], priority=[DAY]).select(KEY, "model", F.col("yhat").alias("value"))
    return P.headline(newest, predicted, key=KEY, columns=["value"], ids=["model"])


@query(
    with_(I.DAILY)
    + """SELECT series_key, STRING_AGG(CAST(day AS VARCHAR), ',' ORDER BY day) AS days,
  STRING_AGG(CAST(n_orders AS VARCHAR), ',' ORDER BY day) AS orders FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY series_key ORDER BY day DESC) AS r FROM daily) t WHERE r <= 30 GROUP BY 1"""
)
def chart_arrays(spark, sf_dir):
    """Equally long arrays of the last 30 days."""
    packed = P.chart_arrays(I.daily(spark, sf_dir), key=KEY, day=DAY, columns=["n_orders"], n=30)
    listed = [F.array_join(F.col(c).cast("array<string>"), ",").alias(n) for c, n in ((DAY, "days"), ("n_orders", "orders"))]
    return packed.select(KEY, *listed)


