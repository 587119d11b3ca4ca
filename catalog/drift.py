"""Distribution drift of the last seven days of each event series against the days before."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from tidemark.operators import drift as X
from tidemark.session import durable

from . import inputs as I
from .register import query, with_

KEY = "series_key"
WINDOW_DAYS = 7


def _labelled(spark, sf_dir):
    rows = I.readings(spark, sf_dir).withColumn("value", F.col("value").cast("double"))
    return X.label_samples(rows, key=KEY, day="ts", window_days=WINDOW_DAYS)


LABELLED = """labelled AS (
  SELECT r.series_key, CAST(r.value AS DOUBLE) AS value, r.k, DATE_DIFF('day', CAST(r.ts AS DATE), n.newest) < 7 AS is_recent
  FROM readings r JOIN (SELECT series_key, MAX(CAST(ts AS DATE)) AS newest FROM readings GROUP BY 1) n
    ON n.series_key = r.series_key)"""

BINNED = """edges AS (
  SELECT series_key, QUANTILE_CONT(value, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]) AS e
  FROM labelled WHERE NOT is_recent AND value IS NOT NULL GROUP BY 1),
binned AS (
  SELECT l.series_key, LEN(LIST_FILTER(e.e, lambda x: x < l.value)) AS bin,
    COUNT(*) FILTER (WHERE NOT is_recent) AS n_base, COUNT(*) FILTER (WHERE is_recent) AS n_recent
  FROM labelled l JOIN edges e ON e.series_key = l.series_key WHERE l.value IS NOT NULL GROUP BY 1, 2),
grid AS (
  SELECT g.series_key, g.bin, COALESCE(n_base, 0) AS n_base, COALESCE(n_recent, 0) AS n_recent
  FROM (SELECT series_key, UNNEST(RANGE(10)) AS bin FROM edges) g
  LEFT JOIN binned b ON b.series_key = g.series_key AND b.bin = g.bin),
shares AS (
  SELECT series_key, n_base, n_recent, n_base::DOUBLE / SUM(n_base) OVER s AS p, n_recent::DOUBLE / SUM(n_recent) OVER s AS q
  FROM grid WINDOW s AS (PARTITION BY series_key))"""


@query(
    with_(I.READINGS, LABELLED, BINNED)
    + """, scored AS (
  SELECT series_key, ROUND(SUM((GREATEST(q, 0.0001) - GREATEST(p, 0.0001)) * LN(GREATEST(q, 0.0001) / GREATEST(p, 0.0001))), 8) AS psi,
    CAST(SUM(n_base) AS BIGINT) AS n_base, CAST(SUM(n_recent) AS BIGINT) AS n_recent FROM shares GROUP BY 1)
SELECT *, CASE WHEN n_recent >= 100 AND n_base >= 100 THEN psi > 0.1 END AS drifted FROM scored"""
)
def drift_psi(spark, sf_dir):
    counts = X.binned_counts(_labelled(spark, sf_dir), key=KEY, value="value", recent="is_recent")
    scored = X.psi(counts, key=KEY).withColumn("psi", F.round("psi", 8))
    return X.drift_verdict(scored, "psi", threshold=X.THRESHOLDS["psi"], enough=["n_base", "n_recent"])


@query(
    with_(I.READINGS, LABELLED, BINNED)
    + """SELECT series_key, ROUND(SUM(
  CASE WHEN p > 0 THEN p * LOG2(p / ((p + q) / 2)) ELSE 0 END + CASE WHEN q > 0 THEN q * LOG2(q / ((p + q) / 2)) ELSE 0 END) / 2, 8)
  AS js_divergence FROM shares GROUP BY 1"""
)
def drift_js(spark, sf_dir):
    counts = X.binned_counts(_labelled(spark, sf_dir), key=KEY, value="value", recent="is_recent")
    out = X.js_divergence(counts, key=KEY)
    return out.select(KEY, F.round("js_divergence", 8).alias("js_divergence"))


@query(
    with_(I.READINGS, LABELLED)
    + """, c AS (
  SELECT series_key, CAST(FLOOR(k / 10.0) AS INTEGER) AS category, COUNT(*) FILTER (WHERE NOT is_recent) AS n_base,
    COUNT(*) FILTER (WHERE is_recent) AS n_recent FROM labelled GROUP BY 1, 2),
e AS (
  SELECT *, n_base::DOUBLE * SUM(n_recent) OVER s / SUM(n_base) OVER s AS expected FROM c WINDOW s AS (PARTITION BY series_key))
SELECT series_key, ROUND(SUM(CASE WHEN expected > 0 THEN (n_recent - expected) * (n_recent - expected) / expected END), 6) AS chi_square,
  COUNT(*) FILTER (WHERE n_base > 0) - 1 AS degrees, COUNT(*) FILTER (WHERE n_base = 0) AS new_categories
FROM e GROUP BY 1"""
)
def drift_chi2(spark, sf_dir):
    rows = _labelled(spark, sf_dir).withColumn("category", F.floor(F.col("k") / 10).cast("int"))
    out = X.chi_square(rows, key=KEY, category="category", recent="is_recent")
    return out.select(KEY, F.round("chi_square", 6).alias("chi_square"), "degrees", "new_categories")


STEPS = """counted AS (
  SELECT series_key, value, COUNT(*) FILTER (WHERE NOT is_recent) AS b, COUNT(*) FILTER (WHERE is_recent) AS r
  FROM labelled WHERE value IS NOT NULL GROUP BY 1, 2),
steps AS (
  SELECT series_key, value, LEAD(value) OVER o AS next_value, SUM(b) OVER o::DOUBLE / SUM(b) OVER k AS base_share,
    SUM(r) OVER o::DOUBLE / SUM(r) OVER k AS recent_share, LEAST(SUM(b) OVER k, SUM(r) OVER k) AS fewest
  FROM counted WINDOW o AS (PARTITION BY series_key ORDER BY value), k AS (PARTITION BY series_key))"""


def _steps(spark, sf_dir):
    return X.cumulative_shares(_labelled(spark, sf_dir), key=KEY, value="value", recent="is_recent")


@query(
    with_(I.READINGS, LABELLED, STEPS)
    + """SELECT series_key, ROUND(MAX(ABS(base_share - recent_share)), 8) AS ks,
  CASE WHEN MIN(fewest) >= 100 THEN MAX(ABS(base_share - recent_share)) > 0.15 END AS drifted FROM steps GROUP BY 1"""
)
def drift_ks(spark, sf_dir):
    scored = X.kolmogorov_smirnov(_steps(spark, sf_dir), key=KEY)
    judged = X.drift_verdict(scored, "ks", threshold=X.THRESHOLDS["kolmogorov_smirnov"])
    return judged.select(KEY, F.round("ks", 8).alias("ks"), "drifted")


@query(
    with_(I.READINGS, LABELLED, STEPS)
    + """SELECT series_key, ROUND(SUM(ABS(base_share - recent_share) * (next_value - value)), 6) AS wasserstein
FROM steps GROUP BY 1"""
)
def drift_wasserstein(spark, sf_dir):
    out = X.wasserstein(_steps(spark, sf_dir), key=KEY, value="value")
    return out.select(KEY, F.round("wasserstein", 6).alias("wasserstein"))


@query(
    with_(I.READINGS, LABELLED, BINNED, STEPS)
    + """, judged AS (
  SELECT series_key, MIN(fewest) AS fewest, MAX(ABS(base_share - recent_share)) > 0.15 AS over FROM steps GROUP BY 1
  UNION ALL SELECT series_key, MIN(fewest), SUM(ABS(base_share - recent_share) * (next_value - value)) > 0.2 FROM steps GROUP BY 1
  UNION ALL SELECT series_key, LEAST(SUM(n_base), SUM(n_recent)),
    SUM((GREATEST(q, 0.0001) - GREATEST(p, 0.0001)) * LN(GREATEST(q, 0.0001) / GREATEST(p, 0.0001))) > 0.1 FROM shares GROUP BY 1
  UNION ALL SELECT series_key, LEAST(SUM(n_base), SUM(n_recent)), SUM(
    CASE WHEN p > 0 THEN p * LOG2(p / ((p + q) / 2)) ELSE 0 END + CASE WHEN q > 0 THEN q * LOG2(q / ((p + q) / 2)) ELSE 0 END) / 2 > 0.15
  FROM shares GROUP BY 1),
verdicts AS (SELECT series_key, CASE WHEN fewest >= 100 THEN over END AS drifted FROM judged),
counted_verdicts AS (
  SELECT series_key, COUNT(drifted) AS n_verdicts, COUNT(*) FILTER (WHERE drifted)::DOUBLE / NULLIF(COUNT(drifted), 0) AS drift_share
  FROM verdicts GROUP BY 1)
SELECT *, COALESCE(drift_share > 0.3, FALSE) AS overall_drift FROM counted_verdicts"""
)
def drift_overall(spark, sf_dir):
    """Four statistics of every series judged together."""
    rows = _labelled(spark, sf_dir)
    steps = durable(X.cumulative_shares(rows, key=KEY, value="value", recent="is_recent"))
    counts = durable(X.binned_counts(rows, key=KEY, value="value", recent="is_recent"))
    scored = {
        "ks": (X.kolmogorov_smirnov(steps, key=KEY), X.THRESHOLDS["kolmogorov_smirnov"]),
        "wasserstein": (X.wasserstein(steps, key=KEY, value="value"), X.THRESHOLDS["wasserstein"]),
        "psi": (X.psi(counts, key=KEY), X.THRESHOLDS["psi"]),
        "js_divergence": (X.js_divergence(counts, key=KEY), X.THRESHOLDS["js_divergence"]),
    }
    verdicts = [X.drift_verdict(df, n, threshold=t).select(KEY, "drifted") for n, (df, t) in scored.items()]
    return X.overall_drift(reduce(lambda a, b: a.unionByName(b), verdicts), key=KEY)
