"""Payload parsing, deduplication, merging and the observation store."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions.calendar import season
from tidemark.functions.scalars import (
    day_text,
    name_predictions,
    parse_iso_timestamp,
    project_allow_list,
    resolve_aliases,
    season_fallback,
    vector_values,
)
from tidemark.operators import ingest as G
from tidemark.operators.clean import keep_last
from tidemark.operators.report import append_today
from tidemark.operators.features import last_rows, latest_row
from tidemark.operators.resample import daily_rollup
from tidemark.session import durable, work_path
from tidemark.sources import files, store

from . import inputs as I
from .register import query, with_

KEY, DAY = "series_key", "day"
KEYS = [KEY, DAY]
D = "double"

# Where "stored history" ends and where the overlapping new batch begins.
STORED_UNTIL, BATCH_FROM = "2000-06-30", "2000-06-01"


def _as_double(*names):
    return [F.col(n).cast(D).alias(n) for n in names]


def _daily_payloads(spark, sf_dir):
    """Daily payloads, one per series and month, as JSON text."""
    rows = I.daily(spark, sf_dir).select(KEY, DAY, *_as_double("value", "high"))
    # A month has at most 31 days, so the arrays stay short.
    point = F.array_sort(F.collect_list(F.struct(F.date_format(DAY, "yyyy-MM-dd").alias("time"), "value", "high")))
    grouped = rows.groupBy(KEY, F.trunc(DAY, "month").alias("_month")).agg(point.alias("p"))
    section = F.struct(*[F.col(f"p.{c}").alias(c) for c in ("time", "value", "high")])
    return grouped.select(KEY, F.col("_month").alias("month"), F.to_json(F.struct(section.alias("daily"))).alias("payload"))


@query(with_(I.DAILY) + "SELECT series_key, day, CAST(value AS DOUBLE) AS value, CAST(high AS DOUBLE) AS high FROM daily")
def parse_daily_payload(spark, sf_dir):
    """Daily payloads parsed back into rows."""
    return files.parse_daily(_daily_payloads(spark, sf_dir), "payload", ids=[KEY], measures=["value", "high"])


@query(
    with_(I.DAILY)
    + """, months AS (SELECT series_key, MONTH(day) AS m, COUNT(*) AS n FROM daily GROUP BY series_key, DATE_TRUNC('month', day), MONTH(day))
SELECT series_key, COUNT(*) AS payloads, COUNT(*) FILTER (m % 5 = 0) AS unreadable,
  CAST(SUM(n) FILTER (m % 5 <> 0) AS BIGINT) AS n_rows, COUNT(*) FILTER (m = 7) AS without_day FROM months GROUP BY 1"""
)
def unreadable_payloads(spark, sf_dir):
    """Payloads cut off in every fifth month and with a bad date in July: nothing is lost without a trace."""
    month = F.month("month")
    broken = F.when(month % 5 == 0, F.left("payload", F.lit(10))).when(
        month == 7, F.regexp_replace("payload", r'"time":\["[^"]*"', '"time":["no date"')
    )
    payloads = durable(_daily_payloads(spark, sf_dir).withColumn("payload", F.coalesce(broken, F.col("payload"))))
    options = {"ids": [KEY], "measures": ["value", "high"]}
    lost = files.unreadable(payloads, "payload", section="daily", **options).groupBy(KEY).agg(F.count("*").alias("unreadable"))
    rows = files.parse_daily(payloads, "payload", **options).groupBy(KEY)
    rows = rows.agg(F.count("*").alias("n_rows"), F.count_if(F.col(DAY).isNull()).alias("without_day"))
    return payloads.groupBy(KEY).agg(F.count("*").alias("payloads")).join(lost, KEY).join(rows, KEY)


@query(
    with_(I.READINGS)
    + """SELECT series_key, DATE_TRUNC('hour', ts) AS ts, CAST(MAX(value) AS DOUBLE) AS temperature_2m,
  CAST(MAX(k) AS DOUBLE) AS weathercode FROM readings GROUP BY 1, 2"""
)
def parse_hourly_payload(spark, sf_dir):
    """Hourly payloads, 24 entries per series and day, written as JSON text and parsed back."""
    hourly = (
        I.readings(spark, sf_dir)
        .groupBy(KEY, F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("ts"))
        .agg(F.max("value").cast(D).alias("temperature_2m"), F.max("k").cast(D).alias("weathercode"))
    )
    time = F.date_format("ts", "yyyy-MM-dd'T'HH:mm").alias("time")
    point = F.array_sort(F.collect_list(F.struct(time, "temperature_2m", "weathercode")))
    grouped = hourly.groupBy(KEY, F.to_date("ts").alias("_day")).agg(point.alias("p"))
    section = F.struct(*[F.col(f"p.{c}").alias(c) for c in ("time", "temperature_2m", "weathercode")])
    payloads = grouped.select(KEY, F.to_json(F.struct(section.alias("hourly"))).alias("payload"))
    return files.parse_hourly(payloads, "payload", ids=[KEY], measures=["temperature_2m", "weathercode"])


@query(
    with_(*I.RUNS)
    + """SELECT series_key, run_year, model, 'avg_rmse' AS metric, avg_rmse AS value FROM results
UNION ALL SELECT series_key, run_year, model, 'avg_r2', avg_r2 FROM results"""
)
def explode_run_metrics(spark, sf_dir):
    """Result documents {model: {metric: value}} per run, parsed to rows."""
    metrics = F.create_map(F.lit("avg_rmse"), F.col("avg_rmse"), F.lit("avg_r2"), F.col("avg_r2"))
    # A run compares a handful of models, so its document is small.
    documents = (
        I.results(spark, sf_dir)
        .groupBy(*I.EXPERIMENT)
        .agg(F.to_json(F.map_from_entries(F.collect_list(F.struct("model", metrics)))).alias("document"))
    )
    return files.unpack_metrics(documents, "document", ids=I.EXPERIMENT)


@query(with_(I.DAILY) + "SELECT series_key, day, CAST(value AS DOUBLE) AS value FROM daily")
def csv_scan(spark, sf_dir):
    """CSV sink and scan with a fixed schema."""
    path = work_path(spark, "csv")
    files.write_csv(I.daily(spark, sf_dir).select(KEY, DAY, *_as_double("value")), path)
    return files.read_csv(spark, path, "series_key string, day date, value double")


@query(with_(I.DAILY) + "SELECT series_key, day, CAST(value AS DOUBLE) AS value FROM daily")
def bootstrap_history(spark, sf_dir):
    """Load an empty store; the second load finds rows and does nothing."""
    path = work_path(spark, "store")
    history = I.daily(spark, sf_dir).select(KEY, DAY, *_as_double("value"))
    store.bootstrap_history(spark, path, history)
    store.bootstrap_history(spark, path, history)
    return spark.read.parquet(path).select(KEY, DAY, "value")


STORED = f"""stored AS (SELECT series_key, day, value FROM daily WHERE day <= DATE '{STORED_UNTIL}'),
batch AS (SELECT series_key, day, value * 2 AS value FROM daily WHERE day >= DATE '{BATCH_FROM}')"""


def _stored_and_batch(spark, sf_dir):
    rows = I.stored_daily(spark, sf_dir).select(KEY, DAY, "value")
    stored = rows.where(F.col(DAY) <= F.lit(STORED_UNTIL).cast("date"))
    batch = rows.where(F.col(DAY) >= F.lit(BATCH_FROM).cast("date")).withColumn("value", F.col("value") * 2)
    return stored, batch


@query(
    with_(I.DAILY, STORED)
    + """SELECT series_key, day, CAST(value AS DOUBLE) AS value FROM stored
UNION ALL SELECT series_key, day, CAST(value AS DOUBLE) FROM batch b
WHERE NOT EXISTS (SELECT 1 FROM stored s WHERE s.series_key = b.series_key AND s.day = b.day)"""
)
def insert_absent_(spark, sf_dir):
    """Stored rows stay as they are; only unknown days of the batch come in."""
    stored, batch = _stored_and_batch(spark, sf_dir)
    twice = batch.unionByName(batch)
    return G.append_absent(stored, twice, keys=KEYS, order=["value"]).select(*KEYS, *_as_double("value"))


@query(
    with_(I.DAILY, STORED)
    + """SELECT series_key, day, CAST(value AS DOUBLE) AS value FROM stored
UNION ALL SELECT series_key, day, CAST(value AS DOUBLE) FROM batch b
WHERE NOT EXISTS (SELECT 1 FROM stored s WHERE s.series_key = b.series_key AND s.day = b.day)"""
)
def cumulative_append(spark, sf_dir):
    """The written store after bootstrap and two deliveries of the same batch."""
    stored, batch = _stored_and_batch(spark, sf_dir)
    path = work_path(spark, "cumulative")
    stored = stored.select(*KEYS, *_as_double("value"))
    batch = batch.select(*KEYS, *_as_double("value"))
    store.bootstrap_history(spark, path, stored)
    for _ in range(2):
        store.append_new_days(spark, path, batch, keys=KEYS)
    return spark.read.parquet(path).select(*KEYS, "value")


@query(
    with_(I.DAILY, STORED)
    + """SELECT (SELECT COUNT(*) FROM batch) AS fetched, (SELECT COUNT(*) FROM batch b
  WHERE NOT EXISTS (SELECT 1 FROM stored s WHERE s.series_key = b.series_key AND s.day = b.day)) AS inserted"""
)
def insert_report_(spark, sf_dir):
    stored, batch = _stored_and_batch(spark, sf_dir)
    return G.insert_report(stored, batch, keys=KEYS)


@query(
    with_(I.DAILY, STORED)
    + """SELECT COALESCE(b.series_key, s.series_key) AS series_key, COALESCE(b.day, s.day) AS day,
  CAST(COALESCE(b.value, s.value) AS DOUBLE) AS value
FROM stored s FULL JOIN batch b ON s.series_key = b.series_key AND s.day = b.day"""
)
def upsert_latest(spark, sf_dir):
    """Archive and forecast merged; the forecast wins."""
    stored, batch = _stored_and_batch(spark, sf_dir)
    return G.merge_forecast(stored, batch, keys=KEYS).select(*KEYS, *_as_double("value"))


@query(
    """SELECT o_custkey, o_orderstatus, o_orderkey, o_totalprice FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY o_custkey, o_orderstatus ORDER BY o_orderdate DESC, o_orderkey DESC) AS r
  FROM orders) t WHERE r = 1"""
)
def dedup_keep_last(spark, sf_dir):
    rows = I.read(spark, sf_dir, "orders").select(
        "o_custkey", "o_orderstatus", "o_orderkey", "o_totalprice", "o_orderdate"
    )
    kept = keep_last(rows, keys=["o_custkey", "o_orderstatus"], priority=["o_orderdate", "o_orderkey"])
    return kept.drop("o_orderdate")


SOURCES = """sourced AS (
  SELECT o_orderpriority AS series_key, CAST(o_orderdate AS DATE) AS day, o_orderstatus,
         SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS value
  FROM orders GROUP BY 1, 2, 3)"""


@query(
    with_(SOURCES)
    + """SELECT series_key, day, CAST(value AS DOUBLE) AS value,
  CASE o_orderstatus WHEN 'F' THEN 'database' WHEN 'O' THEN 'cumulative' ELSE 'historical' END AS source
FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY series_key, day
  ORDER BY CASE o_orderstatus WHEN 'F' THEN 0 WHEN 'O' THEN 1 ELSE 2 END) AS r FROM sourced) t WHERE r = 1"""
)
def source_priority(spark, sf_dir):
    """Per day the row of the most trusted source that has one."""
    orders = I.read(spark, sf_dir, "orders").select(
        F.col("o_orderpriority").alias(KEY),
        F.col("o_orderdate").alias("ts"),
        F.col("o_totalprice").cast("decimal(18,2)").alias("price"),
        "o_orderstatus",
    )
    names = {"F": "database", "O": "cumulative", "P": "historical"}
    sources = {
        name: daily_rollup(
            orders.where(F.col("o_orderstatus") == status), key=KEY, ts="ts", rules={"value": ("sum", "price")}
        )
        for status, name in names.items()
    }
    return G.by_source_priority(sources, keys=KEYS).select(*KEYS, *_as_double("value"), "source")


@query(
    with_(I.DAILY)
    + """, latest AS (
  SELECT * EXCLUDE (r) FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY series_key ORDER BY day DESC) AS r FROM daily) t
  WHERE r <= 30)
SELECT series_key, day, CAST(value AS DOUBLE) AS value FROM latest
UNION ALL SELECT series_key, day + 1, CAST(value AS DOUBLE) FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY series_key ORDER BY day DESC) AS r FROM latest) n WHERE r = 1"""
)
def append_today_(spark, sf_dir):
    """Today's row joins a 30-day series once, however often it is delivered."""
    series = last_rows(I.stored_daily(spark, sf_dir).select(KEY, DAY, "value"), key=KEY, order=DAY, n=30)
    today = latest_row(series, key=KEY, order=[DAY]).withColumn(DAY, F.date_add(DAY, 1))
    once = append_today(series, today, keys=KEYS)
    return append_today(once, today, keys=KEYS).select(*KEYS, *_as_double("value"))


@query(with_(I.DAILY) + "SELECT series_key, day, n_orders FROM daily")
def project_allow_list_(spark, sf_dir):
    return project_allow_list(I.daily(spark, sf_dir), [KEY, DAY, "humidity", "n_orders"])


@query(
    with_(I.READINGS)
    + """SELECT event_id, CAST(COALESCE(value, 0) AS DOUBLE) AS temperature_2m_mean, CAST(k AS DOUBLE) AS relative_humidity_2m,
  0.0::DOUBLE AS precipitation_sum FROM readings"""
)
def alias_coalesce(spark, sf_dir):
    """Columns under their older names with units, missing values and missing columns defaulted."""
    rows = I.readings(spark, sf_dir).select(
        "event_id",
        F.col("value").cast(D).alias("temperature_2m_mean (°C)"),
        F.col("k").cast(D).alias("relative_humidity_2m (%)"),
    )
    names = {
        "temperature_2m_mean": ["temperature_2m_mean (°C)", "temperature_2m_mean"],
        "relative_humidity_2m": ["relative_humidity_2m (%)", "relative_humidity_2m"],
        "precipitation_sum": ["precipitation_sum (mm)", "precipitation_sum"],
    }
    return resolve_aliases(rows, names)


@query(
    """SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day, SUBSTR(CAST(o_orderdate AS VARCHAR), 1, 10) AS day_label,
  ROUND(20.0::DOUBLE + 5 * SIN(2 * PI() * MONTH(o_orderdate) / 12)
    + 0.02::DOUBLE * (YEAR(o_orderdate) - 2000), 6) AS forecast
FROM orders"""
)
def fallback_forecast(spark, sf_dir):
    value = season_fallback(F.year("o_orderdate"), F.month("o_orderdate"))
    return I.read(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.to_date("o_orderdate").alias(DAY),
        F.round(value, 6).alias("forecast"),
        day_text(F.col("o_orderdate")).alias("day_label"),
    )


@query(
    """SELECT event_id, CAST(ts AS DATE) AS day, CAST(DATE_TRUNC('second', ts) AS TIMESTAMP) AS parsed,
  CASE WHEN MONTH(ts) IN (12, 1, 2) THEN 1 WHEN MONTH(ts) < 6 THEN 2 WHEN MONTH(ts) < 9 THEN 3 ELSE 4 END AS season
FROM events"""
)
def parse_timestamps(spark, sf_dir):
    """ISO text with a trailing Z back to timestamps."""
    text = F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("Z"))
    rows = I.read(spark, sf_dir, "events").select("event_id", "ts", text.alias("text"))
    return rows.select(
        "event_id",
        F.to_date("ts").alias(DAY),
        parse_iso_timestamp(F.col("text")).cast("timestamp_ntz").alias("parsed"),
        season(F.month("ts")).alias("season"),
    )


FEATURE_NAMES = ["f_value", "f_missing", "f_k"]


@query(
    with_(I.READINGS)
    + """SELECT event_id, CAST(COALESCE(value, 0) AS DOUBLE) AS target_0, 0.0::DOUBLE AS target_1,
  CAST(k AS DOUBLE) AS target_2 FROM readings"""
)
def map_to_vector(spark, sf_dir):
    """A batch of feature maps exploded, ordered into vectors and named again."""
    requests = I.readings(spark, sf_dir).select(
        "event_id",
        F.map_filter(
            F.create_map(
                F.lit("f_k"), F.col("k").cast(D), F.lit("f_value"), F.col("value").cast(D), F.lit("other"), F.lit(1.0)
            ),
            lambda _, v: v.isNotNull(),
        ).alias("features"),
    )
    named = requests.select("event_id", name_predictions(vector_values(F.col("features"), FEATURE_NAMES), None, 3).alias("out"))
    return named.select("event_id", *[F.col("out")[f"target_{i}"].alias(f"target_{i}") for i in range(3)])


@query(
    with_(I.DAILY)
    + "SELECT series_key, day, CAST(value AS DOUBLE) AS value FROM daily WHERE day BETWEEN DATE '1998-01-01' AND DATE '1998-12-31'"
)
def history_range(spark, sf_dir):
    """One year of history: the filter reaches the scan."""
    from tidemark.operators.report import history_range as between

    return between(I.daily(spark, sf_dir), day=DAY, first="1998-01-01", last="1998-12-31").select(
        *KEYS, *_as_double("value")
    )


@query(
    with_(I.DAILY)
    + """SELECT series_key, day, CASE WHEN DATE_DIFF('day', day, DATE '2001-08-01') <= 30 THEN 'keep'
  WHEN DATE_DIFF('day', day, DATE '2001-08-01') <= 90 THEN 'archive' ELSE 'delete' END AS retention FROM daily"""
)
def retention_split_(spark, sf_dir):
    from tidemark.operators.report import retention_split

    as_of = F.lit("2001-08-01").cast("date")
    return retention_split(
        I.daily(spark, sf_dir).select(*KEYS), day=DAY, as_of=as_of, keep_days=30, archive_days=90
    )
