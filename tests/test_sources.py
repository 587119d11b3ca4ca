import datetime
import json

import pytest
from pyspark.sql import functions as F

from tidemark.operators import ingest as G
from tidemark.schema import DAILY_MEASURES, daily_schema
from tidemark.session import durable, shared_folder, work_path
from tidemark.sources import files, store

KEYS = ["series_key", "day"]


def test_daily_payload_text(spark):
    payload = {"daily": {"time": ["2024-01-01", "2024-01-02"], "temperature_2m_max": [20.5, None]}}
    df = spark.createDataFrame([("a", json.dumps(payload))], "series_key string, payload string")
    rows = files.parse_daily(df, "payload", ids=["series_key"]).orderBy("day").collect()
    assert [r.temperature_2m_max for r in rows] == [20.5, None]
    assert rows[0].day == datetime.date(2024, 1, 1) and rows[0].rain_sum is None
    assert "humidity" not in rows[0] and len(rows[0]) == len(DAILY_MEASURES) - 1 + 2


def test_hourly_payload_text(spark):
    payload = {"hourly": {"time": ["2024-01-01T00:00", "2024-01-01T01:00"], "rain": [0.0, 1.5]}}
    df = spark.createDataFrame([("a", json.dumps(payload))], "series_key string, payload string")
    rows = files.parse_hourly(df, "payload", ids=["series_key"]).orderBy("ts").collect()
    assert rows[1].ts == datetime.datetime(2024, 1, 1, 1) and rows[1].rain == 1.5


def test_csv_round_trip_and_missing_text(spark, series, tmp_path):
    path = str(tmp_path / "csv")
    files.write_csv(series({"a": [1.5, None]}), path)
    back = files.read_csv(spark, path, "series_key string, day date, value double")
    assert sorted(back.select("value").collect(), key=str) == [(1.5,), (None,)]
    assert files.read_csv(spark, path).schema["value"].dataType.simpleString() == "double"


def test_documents(spark, tmp_path):
    (tmp_path / "result.json").write_text(json.dumps({"best_model": "m", "models_performance": {"m": {"r2": 0.9}}}, indent=1))
    df = files.read_documents(spark, str(tmp_path / "result.json"), "best_model string, models_performance string")
    rows = files.unpack_metrics(df, "models_performance", ids=["best_model"]).collect()
    assert [tuple(r) for r in rows] == [("m", "m", "r2", 0.9)]
    files.write_json(df, str(tmp_path / "out"))
    assert spark.read.json(str(tmp_path / "out")).count() == 1


def test_store_bootstrap_append_and_replay(spark, series):
    path = work_path(spark, "test-store")
    history, batch = series({"a": [1, 2, 3]}), series({"a": [30, 40, 50]}, first="2023-01-03")
    assert store.read_if_exists(spark, path) is None
    assert store.bootstrap_history(spark, path, history)
    assert not store.bootstrap_history(spark, path, history)
    for _ in range(2):
        store.append_new_days(spark, path, batch, keys=KEYS)
    stored = [r.value for r in spark.read.parquet(path).orderBy("day").collect()]
    assert stored == [1, 2, 3, 40, 50]  # stored days never change


def test_append_to_nothing_and_several_stores(spark, series):
    paths = [work_path(spark, "test-store") for _ in range(2)]
    store.store_twice(spark, paths, series({"a": [1, 2]}), keys=KEYS)
    store.store_twice(spark, paths, series({"a": [1, 2, 3]}), keys=KEYS)
    assert [spark.read.parquet(p).count() for p in paths] == [3, 3]


def test_insert_absent_takes_the_first_row_of_a_batch(spark, series):
    stored = series({"a": [1]})
    batch = series({"a": [9, 7]}).union(series({"a": [9, 5]}))
    new = G.insert_absent(stored, batch, keys=KEYS, order=["value"]).collect()
    assert [(r.day.day, r.value) for r in new] == [(2, 5.0)]
    assert G.insert_report(stored, batch, keys=KEYS).first().asDict() == {"fetched": 4, "inserted": 1}


def test_upsert_and_forecast(spark, series):
    stored = series({"a": [1, 2]}).withColumn("version", F.lit(1))
    batch = series({"a": [9]}, first="2023-01-02").withColumn("version", F.lit(2))
    merged = G.upsert_latest(stored, batch, keys=KEYS, version=["version"]).orderBy("day").collect()
    assert [r.value for r in merged] == [1, 9]
    again = G.upsert_latest(stored, stored.withColumn("version", F.lit(0)), keys=KEYS, version=["version"])
    assert again.count() == 2
    forecast = G.merge_forecast(series({"a": [1, 2]}), series({"a": [8]}), keys=KEYS).orderBy("day").collect()
    assert [r.value for r in forecast] == [8, 2]


def test_union_fills_columns_one_side_lacks(spark, series):
    stored = series({"a": [1]})
    batch = series({"a": [2]}, first="2023-01-02").withColumn("extra", F.lit(5))
    out = G.append_absent(stored, batch, keys=KEYS).orderBy("day").collect()
    assert [r.extra for r in out] == [None, 5]


def test_source_choice(spark, series):
    empty, some = series({"a": [1]}).limit(0), series({"a": [1]})
    assert store.first_available([None, empty, some]).count() == 1
    with pytest.raises(ValueError):
        store.first_available([None, empty])
    picked = G.by_source_priority({"db": some, "file": series({"a": [5, 6]})}, keys=KEYS).orderBy("day").collect()
    assert [(r.value, r.source) for r in picked] == [(1.0, "db"), (6.0, "file")]


def test_stage_is_built_once(spark, series):
    path = work_path(spark, "test-stage")
    store.stage(spark, path, lambda: series({"a": [1]}))
    assert store.stage(spark, path, lambda: series({"a": [1, 2]})).count() == 1
    assert store.stage(spark, path, lambda: series({"a": [1, 2]}), rebuild=True).count() == 2
    store.append_records(series({"a": [3]}), path)
    assert spark.read.parquet(path).count() == 3


def test_catalog_table(spark, tmp_path):
    for _ in range(2):
        store.create_table(spark, "observations", daily_schema(), location=str(tmp_path / "observations"))
    assert not store.has_rows(spark.table("observations"))
    assert set(spark.table("observations").columns) == set(daily_schema().names)
    spark.sql("DROP TABLE observations")


def test_timestamp_column(spark):
    df = spark.createDataFrame([("2024-01-02",)], "time string")
    made = store.with_timestamp(df, "time")
    assert made.first().datetime == datetime.datetime(2024, 1, 2)
    kept = store.with_timestamp(made.withColumn("datetime", F.lit(None).cast("timestamp")), "time")
    assert kept.first().datetime == datetime.datetime(2024, 1, 2)


def test_shared_folder_comes_from_the_session(spark):
    assert shared_folder(spark).rstrip("/") == spark.conf.get("spark.checkpoint.dir").rstrip("/")
    written = durable(spark.range(5)).inputFiles()
    assert written and all(shared_folder(spark).removeprefix("file:").rstrip("/") in f for f in written)


def test_appending_and_ranges_read_only_the_years_they_touch(spark, series):
    path = work_path(spark, "test-touched")
    store.write_observations(series({"a": range(800)}), path)
    part = store.touched_part(spark.read.parquet(path), series({"a": [1]}, first="2024-02-01"))
    assert "PartitionFilters: [isnotnull(year" in part._jdf.queryExecution().toString()
    assert part.count() == 366
    days = store.stored_days(spark, path, first="2024-03-01", last="2024-03-31")
    assert "PartitionFilters: [isnotnull(year" in days._jdf.queryExecution().toString()
    assert days.count() == 31


def test_writes_are_pruned_by_year(spark, series):
    path = work_path(spark, "test-years")
    store.write_observations(series({"a": range(800)}), path)
    plan = spark.read.parquet(path).where("year = 2024")._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(year" in plan
    assert spark.read.parquet(path).where("year = 2024").count() == 366
