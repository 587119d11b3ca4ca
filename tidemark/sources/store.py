"""The observation store: Parquet partitioned by year, one row per (series_key, day)."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..operators.ingest import insert_absent
from ..operators.report import history_range

YEAR = "year"


def read_if_exists(spark: SparkSession, path: str) -> DataFrame | None:
    """The table at ``path``, or None when nothing has been written there."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as problem:
        if problem.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def has_rows(df: DataFrame | None) -> bool:
    """Emptiness probe: reads at most one row."""
    return df is not None and not df.isEmpty()


def create_table(
    spark: SparkSession, name: str, schema: T.StructType, partition: str = YEAR, location: str | None = None
) -> None:
    """Create the catalog table if absent.  Partition pruning stands in for date indexes."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    place = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet PARTITIONED BY ({partition}){place}")


def write_observations(df: DataFrame, path: str, *, day: str = "day", mode: str = "append") -> None:
    """Write by year.

    The rebalance hint brings a year's rows together in files of the advisory partition size:
    adaptive execution splits large years and merges small ones.
    """
    dated = df.withColumn(YEAR, F.year(day))
    dated.hint("rebalance", F.col(YEAR)).write.mode(mode).partitionBy(YEAR).parquet(path)


def bootstrap_history(spark: SparkSession, path: str, history: DataFrame, *, day: str = "day") -> bool:
    """Load the history into an empty store; a store with rows is left alone."""
    if has_rows(read_if_exists(spark, path)):
        return False
    write_observations(history, path, day=day)
    return True


def touched_part(store: DataFrame, batch: DataFrame, *, day: str = "day") -> DataFrame:
    """The stored years that a batch has days in; other partitions are not read.

    Only the distinct years reach the driver, one number per calendar year.
    """
    years = [r[0] for r in batch.select(F.year(day)).distinct().collect() if r[0] is not None]
    return store.where(F.col(YEAR).isin(years))


def stored_days(spark: SparkSession, path: str, *, first: str, last: str, day: str = "day") -> DataFrame:
    """The stored days first..last, from the partitions of their years only."""
    return history_range(spark.read.parquet(path), day=day, first=first, last=last, year=YEAR)


def append_new_days(
    spark: SparkSession,
    path: str,
    batch: DataFrame,
    *,
    keys: Sequence[str],
    day: str = "day",
    order: Sequence[str] | None = None,
) -> None:
    """Append the rows whose key is not stored; running it again appends nothing."""
    store = read_if_exists(spark, path)
    if store is None:
        new = insert_absent(batch.limit(0), batch, keys=keys, day=day, order=order)
    else:
        new = insert_absent(touched_part(store, batch, day=day), batch, keys=keys, day=day, order=order)
    write_observations(new, path, day=day)


def store_twice(
    spark: SparkSession, paths: Sequence[str], batch: DataFrame, *, keys: Sequence[str], day: str = "day"
) -> None:
    """Keep several stores in step; each gets only the rows it lacks."""
    for path in paths:
        append_new_days(spark, path, batch, keys=keys, day=day)


def first_available(sources: Sequence[DataFrame | None]) -> DataFrame:
    """The first source that has rows, in order of preference."""
    for source in sources:
        if has_rows(source):
            return source
    raise ValueError("no data source has any rows")


def with_timestamp(df: DataFrame, text: str, ts: str = "datetime") -> DataFrame:
    """Make sure the frame has a timestamp column; build it from the text column if needed."""
    parsed = F.to_timestamp(F.col(text))
    return df.withColumn(ts, F.coalesce(F.col(ts), parsed) if ts in df.columns else parsed)


def stage(spark: SparkSession, path: str, build: Callable[[], DataFrame], *, rebuild: bool = False) -> DataFrame:
    """A stage table: read it if it was written before, otherwise build and write it."""
    existing = None if rebuild else read_if_exists(spark, path)
    if existing is None:
        build().write.mode("overwrite").parquet(path)
        existing = spark.read.parquet(path)
    return existing


def append_records(df: DataFrame, path: str) -> None:
    """Append to a record table such as runs, evaluations or model versions."""
    df.write.mode("append").parquet(path)
