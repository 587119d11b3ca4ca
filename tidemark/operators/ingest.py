"""Combining new observations with what is already stored."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window, functions as F

from .clean import keep_last
from .features import feature_reach


def keep_first(df: DataFrame, *, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key: the one with the smallest order."""
    rest = [c for c in df.columns if c not in keys]
    best = df.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("_row"))
    return best.select(*keys, "_row.*").select(*df.columns)


def absent_rows(store: DataFrame, batch: DataFrame, *, keys: Sequence[str], day: str = "day") -> DataFrame:
    """Batch rows whose key is not stored yet.

    The store's keys are first restricted to the days that occur in the batch.  Which partitions
    of a stored table are read is decided by whoever reads it (``store.touched_part``).
    """
    days = batch.select(day).distinct()
    stored = store.select(*keys).join(days, day, "left_semi")
    return batch.join(stored, list(keys), "left_anti")


def insert_absent(
    store: DataFrame, batch: DataFrame, *, keys: Sequence[str], day: str = "day", order: Sequence[str] | None = None
) -> DataFrame:
    """Rows to append: the batch's first row per key, where the store has none.

    Stored rows are never changed, so replaying a batch adds nothing.  Rows without a key cannot
    be told from stored ones and are not inserted; ``rows_without_key`` returns them.
    """
    batch = batch.dropna(subset=list(keys))
    once = keep_first(batch, keys=keys, order=order) if order else batch.dropDuplicates(list(keys))
    return absent_rows(store, once, keys=keys, day=day)


def rows_without_key(batch: DataFrame, *, keys: Sequence[str]) -> DataFrame:
    """Rows of a batch that lack a part of the key, for the caller to report or repair."""
    return batch.where(reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys]))


def append_absent(store: DataFrame, batch: DataFrame, **kw: object) -> DataFrame:
    """The store followed by the absent rows of the batch; columns one side lacks are NULL."""
    return store.unionByName(insert_absent(store, batch, **kw), allowMissingColumns=True)


def upsert_latest(store: DataFrame, batch: DataFrame, *, keys: Sequence[str], version: Sequence[str]) -> DataFrame:
    """Store and batch merged; of rows with one key the greatest version survives."""
    return keep_last(store.unionByName(batch, allowMissingColumns=True), keys=keys, priority=version)


def insert_report(store: DataFrame, batch: DataFrame, **kw: object) -> DataFrame:
    """Rows fetched and rows really inserted, as one row."""
    new = insert_absent(store, batch, **kw).agg(F.count("*").alias("n")).select(F.lit("inserted").alias("what"), "n")
    seen = batch.agg(F.count("*").alias("n")).select(F.lit("fetched").alias("what"), "n")
    return seen.unionByName(new).groupBy().agg(
        F.sum(F.when(F.col("what") == "fetched", F.col("n"))).alias("fetched"),
        F.sum(F.when(F.col("what") == "inserted", F.col("n"))).alias("inserted"),
    )


def merge_forecast(archive: DataFrame, forecast: DataFrame, *, keys: Sequence[str]) -> DataFrame:
    """Archive and forecast rows in one frame; where both know a day the forecast wins."""
    both = archive.withColumn("_rank", F.lit(0)).unionByName(
        forecast.withColumn("_rank", F.lit(1)), allowMissingColumns=True
    )
    return keep_last(both, keys=keys, priority=["_rank"]).drop("_rank")


def by_source_priority(sources: Mapping[str, DataFrame], *, keys: Sequence[str], label: str = "source") -> DataFrame:
    """Per key the row of the first source (in mapping order) that has one."""
    tagged = [
        df.withColumn(label, F.lit(name)).withColumn("_rank", F.lit(rank))
        for rank, (name, df) in enumerate(sources.items())
    ]
    union = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)
    return keep_first(union, keys=keys, order=["_rank"]).drop("_rank")


def with_scenarios(
    history: DataFrame,
    scenarios: DataFrame,
    *,
    key: str,
    day: str = "day",
    scenario: str = "scenario_id",
    reach: int | None = None,
) -> DataFrame:
    """For every scenario the end of its series' history plus the scenario's own rows.

    The last ``reach`` stored days before a hypothetical row determine its features exactly; by
    default that is the longest look-back of all features, and less is refused.  Stored days and
    first scenario days of a series are numbered in one pass, so a scenario is joined to the
    ``reach`` days it needs by their numbers and never to the whole history.
    Scoring then picks rows by scenario and day, not by "last row".
    """
    needed = feature_reach()
    reach = needed if reach is None else reach
    if reach < needed:
        raise ValueError(f"features look back {needed} rows, reach is {reach}")
    first = scenarios.groupBy(key, scenario).agg(F.min(day).alias("_first"))
    by_day = Window.partitionBy(key).orderBy(day)
    numbered = history.where(F.col(day).isNotNull()).withColumn("_row", F.row_number().over(by_day))
    marks = first.select(key, F.col("_first").alias(day), F.lit(0).alias("_stored")).distinct()
    both = numbered.select(key, day, F.lit(1).alias("_stored")).unionByName(marks)
    # A mark stands before the stored row of its own day: only earlier days count.
    upto = Window.partitionBy(key).orderBy(day, "_stored").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = both.withColumn("_last", F.sum("_stored").over(upto)).where("_stored = 0 and _last > 0")
    wanted = first.join(placed.select(key, F.col(day).alias("_first"), "_last"), [key, "_first"])
    last = F.col("_last").cast("int")
    wanted = wanted.select(key, scenario, F.explode(F.sequence(F.greatest(last - (reach - 1), F.lit(1)), last)).alias("_row"))
    base = numbered.join(wanted, [key, "_row"]).select(*history.columns, scenario)
    return base.withColumn("is_scenario", F.lit(False)).unionByName(
        scenarios.withColumn("is_scenario", F.lit(True)), allowMissingColumns=True
    )
