"""Reading and writing a relational observation table over JDBC."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from ..operators.ingest import insert_absent


def read_table(
    spark: SparkSession,
    url: str,
    table: str,
    *,
    day: str,
    first: str,
    last: str,
    partitions: int,
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """Parallel scan: the date range is divided into ``partitions`` queries.

    ``first`` and ``last`` only shape the division, they do not filter rows.  Sorting is left
    to the consumers, which window or write in their own order.
    """
    return (
        spark.read.format("jdbc")
        .options(url=url, dbtable=table, partitionColumn=day, lowerBound=first, upperBound=last)
        .option("numPartitions", partitions)
        .options(**(options or {}))
        .load()
    )


def append_table(df: DataFrame, url: str, table: str, options: Mapping[str, str] | None = None) -> None:
    df.write.format("jdbc").options(url=url, dbtable=table, **(options or {})).mode("append").save()


def insert_absent_into(
    df: DataFrame, stored: DataFrame, url: str, table: str, *, keys: Sequence[str], day: str, **options: str
) -> None:
    """Append only rows whose key the table lacks."""
    append_table(insert_absent(stored, df, keys=keys, day=day), url, table, options)
