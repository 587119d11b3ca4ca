"""Exact quantiles and modes per group, at daily and at raw grain."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..session import durable
from .framing import running_totals

VALUE = "_value"
COLUMN = "column"


def to_long(df: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """One row per (keys, column name, non-missing value)."""
    picked = df.select(*keys, *[F.col(f"`{c}`").cast("double").alias(c) for c in columns])
    return picked.unpivot(list(keys), list(columns), COLUMN, VALUE).where(F.col(VALUE).isNotNull())


def daily_quantiles(df: DataFrame, keys: Sequence[str], columns: Sequence[str], probs: Sequence[float]) -> DataFrame:
    """Linear-interpolated quantiles of daily columns: one aggregation for all columns.

    ``percentile`` keeps one counter per distinct value; at daily grain a group has at most
    one value per calendar day, so that state is small.  Use ``raw_quantiles`` otherwise.
    """
    asked = F.array(*[F.lit(p) for p in probs])
    wide = df.groupBy(*keys).agg(*[F.percentile(F.col(c).cast("double"), asked).alias(c) for c in columns])
    return wide.unpivot(list(keys), list(columns), COLUMN, "quantiles")


def raw_quantiles(
    df: DataFrame, keys: Sequence[str], columns: Sequence[str], probs: Sequence[float], accuracy: int = 10_000
) -> DataFrame:
    """The same quantiles for raw readings, exact for groups of any size.

    A first pass sketches, per group, values enclosing each quantile.  The second pass counts:
    readings inside an enclosure by value, all others once per gap between enclosures, so only
    about ``10 / accuracy`` of the readings are shuffled.  The counts are then ranked with
    block-wise running totals; no task holds a whole group.
    """
    group = [*keys, COLUMN]
    long = to_long(df, keys, columns)
    # The sketch's rank error is at most n / accuracy.  Enclosures reach four times as far to
    # either side; groups in which that is only a few ranks are counted value by value.
    reach = 4.0 / accuracy
    edges = [min(max(p + side * reach, 0.0), 1.0) for p in probs for side in (-1, 1)]
    sketch = long.groupBy(*group).agg(
        F.percentile_approx(VALUE, edges, accuracy).alias("_edges"), F.count("*").alias("_all")
    )
    enclosed = long.join(durable(sketch), group)
    inside = F.col("_all") <= 4 * accuracy
    gap = F.lit(0)
    for i, p in enumerate(probs):
        # At the ends there is nothing beyond the quantile to leave out.
        low = F.lit(True) if p <= reach else F.col(VALUE) >= F.col("_edges")[2 * i]
        high = F.lit(True) if p >= 1 - reach else F.col(VALUE) <= F.col("_edges")[2 * i + 1]
        inside = inside | (low & high)
        gap = gap + (F.col(VALUE) > F.col("_edges")[2 * i + 1]).cast("int")
    # Enclosures overlap when quantiles are close, but a gap never contains an enclosed value,
    # so its smallest reading stands for its place in the order.
    counts = enclosed.groupBy(*group, "_all", F.when(inside, F.col(VALUE)).alias("_exact"), F.when(~inside, gap).alias("_gap")).agg(
        F.count("*").alias("_n"), F.min(VALUE).alias(VALUE)
    )
    ranked = running_totals(counts, group, [VALUE], {"_upto": F.col("_n")})

    def at_rank(rank: Column) -> Column:
        holds = (rank >= F.col("_upto") - F.col("_n")) & (rank < F.col("_upto"))
        return F.max(F.when(holds, F.col("_exact")))

    def found(value: str) -> Column:
        missed = F.raise_error(F.lit("a quantile fell outside its enclosure")).cast("double")
        return F.when(F.col(value).isNotNull(), F.col(value)).otherwise(missed)

    ends, quantiles = [], []
    for i, p in enumerate(probs):
        rank = (F.col("_all") - 1) * F.lit(float(p))
        ends += [
            at_rank(F.floor(rank)).alias(f"_lo{i}"),
            at_rank(F.ceil(rank)).alias(f"_hi{i}"),
            F.max(rank - F.floor(rank)).alias(f"_part{i}"),
        ]
        quantiles.append(found(f"_lo{i}") + (found(f"_hi{i}") - found(f"_lo{i}")) * F.col(f"_part{i}"))
    return ranked.groupBy(*group).agg(*ends).select(*group, F.array(*quantiles).alias("quantiles"))


def approximate_quantiles(
    df: DataFrame, keys: Sequence[str], columns: Sequence[str], probs: Sequence[float], accuracy: int = 10000
) -> DataFrame:
    """One-pass sketch: values that occur in the data, rank error at most rows / accuracy."""
    wide = df.groupBy(*keys).agg(
        *[F.percentile_approx(F.col(c).cast("double"), list(probs), accuracy).alias(c) for c in columns]
    )
    return wide.unpivot(list(keys), list(columns), COLUMN, "quantiles")


def modes(df: DataFrame, keys: Sequence[str], column: str, name: str) -> DataFrame:
    """The most frequent value per group, the smallest one on ties.

    Counted per (group, value) first, so the shuffle carries counts and no group's values are
    gathered in one place.
    """
    counts = df.where(F.col(column).isNotNull()).groupBy(*keys, column).agg(F.count("*").alias("_n"))
    best = F.min_by(column, F.struct(-F.col("_n"), F.col(column)))
    return counts.groupBy(*keys).agg(best.alias(name))
