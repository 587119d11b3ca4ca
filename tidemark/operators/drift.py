"""Distribution drift between a baseline and a recent sample of each series.

Readings are counted per distinct value (or bin) before any ordering happens, and cumulative
distributions come from block-wise running totals, so a hot series is spread over many tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..session import durable
from .framing import running_totals
from .quantiles import raw_quantiles

# Drift limits per statistic and the sample rules.
THRESHOLDS = {
    "kolmogorov_smirnov": 0.15,
    "chi_square": 0.05,
    "wasserstein": 0.2,
    "psi": 0.1,
    "js_divergence": 0.15,
}
WINDOW_DAYS = 30
MIN_SAMPLES = 100
OVERALL_THRESHOLD = 0.3

# Stands in for an empty bin, so that its logarithm exists.
EPSILON = 1e-4


def label_samples(df: DataFrame, *, key: str, day: str, window_days: int = WINDOW_DAYS) -> DataFrame:
    """Mark the last ``window_days`` days of each series as recent, the rest as baseline.

    The newest day per series is stored first, so that its join is planned by its real size.
    """
    newest = durable(df.groupBy(key).agg(F.max(F.to_date(day)).alias("_newest")))
    recent = F.datediff(F.col("_newest"), F.to_date(day)) < window_days
    return df.join(newest, key).withColumn("is_recent", recent).drop("_newest")


def _sides(recent: str) -> list[Column]:
    return [
        F.count_if(~F.col(recent)).alias("n_base"),
        F.count_if(F.col(recent)).alias("n_recent"),
    ]


def binned_counts(df: DataFrame, *, key: str, value: str, recent: str, bins: int = 10) -> DataFrame:
    """Baseline and recent counts per baseline-quantile bin; empty bins are included."""
    probs = [i / bins for i in range(1, bins)]
    quantiles = raw_quantiles(df.where(~F.col(recent)), [key], [value], probs)
    edges = durable(quantiles.select(key, F.col("quantiles").alias("_edges")))
    inner = F.lit(0)
    for i in range(bins - 1):
        inner = inner + (F.col(value) > F.col("_edges")[i]).cast("int")
    counts = (
        df.where(F.col(value).isNotNull()).join(edges, key).groupBy(key, inner.alias("bin")).agg(*_sides(recent))
    )
    grid = edges.select(key, F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    return grid.join(counts, [key, "bin"], "left").fillna(0, ["n_base", "n_recent"])


def _shares(counts: DataFrame, key: str) -> DataFrame:
    """Bin shares of both samples; bins per series are few, so their totals are a small window."""
    from pyspark.sql import Window

    peers = Window.partitionBy(key)
    return counts.withColumns(
        {
            "p": F.try_divide(F.col("n_base").cast("double"), F.sum("n_base").over(peers)),
            "q": F.try_divide(F.col("n_recent").cast("double"), F.sum("n_recent").over(peers)),
        }
    )


def psi(counts: DataFrame, *, key: str) -> DataFrame:
    """Population Stability Index over binned counts."""
    p, q = F.greatest("p", F.lit(EPSILON)), F.greatest("q", F.lit(EPSILON))
    return _shares(counts, key).groupBy(key).agg(
        F.sum((q - p) * F.ln(q / p)).alias("psi"),
        F.sum("n_base").alias("n_base"),
        F.sum("n_recent").alias("n_recent"),
    )


def js_divergence(counts: DataFrame, *, key: str) -> DataFrame:
    """Jensen-Shannon divergence (base 2, between 0 and 1) over binned counts."""
    mix = (F.col("p") + F.col("q")) / 2

    def against_mix(c: str) -> Column:
        return F.when(F.col(c) > 0, F.col(c) * F.log2(F.col(c) / F.nullif(mix, F.lit(0.0)))).otherwise(0.0)

    return _shares(counts, key).groupBy(key).agg(
        (F.sum(against_mix("p") + against_mix("q")) / 2).alias("js_divergence"),
        F.sum("n_base").alias("n_base"),
        F.sum("n_recent").alias("n_recent"),
    )


def chi_square(df: DataFrame, *, key: str, category: str, recent: str) -> DataFrame:
    """Chi-square statistic of category counts against the baseline's shares.

    Categories the baseline lacks have no expectation; they are counted separately.
    """
    counts = df.groupBy(key, category).agg(*_sides(recent))
    totals = counts.groupBy(key).agg(F.sum("n_base").alias("_base"), F.sum("n_recent").alias("_recent"))
    joined = counts.join(totals, key)
    expected = F.col("n_base") * F.col("_recent") / F.nullif("_base", F.lit(0))
    gap = F.col("n_recent") - expected
    return joined.groupBy(key).agg(
        F.sum(F.when(expected > 0, gap * gap / F.nullif(expected, F.lit(0.0)))).alias("chi_square"),
        (F.count_if(F.col("n_base") > 0) - 1).alias("degrees"),
        F.count_if(F.col("n_base") == 0).alias("new_categories"),
    )


def cumulative_shares(df: DataFrame, *, key: str, value: str, recent: str) -> DataFrame:
    """Both empirical distribution functions at every distinct value, the next value and the sample sizes."""
    counts = df.where(F.col(value).isNotNull()).groupBy(key, value).agg(*_sides(recent))
    steps = running_totals(
        counts,
        [key],
        [value],
        {"_base": F.col("n_base"), "_recent": F.col("n_recent")},
        overall={"_base": "_all_base", "_recent": "_all_recent"},
        following={"next_value": F.col(value)},
    )
    return steps.select(
        key,
        value,
        "next_value",
        F.try_divide(F.col("_base").cast("double"), F.col("_all_base")).alias("base_share"),
        F.try_divide(F.col("_recent").cast("double"), F.col("_all_recent")).alias("recent_share"),
        F.col("_all_base").alias("n_base"),
        F.col("_all_recent").alias("n_recent"),
    )


def _sizes() -> list[Column]:
    return [F.max(n).alias(n) for n in ("n_base", "n_recent")]


def kolmogorov_smirnov(shares: DataFrame, *, key: str) -> DataFrame:
    """Largest distance of the two distribution functions."""
    gap = F.abs(F.col("base_share") - F.col("recent_share"))
    return shares.groupBy(key).agg(F.max(gap).alias("ks"), *_sizes())


def wasserstein(shares: DataFrame, *, key: str, value: str) -> DataFrame:
    """Area between the two distribution functions."""
    gap = F.abs(F.col("base_share") - F.col("recent_share")) * (F.col("next_value") - F.col(value))
    return shares.groupBy(key).agg(F.sum(gap).alias("wasserstein"), *_sizes())


def drift_verdict(
    scored: DataFrame, statistic: str, *, threshold: float, enough: Sequence[str] = ("n_base", "n_recent")
) -> DataFrame:
    """Flag drift above the threshold; with too few samples on either side there is no verdict."""
    verdict = F.col(statistic) > threshold
    for n in enough:
        verdict = F.when(F.col(n) >= MIN_SAMPLES, verdict)
    return scored.withColumn("drifted", verdict)


def overall_drift(verdicts: DataFrame, *, key: str, drifted: str = "drifted", limit: float = OVERALL_THRESHOLD) -> DataFrame:
    """Share of a series' verdicts that report drift, and whether that is too many.

    ``verdicts`` has a row per (series, statistic); rows without a verdict do not count.
    """
    shares = verdicts.groupBy(key).agg(
        F.count(drifted).alias("n_verdicts"),
        F.try_divide(F.count_if(drifted).cast("double"), F.count(drifted).cast("double")).alias("drift_share"),
    )
    return shares.withColumn("overall_drift", F.coalesce(F.col("drift_share") > limit, F.lit(False)))
