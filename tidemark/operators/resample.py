"""From raw readings to one row per (series, day)."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from .framing import series_window

# Daily column -> (rule, hourly column) of the observation payload.
HOURLY_RULES = {
    "temperature_2m_max": ("max", "temperature_2m"),
    "temperature_2m_min": ("min", "temperature_2m"),
    "temperature_2m_mean": ("mean", "temperature_2m"),
    "apparent_temperature_max": ("max", "apparent_temperature"),
    "apparent_temperature_min": ("min", "apparent_temperature"),
    "relative_humidity_2m": ("mean", "relative_humidity_2m"),
    "precipitation_sum": ("sum", "precipitation"),
    "rain_sum": ("sum", "rain"),
    "snowfall_sum": ("sum", "snowfall"),
    "precipitation_hours": ("count_positive", "precipitation"),
    "windspeed_10m_max": ("max", "windspeed_10m"),
    "windgusts_10m_max": ("max", "windgusts_10m"),
    "winddirection_10m_dominant": ("mode_or_mean", "winddirection_10m"),
    "shortwave_radiation_sum": ("sum", "shortwave_radiation"),
    "et0_fao_evapotranspiration": ("sum", "et0_fao_evapotranspiration"),
    "weathercode": ("mode_or_first", "weathercode"),
}


# How partial results of a rule's pieces are computed and combined.
_PIECES = {
    "max": [("max", F.max, F.max)],
    "min": [("min", F.min, F.min)],
    "sum": [("sum", F.sum, F.sum)],
    "count": [("count", F.count, F.sum)],
    "mean": [("sum", F.sum, F.sum), ("count", F.count, F.sum)],
    "count_positive": [("positive", lambda c: F.count_if(F.col(c) > 0), F.sum)],
}


def _piece(kind: str, column: str) -> str:
    return f"_{kind}_{column}"


def _finish(rule: str, column: str) -> Column:
    if rule == "mean":
        total, n = F.col(_piece("sum", column)), F.col(_piece("count", column))
        return F.try_divide(total.cast("double"), n.cast("double"))
    if rule == "sum":  # a day without any reading adds up to zero
        return F.coalesce(_piece("sum", column), F.lit(0))
    return F.col(_piece(_PIECES[rule][0][0], column))


def daily_rollup(
    df: DataFrame,
    *,
    key: str,
    ts: str,
    rules: Mapping[str, tuple[str, str]],
    day: str = "day",
) -> DataFrame:
    """Aggregate readings to one row per (series, day), reading them once.

    ``mode`` columns are counted per value with grouping sets in the same pass, so that no
    aggregation state grows with the number of distinct values; partial results are combined
    before each shuffle, so a hot series or day costs no more than any other.  A day without
    readings of a column has no mode, nor the mean or first value a mode falls back to.
    """
    modes = [c for rule, c in rules.values() if rule.startswith("mode")]
    plain = {
        _piece(kind, column): (column, first, merge)
        for rule, column in rules.values()
        if not rule.startswith("mode")
        for kind, first, merge in _PIECES[rule]
    }
    dated = df.withColumn(day, F.to_date(ts))
    partial = [first(column).alias(n) for n, (column, first, _) in plain.items()]
    if not modes:
        rolled = dated.groupBy(key, day).agg(F.count("*").alias("_n"), *partial)
    else:
        per_value = dated.groupingSets([[key, day, c] for c in modes], key, day, *modes).agg(
            F.count("*").alias("_n"), *[F.grouping(c).alias(f"_not_{c}") for c in modes], *partial
        )
        # Every grouping set holds all rows: the plain pieces are taken from the first one.
        counted = F.col(f"_not_{modes[0]}") == 0
        merged = [merge(F.when(counted, F.col(n))).alias(n) for n, (_, _, merge) in plain.items()]
        tops = []
        for c in modes:
            known = (F.col(f"_not_{c}") == 0) & F.col(c).isNotNull()
            tops.append(F.min_by(c, F.when(known, F.struct(-F.col("_n"), F.col(c)))).alias(f"_mode_{c}"))
        rolled = per_value.groupBy(key, day).agg(*merged, *tops)
    finished = [
        (F.col(f"_mode_{column}") if rule.startswith("mode") else _finish(rule, column)).alias(name)
        for name, (rule, column) in rules.items()
    ]
    return rolled.select(key, day, *finished)


def densify_daily(df: DataFrame, *, key: str, day: str = "day") -> DataFrame:
    """Add the missing days between each series' first and last day, with NULL measures.

    Each row brings the days up to its successor, so neither a join nor a second look at
    the source is needed.
    """
    successor = F.lead(day).over(series_window([key], day))
    until = F.greatest(F.coalesce(F.date_sub(successor, 1), F.col(day)), F.col(day))
    spread = df.withColumn("_until", until).withColumn(
        "_day", F.explode(F.sequence(F.col(day), F.col("_until"), F.expr("interval 1 day")))
    )
    measures = [c for c in df.columns if c not in (key, day)]
    real = F.col("_day") == F.col(day)
    return spread.select(key, F.col("_day").alias(day), *[F.when(real, F.col(c)).alias(c) for c in measures])
