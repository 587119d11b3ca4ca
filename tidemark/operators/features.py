"""Window features of daily series.

Every function adds columns over one and the same window (series key, time order), so a
chain of them needs a single shuffle and sort.  ``window`` is the plain ordered window;
frames are derived from it.  The rows variant counts rows; pass ``frame="days"`` with a window
ordered by the day number to count calendar days instead.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec, functions as F

from ..functions.calendar import with_calendar_features, with_cyclic_features
from ..schema import FEATURES
from .framing import rows_back, series_window

# Window sizes of the model features.
LAGS = (1, 3, 7, 14, 30)
MEANS = (3, 7, 14, 30)
TREND = 30
VOLATILITY = 7
DIFFERENCES = (1, 7)
SUMS = (7, 30)
WIND_MEAN = 7


def feature_reach() -> int:
    """Earlier rows that determine the features of a row: the longest of all lags and windows."""
    sizes = (*MEANS, TREND, VOLATILITY, *SUMS, WIND_MEAN)
    return max(*LAGS, *DIFFERENCES, *(n - 1 for n in sizes))


def frame_of(window: WindowSpec, size: int, frame: str = "rows") -> WindowSpec:
    if frame == "rows":
        return rows_back(window, size)
    if frame == "days":
        return window.rangeBetween(-(size - 1), Window.currentRow)
    raise ValueError("frame is 'rows' or 'days'")


def lags(value: str, window: WindowSpec, offsets: Sequence[int] = LAGS) -> dict[str, Column]:
    return {f"f_lag_{k}": F.lag(value, k).over(window) for k in offsets}


def moving_averages(value: str, window: WindowSpec, sizes: Sequence[int] = MEANS, frame: str = "rows") -> dict[str, Column]:
    """Means over the last n rows; shorter at the start of a series."""
    out = {}
    for n in sizes:
        span = frame_of(window, n, frame)
        out[f"f_ma_{n}"] = F.try_divide(
            F.sum(value).over(span).cast("double"), F.count(value).over(span).cast("double")
        )
    return out


def rolling_trend(value: str, position: str, window: WindowSpec, size: int = TREND, frame: str = "rows") -> dict[str, Column]:
    """Least-squares slope of the value on its position; a single row has slope 0."""
    span = frame_of(window, size, frame)
    slope = F.regr_slope(F.col(value).cast("double"), F.col(position).cast("double")).over(span)
    return {f"f_trend_{size}": F.coalesce(slope, F.lit(0.0))}


def rolling_volatility(value: str, window: WindowSpec, size: int = VOLATILITY, frame: str = "rows") -> dict[str, Column]:
    """Sample standard deviation; NULL while there is only one row."""
    span = frame_of(window, size, frame)
    return {f"f_volatility_{size}": F.stddev_samp(F.col(value).cast("double")).over(span)}


def differences(value: str, window: WindowSpec, offsets: Sequence[int] = DIFFERENCES) -> dict[str, Column]:
    return {f"f_diff_{k}": F.col(value) - F.lag(value, k).over(window) for k in offsets}


def rolling_sums(value: str, window: WindowSpec, sizes: Sequence[int] = SUMS, prefix: str = "f_sum") -> dict[str, Column]:
    """Sums over exactly n rows; NULL until n known values are available."""
    return {
        f"{prefix}_{n}": F.when(F.count(value).over(rows_back(window, n)) == n, F.sum(value).over(rows_back(window, n)))
        for n in sizes
    }


def rolling_means_full(columns: Sequence[str], window: WindowSpec, size: int = WIND_MEAN) -> dict[str, Column]:
    """Means over exactly n rows for each listed column."""
    span = rows_back(window, size)
    out = {}
    for c in columns:
        n = F.count(c).over(span)
        out[f"f_{c}_mean_{size}"] = F.when(n == size, F.sum(c).over(span).cast("double") / size)
    return out


def future_values(value: str, window: WindowSpec, horizons: Sequence[int], prefix: str = "y") -> dict[str, Column]:
    """Labels for direct forecasts: the value h rows ahead."""
    return {f"{prefix}_{h}": F.lead(value, h).over(window) for h in horizons}


def window_features(df: DataFrame, *, value: str, position: str, window: WindowSpec) -> DataFrame:
    """All value features over one given window (whole series or blocks)."""
    return df.withColumns(
        lags(value, window)
        | moving_averages(value, window)
        | rolling_trend(value, position, window)
        | rolling_volatility(value, window)
        | differences(value, window)
    )


def feature_matrix(
    df: DataFrame,
    *,
    key: str,
    day: str,
    value: str,
    rain: str | None = None,
    wind: Sequence[str] = (),
    horizon: int = 0,
    targets: Sequence[str] = (),
    complete: bool = True,
) -> DataFrame:
    """Calendar, cyclic and window features of daily series; incomplete rows are dropped.

    With ``horizon=0`` labels are the same day's measures, which the features of that day
    determine exactly (lag plus difference).  A forecasting model needs ``horizon >= 1``:
    every target then becomes its value that many days ahead.
    """
    window = series_window([key], day)
    out = df.withColumn("_row", F.row_number().over(window))
    out = window_features(out, value=value, position="_row", window=window)
    if rain:
        out = out.withColumns(rolling_sums(rain, window))
    if wind:
        out = out.withColumns(rolling_means_full(wind, window))
    labels = [f"{t}_ahead" for t in targets] if horizon else list(targets)
    if horizon:
        out = out.withColumns({f"{t}_ahead": F.lead(t, horizon).over(window) for t in targets})
    out = with_cyclic_features(with_calendar_features(out, day), day).drop("_row")
    return out.dropna(subset=[*FEATURES, *labels]) if complete else out


def last_rows(df: DataFrame, *, key: str, order: str, n: int) -> DataFrame:
    """The last ``n`` rows of every daily series."""
    newest = Window.partitionBy(key).orderBy(F.desc(order))
    return df.withColumn("_rank", F.row_number().over(newest)).where(F.col("_rank") <= n).drop("_rank")


def latest_row(df: DataFrame, *, key: str, order: Sequence[str]) -> DataFrame:
    """The newest row of every series: an aggregation, so raw readings are fine too."""
    from .clean import keep_last

    return keep_last(df, keys=[key], priority=order)


def observation_extras(
    df: DataFrame, *, key: str, day: str, pressure: str | None = None, humidity: str | None = None, wind: str | None = None
) -> DataFrame:
    """Weekend flag, day-to-day changes of pressure and humidity, wind category."""
    window = series_window([key], day)
    out = df.withColumn("is_weekend", F.dayofweek(day).isin(1, 7))
    for name, column in (("pressure_change", pressure), ("humidity_change", humidity)):
        if column:
            out = out.withColumn(name, F.col(column) - F.lag(column).over(window))
    if wind:
        w = F.col(wind)
        # Category limits are free choices: the documented feature gives none.
        out = out.withColumn(
            "wind_category", F.when(w < 10, "calm").when(w < 30, "breeze").when(w >= 30, "strong")
        )
    return out
