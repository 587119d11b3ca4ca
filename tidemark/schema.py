"""Schemas, fixed column names and column-selection helpers."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, functions as F, types as T

# Daily measures of the observation table, in table order.
DAILY_MEASURES = [
    "temperature_2m_max",
    "temperature_2m_min",
    "temperature_2m_mean",
    "apparent_temperature_max",
    "apparent_temperature_min",
    "precipitation_sum",
    "rain_sum",
    "snowfall_sum",
    "precipitation_hours",
    "windspeed_10m_max",
    "windgusts_10m_max",
    "winddirection_10m_dominant",
    "shortwave_radiation_sum",
    "et0_fao_evapotranspiration",
    "weathercode",
    "humidity",
]

# Measures of the hourly payload.
HOURLY_MEASURES = [
    "temperature_2m",
    "apparent_temperature",
    "relative_humidity_2m",
    "precipitation",
    "rain",
    "snowfall",
    "weathercode",
    "windspeed_10m",
    "windgusts_10m",
    "winddirection_10m",
    "shortwave_radiation",
    "et0_fao_evapotranspiration",
]

# Prediction targets in order of preference.
TARGETS = ["temperature_2m_mean", "temperature_2m_min", "temperature_2m_max"]

# Name suffixes that mark a derived column, never a target.
DERIVED_MARKS = ["_lag_", "_ma_", "_trend", "_volatility", "_diff"]

# The model's feature vector, in vector order.
FEATURES = [
    "f_year", "f_month", "f_quarter", "f_day_of_year", "f_week_of_year",
    "f_month_sin", "f_month_cos", "f_day_of_year_sin", "f_day_of_year_cos",
    "f_lag_1", "f_lag_3", "f_lag_7", "f_lag_14", "f_lag_30",
    "f_ma_3", "f_ma_7", "f_ma_14", "f_ma_30",
    "f_trend_30", "f_volatility_7", "f_diff_1", "f_diff_7",
]

# Names a measure may carry in older files, preferred name first.
ALIASES = {
    "temperature_2m_max": ["temperature_2m_max (°C)", "temperature_2m_max"],
    "temperature_2m_min": ["temperature_2m_min (°C)", "temperature_2m_min"],
    "temperature_2m_mean": ["temperature_2m_mean (°C)", "temperature_2m_mean"],
    "apparent_temperature_max": ["apparent_temperature_max (°C)", "apparent_temperature_max"],
    "relative_humidity_2m": ["relative_humidity_2m (%)", "relative_humidity_2m"],
    "precipitation_sum": ["precipitation_sum (mm)", "precipitation_sum"],
    "windspeed_10m_max": ["windspeed_10m_max (km/h)", "windspeed_10m_max"],
    "shortwave_radiation_sum": ["shortwave_radiation_sum (MJ/m²)", "shortwave_radiation_sum"],
}

INTEGER_MEASURES = {"weathercode"}


def daily_schema() -> T.StructType:
    """The stored observation table: one row per (series_key, day)."""
    fields = [T.StructField("series_key", T.StringType(), False), T.StructField("day", T.DateType(), False)]
    for name in DAILY_MEASURES:
        kind = T.IntegerType() if name in INTEGER_MEASURES else T.DoubleType()
        fields.append(T.StructField(name, kind))
    for name in ("year", "month", "day_of_month", "day_of_year", "season"):
        fields.append(T.StructField(name, T.IntegerType()))
    fields.append(T.StructField("created_at", T.TimestampType()))
    return T.StructType(fields)


def payload_schema(section: str, measures: Sequence[str]) -> T.StructType:
    """``{section: {time: [...], measure: [...]}}`` as delivered by the collector."""
    arrays = [T.StructField("time", T.ArrayType(T.StringType()))]
    arrays += [T.StructField(m, T.ArrayType(T.DoubleType())) for m in measures]
    return T.StructType([T.StructField(section, T.StructType(arrays))])


def columns_named(df: DataFrame, needles: Iterable[str], without: Iterable[str] = ()) -> list[str]:
    """Columns whose name contains any needle (case-insensitive) and none of ``without``."""
    needles, without = [n.lower() for n in needles], [n.lower() for n in without]
    return [
        c
        for c in df.columns
        if any(n in c.lower() for n in needles) and not any(n in c.lower() for n in without)
    ]


def numeric_columns(df: DataFrame) -> list[str]:
    """Columns of a numeric type, in schema order."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def detect_targets(df: DataFrame) -> list[str]:
    """The listed targets that exist, else numeric temperature columns that are not derived."""
    listed = [t for t in TARGETS if t in df.columns]
    if listed:
        return listed
    numeric = set(numeric_columns(df))
    found = [c for c in columns_named(df, ["temp"], DERIVED_MARKS) if c in numeric]
    return list(dict.fromkeys(found))


def detect_measures(df: DataFrame) -> dict[str, object]:
    """Pick the feature sources by name: first temperature, first rain, first two wind columns."""
    temp, rain, wind = (
        columns_named(df, needles) for needles in (["temp"], ["precip", "rain"], ["wind"])
    )
    return {"value": temp[0] if temp else None, "rain": rain[0] if rain else None, "wind": wind[:2]}


def require_columns(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """Raise when prepared columns are missing; otherwise pass the frame through."""
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"prepare the data first; missing columns: {', '.join(missing)}")
    return df


def schema_differences(df: DataFrame, expected: T.StructType) -> list[str]:
    """Describe how the frame's schema departs from the expected one."""
    have = {f.name: f.dataType for f in df.schema.fields}
    problems = []
    for field in expected.fields:
        if field.name not in have:
            problems.append(f"missing column {field.name}")
        elif have[field.name] != field.dataType:
            problems.append(
                f"column {field.name} is {have[field.name].simpleString()},"
                f" expected {field.dataType.simpleString()}"
            )
    return problems


def nan_to_null(df: DataFrame) -> DataFrame:
    """Readers call this: a missing reading is NULL, never NaN."""
    floats = (T.DoubleType, T.FloatType)
    fixed = {
        f.name: F.when(~F.isnan(F.col(f"`{f.name}`")), F.col(f"`{f.name}`"))
        for f in df.schema.fields
        if isinstance(f.dataType, floats)
    }
    return df.withColumns(fixed) if fixed else df
