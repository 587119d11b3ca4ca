"""Calendar columns and cyclic encodings of a date or timestamp column."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def season(month: Column) -> Column:
    """Winter (December to February) is 1, then spring 2, summer 3, autumn 4."""
    return (F.floor((month % 12) / 3) + 1).cast("int")


def with_calendar_columns(df: DataFrame, ts: str) -> DataFrame:
    """Add year, month, day_of_month, day_of_year and season of ``ts``."""
    when = F.col(ts)
    return df.withColumns(
        {
            "year": F.year(when),
            "month": F.month(when),
            "day_of_month": F.dayofmonth(when),
            "day_of_year": F.dayofyear(when),
            "season": season(F.month(when)),
        }
    )


def with_calendar_features(df: DataFrame, ts: str) -> DataFrame:
    """Add the calendar model features; the week is the ISO week."""
    when = F.col(ts)
    return df.withColumns(
        {
            "f_year": F.year(when),
            "f_month": F.month(when),
            "f_day": F.dayofmonth(when),
            "f_day_of_year": F.dayofyear(when),
            "f_week_of_year": F.weekofyear(when),
            "f_quarter": F.quarter(when),
        }
    )


def with_cyclic_features(df: DataFrame, ts: str) -> DataFrame:
    """Add sine and cosine of the month (period 12) and day of year (period 365, leap years too)."""

    def angle(part: Column, period: int) -> Column:
        return part * (2 * F.pi() / period)

    month, day = angle(F.month(ts), 12), angle(F.dayofyear(ts), 365)
    return df.withColumns(
        {
            "f_month_sin": F.sin(month),
            "f_month_cos": F.cos(month),
            "f_day_of_year_sin": F.sin(day),
            "f_day_of_year_cos": F.cos(day),
        }
    )
