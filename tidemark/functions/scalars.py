"""Small scalar functions shared by the operators."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F


def mean_of(column: Column | str) -> Column:
    """Mean as an exact sum over a count, so decimal inputs give an order-independent result."""
    return F.try_divide(F.sum(column).cast("double"), F.count(column).cast("double"))


def share(part: Column, whole: Column) -> Column:
    """part / whole as a double; NULL when the whole is zero."""
    return F.try_divide(part.cast("double"), whole.cast("double"))


def percent(part: Column, whole: Column) -> Column:
    return share(part, whole) * 100


def first_present(df: DataFrame, names: Sequence[str], default: object = None) -> Column:
    """The first of ``names`` that the frame has, with ``default`` for missing values.

    A name that exists wins even where its value is NULL: the value then becomes the default.
    """
    for name in names:
        if name in df.columns:
            column = F.col(f"`{name}`")
            return column if default is None else F.coalesce(column, F.lit(default))
    return F.lit(default)


def resolve_aliases(df: DataFrame, aliases: Mapping[str, Sequence[str]], default: float = 0.0) -> DataFrame:
    """Give every measure its canonical name, whichever of its names the file used."""
    resolved = [first_present(df, names, default).alias(target) for target, names in aliases.items()]
    used = {n for names in aliases.values() for n in names} | set(aliases)
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c not in used], *resolved)


def project_allow_list(df: DataFrame, allowed: Sequence[str]) -> DataFrame:
    """Keep the allowed columns the frame has, in the allow-list's order."""
    return df.select(*[F.col(f"`{c}`") for c in allowed if c in df.columns])


def clean_metric_name(name: Column) -> Column:
    """A tracking-safe metric name: no parentheses, spaces and slashes as underscores."""
    return F.translate(name, " /()", "__")


def parse_iso_timestamp(text: Column) -> Column:
    """ISO text to a timestamp; accepts a trailing Z and falls back to the plain date part."""
    return F.coalesce(
        F.try_to_timestamp(text),
        F.try_to_timestamp(F.substring(text, 1, 10), F.lit("yyyy-MM-dd")),
    )


def day_text(ts: Column) -> Column:
    """The first ten characters of a timestamp's text: yyyy-MM-dd."""
    return F.substring(ts.cast("string"), 1, 10)


def days_between(later: Column, earlier: Column) -> Column:
    return F.datediff(later, earlier)


def season_fallback(year: Column, month: Column) -> Column:
    """Forecast used when no model exists: a yearly sine around a slowly rising mean."""
    # Base, amplitude, yearly drift and the year the drift starts from.
    base, amplitude, drift, origin = 20.0, 5.0, 0.02, 2000
    return F.lit(base) + amplitude * F.sin(2 * F.pi() * month / 12) + drift * (year - origin)


def grade(r2: Column) -> Column:
    """Performance grade of an R2; none if it is unknown."""
    # Grade labels and their lower limits.
    return (
        F.when(r2.isNull() | F.isnan(r2), F.lit(None).cast("string"))
        .when(r2 >= 0.95, "A+ (Excellent)")
        .when(r2 >= 0.90, "A (Très bon)")
        .when(r2 >= 0.80, "B (Bon)")
        .when(r2 >= 0.70, "C (Acceptable)")
        .otherwise("D (Insuffisant)")
    )


def vector_values(values: Column, names: Sequence[str], default: float = 0.0) -> Column:
    """Ordered array of a name->value map; a missing name becomes ``default``."""
    return F.array(*[F.coalesce(F.try_element_at(values, F.lit(n)), F.lit(default)) for n in names])


def name_predictions(values: Column, names: Sequence[str] | None, width: int) -> Column:
    """Map target name -> predicted value; unnamed targets are target_0, target_1, ..."""
    labels = list(names) if names else [f"target_{i}" for i in range(width)]
    return F.map_from_arrays(F.array(*[F.lit(n) for n in labels]), values)
