"""Null policy: defaults, sentinels and flags."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapfold.functions.text import column


def fill_defaults(
    df: DataFrame, defaults: Mapping[str, object], empty_as_null: bool = False
) -> DataFrame:
    """Replace NULL by a per-column default; columns the frame lacks are skipped.

    Empty strings stay as they are unless ``empty_as_null`` is set.
    """

    def filled(name: str, default: object) -> Column:
        cell = F.nullif(column(name), F.lit("")) if empty_as_null else column(name)
        return F.coalesce(cell, F.lit(default))

    have = set(df.columns)
    return df.withColumns({n: filled(n, d) for n, d in defaults.items() if n in have})


def replace_sentinel(col: Column, sentinel: str, replacement: str | None) -> Column:
    """Swap one exact value; every other value, NULL included, is kept."""
    return F.when(col == sentinel, F.lit(replacement)).otherwise(col)


def null_if_listed(col: Column, denied: Iterable[str]) -> Column:
    """NULL where the value is on the deny-list; a None in the list denies nothing."""
    values = [v for v in denied if v is not None]
    return F.when(~col.isin(values), col) if values else col


def text_or(col: Column, placeholder: str) -> Column:
    """The text, or the placeholder where it is NULL or empty."""
    return F.coalesce(F.nullif(col, F.lit("")), F.lit(placeholder))


def zero_fill(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """NULL to 0.0 in the named columns."""
    have = set(df.columns)
    return df.withColumns({n: F.coalesce(column(n), F.lit(0.0)) for n in names if n in have})


def yes_no(col: Column) -> Column:
    """``Y``/``y`` is true; everything else, NULL included, is false."""
    return F.coalesce(F.upper(col) == "Y", F.lit(False))


def false_if_null(col: Column) -> Column:
    """NULL to false."""
    return F.coalesce(col, F.lit(False))
