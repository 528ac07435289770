"""Bring frames of different periods to one schema."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapfold.functions.text import column


def stamp(df: DataFrame, **values: int | str) -> DataFrame:
    """Add literal columns; whole numbers become ``int``."""
    return df.withColumns({name: F.lit(value) for name, value in values.items()})


def rename_present(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Rename the columns that exist."""
    return df.withColumnsRenamed(dict(mapping))


def rename_slots(
    df: DataFrame, old: str, new: str, slots: Iterable[int], **values: object
) -> DataFrame:
    """Rename a repeated column whose name carries a period.

    ``old`` and ``new`` are templates over ``{n}`` and the given ``values``,
    e.g. ``old="Player{n}{previous}ClubName", previous=2023``.
    """
    return rename_present(
        df, {old.format(n=n, **values): new.format(n=n, **values) for n in slots}
    )


def drop_present(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """Drop the columns that exist."""
    return df.drop(*names)


def ensure_columns(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Add every absent column as a typed NULL."""
    have = set(df.columns)
    return df.withColumns(
        {name: F.lit(None).cast(type) for name, type in types.items() if name not in have}
    )


def conform_union(frames: Sequence[DataFrame]) -> DataFrame:
    """UNION ALL by name; a column absent from a frame is NULL there."""
    return reduce(lambda left, right: left.unionByName(right, allowMissingColumns=True), frames)


def null_if_denied(df: DataFrame, name: str, denied: DataFrame) -> DataFrame:
    """NULL where the value occurs in the one-column frame ``denied``.

    For deny-lists too long for an expression.  The join strategy is left to
    the planner, which knows the size of the list.
    """
    listed = denied.toDF("_denied").distinct().withColumn("_listed", F.lit(True))
    return (
        df.join(listed, column(name) == F.col("_denied"), "left")
        .withColumn(name, F.when(F.col("_listed").isNull(), column(name)))
        .drop("_denied", "_listed")
    )
