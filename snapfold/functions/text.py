"""String helpers."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: the code points that text cleaning removes.
CONTROL_CHARACTERS = r"[\x00-\x1F]"


def column(name: str) -> Column:
    """A column by its exact name, whatever blanks, dots or back-ticks it holds."""
    return F.col("`" + name.replace("`", "``") + "`")


def text_clean(col: Column) -> Column:
    """Delete the control characters U+0000 to U+001F."""
    return F.regexp_replace(col, CONTROL_CHARACTERS, "")


def clean_columns(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """``text_clean`` on every named column the frame has."""
    have = set(df.columns)
    return df.withColumns({n: text_clean(column(n)) for n in names if n in have})


def split_first(col: Column, separator: str) -> Column:
    """Text before the first separator, or the whole text without one."""
    return F.substring_index(col, separator, 1)


def split_last(col: Column, separator: str) -> Column:
    """Text after the last separator, or the whole text without one."""
    return F.substring_index(col, separator, -1)


def has_text(col: Column) -> Column:
    """True where the cell is neither NULL nor empty."""
    return col.isNotNull() & (col != "")
