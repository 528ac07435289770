"""Tolerant typing: a cell that does not parse never fails the job."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapfold.functions.text import column


@dataclass(frozen=True)
class CastSpec:
    """How one text column becomes typed."""

    name: str
    type: str
    default: object = None
    formats: tuple[str, ...] = ()
    group_separator: str = ""


def safe_cast(
    col: Column | str,
    type: str,
    default: object = None,
    formats: Sequence[str] = (),
    group_separator: str = "",
) -> Column:
    """Cast, giving ``default`` (NULL unless set) where the text does not parse.

    ``formats`` are further date or timestamp patterns, tried in order after
    the ISO form.  ``group_separator`` characters (``","`` in ``1,234.5``) are
    removed before a numeric cast.
    """
    source = column(col) if isinstance(col, str) else col
    text = F.translate(source, group_separator, "") if group_separator else source
    candidates = [text.try_cast(type)]
    for pattern in formats:
        if type == "date":
            candidates.append(F.try_to_date(text, pattern))
        else:
            candidates.append(F.try_to_timestamp(text, F.lit(pattern)).try_cast(type))
    if default is not None:
        candidates.append(F.lit(default).cast(type))
    return F.coalesce(*candidates) if len(candidates) > 1 else candidates[0]


def cast_all(df: DataFrame, specs: Iterable[CastSpec]) -> DataFrame:
    """Apply every spec whose column exists, in one projection."""
    have = set(df.columns)
    return df.withColumns(
        {
            s.name: safe_cast(s.name, s.type, s.default, s.formats, s.group_separator)
            for s in specs
            if s.name in have
        }
    )
