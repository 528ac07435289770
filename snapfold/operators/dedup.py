"""One row per key, and always the same one."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from snapfold.functions.text import column


def _newest_first(item: Column | str) -> Column:
    return (column(item) if isinstance(item, str) else item).desc_nulls_last()


def latest_by_key(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column | str],
    tie_break: Sequence[Column | str],
) -> DataFrame:
    """The newest row of every key; unknown times sort last.

    ``tie_break`` decides between equally new rows and must not be empty.  The
    rank filter is pushed below the shuffle, so each task sends at most one row
    per key and a hot key costs no more than a rare one.
    """
    if not tie_break:
        raise ValueError("latest_by_key needs tie-break columns to be deterministic")
    newest = Window.partitionBy(*[column(k) for k in keys]).orderBy(
        *[_newest_first(o) for o in (*order, *tie_break)]
    )
    return (
        df.withColumn("_rank", F.row_number().over(newest)).filter("_rank = 1").drop("_rank")
    )


def latest_snapshot_rows(df: DataFrame, keys: Sequence[str], snapshot: str) -> DataFrame:
    """All rows of each key's newest snapshot, however many it holds there.

    The newest snapshot per key comes from a partially aggregated maximum, and
    the join back can be split by AQE where one key is hot.
    """
    newest = df.groupBy(*[column(k).alias(f"_k{i}") for i, k in enumerate(keys)]).agg(
        F.max(column(snapshot)).alias("_newest")
    )
    same_key = [column(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)]
    return df.join(
        newest, [*same_key, column(snapshot).eqNullSafe(F.col("_newest"))], "left_semi"
    )


def distinct_by(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The distinct key values, projected to the keys so no survivor is arbitrary."""
    return df.select(*[column(k) for k in keys]).distinct()
