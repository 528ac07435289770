"""Newest row per key as a streaming aggregate."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from snapfold.functions.text import column
from snapfold.operators.dedup import latest_by_key
from snapfold.sources.keyed import KeyedTable


def latest_state(stream: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The row with the greatest ``order`` columns for every key.

    Partial aggregation keeps one candidate per key and task ahead of the
    shuffle; the state store then holds one row per key.  ``order`` must make
    rows of one key distinguishable.
    """
    rest = [c for c in stream.columns if c not in keys]
    newest = F.max_by(
        F.struct(*[column(c) for c in rest]), F.struct(*[column(o) for o in order])
    )
    return (
        stream.groupBy(*[column(k) for k in keys])
        .agg(newest.alias("_row"))
        .select(*[column(k) for k in keys], "_row.*")
    )


def write_latest(
    stream: DataFrame, keys: Sequence[str], order: Sequence[str], target: str, checkpoint: str
) -> StreamingQuery:
    """Keep ``target`` at the newest row per key, for all input present now.

    The result is replaced as a whole, which suits key sets that fit one table
    refresh; for open-ended key sets dedupe the ingested table in batch.
    """

    def replace(result: DataFrame, batch: int) -> None:
        result.write.mode("overwrite").parquet(target)

    return (
        latest_state(stream, keys, order)
        .writeStream.outputMode("complete")
        .foreachBatch(replace)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def upsert_latest(
    stream: DataFrame, keys: Sequence[str], order: Sequence[str], table: KeyedTable, checkpoint: str
) -> StreamingQuery:
    """Keep ``table`` at the newest row per key, for all input present now.

    A micro-batch brings its own rows only and rewrites the buckets they are in; the table itself is
    the state, so none is kept besides.  A batch that is repeated after a failure changes nothing.
    """

    def merge(rows: DataFrame, batch: int) -> None:
        if rows.isEmpty():
            return
        newest = latest_by_key(rows, list(keys), list(order), list(keys))
        table.upsert(newest, list(order), list(keys))

    return (
        stream.writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
