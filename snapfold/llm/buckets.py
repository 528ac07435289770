"""Documents in buckets of bounded size, so that a task can hold one bucket and what belongs to it."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BUCKET_BYTES = 3 << 20
#: Values that are worked on at once where one step's output is the next one's input, to stay in the processor's cache.
BLOCK = 1 << 15


def bucket_count(docs: DataFrame, text: str, each: int = BUCKET_BYTES, least: int = 1) -> int:
    """How many buckets there are with about ``each`` bytes of text to a bucket.

    Two for each shuffle partition, four at least, while that leaves ``least`` bytes to a bucket.
    """
    total = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    wanted = 2 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(-(-total // each), min(wanted, max(4, total // least)))


def bucketed(docs: DataFrame, text: str, name: str, each: int = BUCKET_BYTES, buckets: int | None = None) -> DataFrame:
    """``docs`` with a bucket number by a hash of all columns, about ``each`` bytes of text to a bucket.

    A text longer than that makes its bucket larger, as a text is never cut.
    """
    buckets = buckets or bucket_count(docs, text, each)
    # Map types have no hash, wherever they are in a column; their text has.
    keys = [F.to_json(F.struct(F.col(f"`{c}`"))) if "map<" in t else F.col(f"`{c}`") for c, t in docs.dtypes]
    return docs.withColumn(name, F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int"))


def in_order(bucket: pa.Table, id_column: str, text: str) -> pa.Table:
    """The bucket's documents by id, then text, null ids last: the same in every pass, equal rows aside."""
    order = pc.sort_indices(bucket, [(id_column, "ascending"), (text, "ascending")], null_placement="at_end")
    return bucket.take(order).combine_chunks()


def with_buckets(docs: DataFrame, other: DataFrame, name: str, function: Callable[[pa.Table, pa.Table], pa.Table], schema) -> DataFrame:
    """Apply ``function(documents, rows of other)`` to every bucket; ``other`` has no bucket without documents."""
    return docs.groupBy(name).cogroup(other.groupBy(name)).applyInArrow(lambda left, right: function(left, right), schema)


def runs(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and stops of the runs of True."""
    edges = np.diff(np.concatenate([[0], flags.astype(np.int8), [0]]))
    return np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)


def covered(size: int, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """True at places inside any of the intervals."""
    depth = np.zeros(size + 1, dtype=np.int64)
    np.add.at(depth, starts, 1)
    np.add.at(depth, stops, -1)
    return np.cumsum(depth[:-1]) > 0


def minimizers(hashes: np.ndarray, width: int, valid: np.ndarray) -> np.ndarray:
    """Sorted places that hold the smallest hash of a stretch ``i .. i + width - 1`` with ``valid[i]``; all places on a tie."""
    n = len(hashes) - width + 1
    if n <= 0 or not valid[:n].any():
        return np.zeros(0, np.int64)
    least = _extreme(hashes, width, np.minimum)
    # A place is one if the largest minimum among the stretches around it is its own hash.
    around = np.zeros(n + 2 * (width - 1), dtype=hashes.dtype)
    around[width - 1 : width - 1 + n] = np.where(valid[:n], least, 0)
    found = _extreme(around, width, np.maximum) == hashes
    near = covered(len(hashes), *(x + y for x, y in zip(runs(valid[:n]), (0, width - 1))))
    return np.flatnonzero(found & near)


def _extreme(values: np.ndarray, width: int, of) -> np.ndarray:
    """``of`` over every stretch of ``width`` values, by doubled stretches, the last with an overlap."""
    out = np.empty(len(values) - width + 1, dtype=values.dtype)
    for at in range(0, len(out), BLOCK):
        block, done = values[at : at + BLOCK + width - 1], 1
        while done < width:
            step = min(done, width - done)
            block, done = of(block[: len(block) - step], block[step:]), done + step
        out[at : at + BLOCK] = block
    return out
