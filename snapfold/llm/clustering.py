"""Centroid clustering of integer vectors by scalar lookup tables.

Components become integers, ``floor(scale * x)``.  The first centroids are the vectors
with the smallest hashes of their ids.  In a round, every task tabulates for
one dimension at a time the squared differences of the integer values that occur
in its block to that dimension of every centroid; the distances of the block's
vectors are gathered from the tables by value and summed over the dimensions.  All arithmetic
is on whole numbers, so neither the order of rows nor that of tasks matters.

A task hands on one sum and count for each centroid; those of all tasks are added
by Spark, and the driver holds the centroids alone.  Vectors stay where they were staged.

Defined edge cases: a vector that is null, has another number of components, or a null,
non-finite or out of range (``MOST``) one, is left out; equal distances go to the
smaller number, so of equal centroids the later ones stay empty and as they are;
a null id is never drawn ahead of another; repeated rows are rows like any other; with fewer
vectors than centroids, all vectors are centroids; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapfold.llm.common import free_name, null, stage

#: Largest integer component: squared differences of up to 64 dimensions then sum to less than 2 ** 63.
MOST = 1 << 27
#: Vectors whose distances are held at once.
BLOCK_ROWS = 8_192


class Clusters(NamedTuple):
    """``rows`` of the clustered vectors, with ``cluster`` and ``distance``, and ``centroids``, a row for each."""

    rows: DataFrame
    centroids: DataFrame


def lookup(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The integers that occur, ascending, and the place of every value among them."""
    low = int(values.min())
    span = int(values.max()) - low + 1
    if span > 4 * len(values) + 1024:
        return np.unique(values, return_inverse=True)
    seen = np.zeros(span, dtype=bool)
    seen[values - low] = True
    return np.flatnonzero(seen) + low, (np.cumsum(seen) - 1)[values - low]


def distances(block: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Squared distance of every row of ``block`` to every centroid."""
    out = np.zeros((len(block), len(centroids)), dtype=np.int64)
    for d in range(block.shape[1] if len(block) else 0):
        occurring, place = lookup(block[:, d])
        table = (occurring[:, None] - centroids[None, :, d]) ** 2
        out += table[place]
    return out


def nearest(block: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of the nearest centroid, the smaller one of equals, and the squared distance to it."""
    every = distances(block, centroids)
    cluster = every.argmin(axis=1)
    return cluster, every[np.arange(len(block)), cluster]


def _blocks(batches: Iterator[pa.RecordBatch], column: str, width: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for batch in batches:
        for start in range(0, batch.num_rows, BLOCK_ROWS):
            part = batch.slice(start, BLOCK_ROWS)
            yield part, part.column(column).flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, width)


def scaled(vector: Column, scale: int, width: int) -> Column:
    """The vector as integers; NULL where it is left out."""
    numbers = F.transform(vector, lambda x: F.floor(x.cast("double") * scale))
    usable = (F.size(vector) == width) & ~F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) * scale > MOST))
    return F.when(usable, numbers.cast("array<long>"))


def cluster(
    vectors: DataFrame,
    embedding: str = "embedding",
    id_column: str = "vec_id",
    width: int = 64,
    scale: int = 256,
    count: int = 40,
    rounds: int = 5,
    salt: str = "2:",
) -> Clusters:
    """Lloyd's rounds over all vectors of ``width`` components; the centroids start as those with the smallest SHA-256 of salt and id.

    ``rows`` has the other columns of the vectors that take part, ``cluster`` and ``distance``
    (input columns of these names are replaced); ``centroids`` has ``cluster``, ``centroid``
    (whole numbers), its ``vectors`` and their summed distance, ``inertia``.
    """
    spark = vectors.sparkSession
    kept = [c for c in vectors.columns if c.lower() not in ("cluster", "distance") and c != embedding]
    whole = free_name(vectors, "_whole")
    data = stage(vectors.select(*kept, scaled(F.col(embedding), scale, width).alias(whole)).where(F.col(whole).isNotNull()), "whole-vectors")
    # At most ``count`` vectors, the smallest of each task first.
    drawn = data.select(F.sha2(F.concat(F.lit(salt), F.col(id_column).cast("string")).cast("binary"), 256).alias("h"), whole)
    first = drawn.orderBy(F.asc_nulls_last("h"), whole).limit(count).collect()
    centroids = np.array([r[whole] for r in first], dtype=np.int64).reshape(-1, width)

    if len(centroids):
        for _ in range(rounds):
            centroids = _moved(data.select(whole), whole, centroids)
    rows_schema = data.drop(whole).select("*", null("int").alias("cluster"), null("long").alias("distance")).schema

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, block in _blocks(batches, whole, width):
            number, distance = nearest(block, centroids)
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in kept], pa.array(number.astype(np.int32)), pa.array(distance)], names=rows_schema.names
            )

    rows = stage(data.select(*kept, whole).mapInArrow(assign, rows_schema), "clustered-vectors")
    known = spark.createDataFrame([(i, c) for i, c in enumerate(centroids.tolist())], "cluster int, centroid array<long>")
    held = rows.groupBy("cluster").agg(F.count("*").alias("vectors"), F.sum(F.col("distance").cast("decimal(20,0)")).alias("inertia"))
    return Clusters(
        rows,
        known.join(held, "cluster", "left").select(
            "cluster", "centroid", F.coalesce("vectors", F.lit(0)).alias("vectors"), F.coalesce("inertia", F.lit(0)).alias("inertia")
        ),
    )


def _moved(data: DataFrame, whole: str, centroids: np.ndarray) -> np.ndarray:
    """Each centroid at the floor of the mean of its vectors; one without vectors where it was."""
    count, width = centroids.shape

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, members = np.zeros((count, width), dtype=np.int64), np.zeros(count, dtype=np.int64)
        for _, block in _blocks(batches, whole, width):
            number, _ = nearest(block, centroids)
            order = np.argsort(number, kind="stable")
            held = np.bincount(number, minlength=count)
            at = np.flatnonzero(held)
            total[at] += np.add.reduceat(block[order], (np.cumsum(held) - held)[at], axis=0)
            members += held
        at = np.flatnonzero(members)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(members[at]), pa.array(list(total[at]), pa.list_(pa.int64()))], names=["cluster", "n", "total"])

    # A row for each task and centroid, added up by dimension: count x width numbers reach the driver.
    parts = data.mapInArrow(sums, "cluster long, n long, total array<long>")
    by_dimension = parts.select("cluster", "n", F.posexplode("total").alias("d", "x")).groupBy("cluster", "d")
    added = by_dimension.agg(F.sum(F.col("n").cast("decimal(20,0)")).alias("n"), F.sum(F.col("x").cast("decimal(20,0)")).alias("x"))
    moved = centroids.copy()
    for r in added.collect():
        moved[r["cluster"], r["d"]] = int(r["x"]) // int(r["n"])
    return moved


def centroid_digest(centroid: list[int]) -> str:
    """SHA-256 of the components as decimal numbers, joined by commas."""
    return hashlib.sha256(",".join(map(str, centroid)).encode()).hexdigest()
