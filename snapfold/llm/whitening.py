"""Whitening of embeddings with MLlib block matrices.

Components become integers, so that sums, means and deviations are exact.  All
vectors are numbered and dealt to blocks of consecutive numbers; the fit list, one row of each
distinct vector, is marked in them.  Centred blocks form a distributed matrix:
its transpose times itself, over the fit list, is the scatter, whose eigenvectors the driver
finds (dimensions squared, however many rows), and all rows times the
whitening matrix, a block matrix as well, are the result.

A product with one block of output would send all blocks to one task, so its
inner dimension is cut into splits of ``INNER_BLOCKS`` blocks.  Blocks are handled in
panels of ``PANEL_BLOCKS``, which bounds the list of blocks that MLlib keeps on the
driver, and its row numbers.

Defined edge cases: a vector that is null, empty, of another length than most
(of two as frequent lengths the longer counts), or with a null, non-finite or out of range
(``MOST``) component is left out; a vector that occurs many times is fitted once and every
row of it projected; components without variance (eigenvalues that rounding cannot
tell from zero) are left out, so that equal vectors have none; null and repeated ids are
rows like any other; an empty table gives no rows; a deviation beyond 38 digits is null.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from functools import reduce
from operator import add
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.mllib.common import callMLlibFunc
from pyspark.mllib.linalg import Matrices, MatrixUDT
from pyspark.mllib.linalg.distributed import BlockMatrix
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from snapfold.llm.common import free_name, stage

#: Numbers in a block, which has the rows that makes.
BLOCK_CELLS = 1 << 16
#: Columns of a block.
BLOCK_COLUMNS = 1_024
#: Blocks of an inner dimension that one task multiplies.
INNER_BLOCKS = 16
#: Blocks of rows in a panel.
PANEL_BLOCKS = 1 << 17
#: Largest component that takes part.
MOST = float(1 << 40)
#: Bits of ``monotonically_increasing_id`` that number the rows of a partition.
ROW_BITS = 33
#: Below this a whole number takes part in 64-bit arithmetic.
LONG = 1 << 62

PLACE = StructType([StructField("row", LongType()), StructField("column", LongType())])
BLOCKS = StructType([StructField("place", PLACE), StructField("block", MatrixUDT())])


class Whitened(NamedTuple):
    """``rows`` with ``whitened`` and ``deviation``, and what was fitted."""

    rows: DataFrame
    fitted: int
    eigenvalues: list[float]
    explained: list[float]
    identity_error: float


class Centre(NamedTuple):
    """Number, sum and range of the vectors of the fit list, all exact."""

    fitted: int
    total: list[int]
    spread: int

    def deviations(self, x: np.ndarray) -> np.ndarray:
        """``n * x - S``, exact: in 64 bits where the result has room, whatever the products do on the way."""
        if self.fitted * self.spread < LONG:
            return x * np.int64(self.fitted) - np.array([s % (1 << 64) for s in self.total], dtype=np.uint64).view(np.int64)
        return x.astype(object) * self.fitted - np.array(self.total, dtype=object)

    def centred(self, x: np.ndarray) -> np.ndarray:
        """``x - S / n``, rounded once."""
        return (self.deviations(x) / self.fitted).astype(np.float64)

    def squares(self, x: np.ndarray) -> list[int]:
        """Sum of the squared deviations of every row, exact."""
        away = self.deviations(x)
        if (self.fitted * self.spread) ** 2 * x.shape[1] >= LONG:
            away = away.astype(object)
        return (away * away).sum(axis=1).tolist()


def usable(vector: Column) -> Column:
    """A non-empty vector of finite components in range."""
    wrong = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) > MOST))
    return (F.size(vector) > 0) & ~wrong


def whiten(
    vectors: DataFrame,
    embedding: str = "embedding",
    components: int = 16,
    scale: int = 64,
    shift: int = 1_000_000,
    block_cells: int = BLOCK_CELLS,
    panel_blocks: int = PANEL_BLOCKS,
) -> Whitened:
    """Project the vectors on the unit eigenvectors of their covariance, each over the root of its eigenvalue.

    ``rows`` has the other columns of the vectors that take part, ``whitened`` (a value for each component, by falling
    eigenvalue) and ``deviation``: the sum of squares of ``n * x - S``, n the number of distinct vectors and
    S their sum, exact (input columns of these names are replaced).
    """
    kept = [c for c in vectors.columns if c.lower() not in ("whitened", "deviation") and c != embedding]
    x, row, place = (free_name(vectors, n) for n in ("_x", "_row", "_place"))
    whole = F.transform(F.col(embedding), lambda c: F.floor(c.cast("double") * scale).cast("long") + shift)
    data = stage(
        vectors.where(usable(F.col(embedding))).select(*kept, whole.alias(x), F.monotonically_increasing_id().alias(row)), "whole-vectors"
    )
    widths = data.groupBy(F.size(x).alias("width")).count().orderBy(F.desc("count"), F.desc("width")).first()
    if widths is None:
        return Whitened(_without(data.select(*kept)), 0, [], [], 0.0)
    width = widths["width"]
    rows_each = max(1, block_cells // width)
    numbered = _numbered(data.where(F.size(x) == width), row, place)

    blocks = stage(_blocks(numbered.select(F.col(place).alias("place"), F.col(x).alias("x")), rows_each, width), "vector-blocks")
    blocks = blocks.withColumn("panel", F.expr(f"CAST(block div {panel_blocks} AS int)"))
    panels = {r["panel"]: r["n"] for r in blocks.groupBy("panel").agg(F.max(F.expr(f"block % {panel_blocks}") + 1).alias("n")).collect()}
    centre = _centre(blocks, width)

    def matrix(panel: int, fitted_only: bool) -> BlockMatrix:
        """The centred rows of a panel; places of no row, or of none that counts, hold zeros."""

        def dense(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for block, at, fit, whole in _each(batches):
                values = np.zeros((rows_each, width))
                found = centre.centred(whole.reshape(-1, width))
                chosen = fit if fitted_only else slice(None)
                values[at[chosen]] = found[chosen]
                yield _matrix_rows(block % panel_blocks, values)

        found = blocks.where(F.col("panel") == panel).select("block", "at", "fit", "x").mapInArrow(dense, BLOCKS)
        return _block_matrix(found, rows_each, min(width, BLOCK_COLUMNS), panels[panel] * rows_each, width)

    scatter = reduce(add, (_gram(matrix(p, True), panels[p]) for p in panels))
    covariance = (scatter + scatter.T) / (2 * centre.fitted)
    values, axes = np.linalg.eigh(covariance)
    least = max(float(values[-1]), 0.0) * width * 16 * np.finfo(float).eps
    top = [i for i in range(width - 1, -1, -1) if values[i] > least][:components]
    if not top:
        return Whitened(_without(numbered.select(*kept)), centre.fitted, [], [], 0.0)

    whitening = _local_matrix(numbered.sparkSession, axes[:, top] / np.sqrt(values[top]))
    parts = []
    for p in panels:
        with _held(matrix(p, False)) as rows:
            product = _matrix_blocks(rows.multiply(whitening)).withColumn("block", F.col("block") + p * panel_blocks)
            of_panel = blocks.where(F.col("panel") == p).select("panel", "block", "at", "fit")
            parts.append(stage(of_panel.join(product, "block"), "whitened-blocks"))
    projected = reduce(DataFrame.unionAll, parts)
    again = reduce(add, (_gram(_projected_fit(projected, p, rows_each, len(top), panels[p], panel_blocks), panels[p]) for p in panels))
    error = float(np.abs(again / centre.fitted - np.eye(len(top))).max())
    return Whitened(
        _joined(numbered, projected, kept, x, place, rows_each, centre),
        centre.fitted,
        [float(values[i]) for i in top],
        [float(values[i] / np.trace(covariance)) for i in top],
        error,
    )


def _without(rows: DataFrame) -> DataFrame:
    """Rows without a component or a deviation: those of equal vectors, or none."""
    return rows.withColumns({"whitened": F.array().cast("array<double>"), "deviation": F.lit(0).cast("decimal(38,0)")})


def _numbered(data: DataFrame, row: str, place: str) -> DataFrame:
    """Rows with a number each: that in their stored partition, after all partitions before it."""
    part, local = F.shiftright(F.col(row), ROW_BITS), F.col(row).bitwiseAND(F.lit((1 << ROW_BITS) - 1))
    before, offsets = 0, []
    # A row for each task that wrote the vectors.
    for r in data.groupBy(part.alias("part")).agg(F.max(local).alias("last")).orderBy("part").collect():
        offsets.append((r["part"], before))
        before += r["last"] + 1
    of, moved = free_name(data, "_part"), free_name(data, "_offset")
    known = data.sparkSession.createDataFrame(offsets, f"`{of}` long, `{moved}` long")
    return data.withColumn(of, part).join(F.broadcast(known), of).withColumn(place, F.col(moved) + local).drop(of, moved, row)


def _blocks(rows: DataFrame, rows_each: int, width: int) -> DataFrame:
    """A row for each block: its vectors one after the other, their places in it, and which are the first of their kind.

    Copies of a vector are never brought together: the first number of each distinct one joins the blocks.
    """
    block = F.expr(f"place div {rows_each}")
    firsts = rows.groupBy("x").agg(F.min("place").alias("place")).select("place", block.alias("block"))

    def together(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        places = left.column("place").to_numpy()
        order = np.argsort(places)
        x = left.column("x").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, width)[order]
        places = places[order]
        return pa.table(
            {
                "block": pa.array([key[0].as_py()], pa.int64()),
                "at": pa.array([places - key[0].as_py() * rows_each], pa.list_(pa.int64())),
                "fit": pa.array([np.isin(places, right.column("place").to_numpy())], pa.list_(pa.bool_())),
                "x": pa.array([x.reshape(-1)], pa.list_(pa.int64())),
            }
        )

    dealt = rows.withColumn("block", block).groupBy("block")
    return dealt.cogroup(firsts.groupBy("block")).applyInArrow(together, "block long, at array<long>, fit array<boolean>, x array<long>")


def _centre(blocks: DataFrame, width: int) -> Centre:
    """Sums over the fit list and ranges over all vectors; a row for each block and dimension is added up."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole, fit in _each(batches):
            x = whole.reshape(-1, width)
            sums, low, high = x[fit].sum(axis=0), x.min(axis=0), x.max(axis=0)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(width)), pa.array(sums), pa.array(low), pa.array(high), pa.array([int(fit.sum())] * width, pa.int64())],
                names=["d", "s", "low", "high", "n"],
            )

    parts = blocks.select("x", "fit").mapInArrow(partial, "d long, s long, low long, high long, n long")
    of = parts.groupBy("d").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s"), F.max("high").alias("high"), F.min("low").alias("low"), F.sum("n").alias("n"))
    found = of.orderBy("d").collect()
    return Centre(found[0]["n"], [int(r["s"]) for r in found], max(r["high"] - r["low"] for r in found))


def _each(batches: Iterator[pa.RecordBatch]) -> Iterator[list]:
    """The rows of batches: a number as it is, a list as an array without a copy of its values where there need be none."""
    for batch in batches:
        for i in range(batch.num_rows):
            cells = [column[i] for column in batch.columns]
            yield [c.values.to_numpy(zero_copy_only=False) if isinstance(c, pa.ListScalar) else c.as_py() for c in cells]


@contextmanager
def _held(matrix: BlockMatrix) -> Iterator[BlockMatrix]:
    """The matrix with its blocks held while it is used several times, in memory or on disk; lost ones are made again."""
    matrix.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield matrix
    finally:
        matrix._java_matrix_wrapper._java_model.blocks().unpersist(False)


def _matrix_rows(row: int, values: np.ndarray) -> pa.RecordBatch:
    """One block of rows as matrix blocks, one for each range of columns."""
    parts = [values[:, c : c + BLOCK_COLUMNS] for c in range(0, values.shape[1], BLOCK_COLUMNS)]
    n = len(parts)
    place = pa.StructArray.from_arrays([pa.array([row] * n, pa.int64()), pa.array(range(n), pa.int64())], names=["row", "column"])
    block = pa.StructArray.from_arrays(
        [
            pa.array([1] * n, pa.int8()),
            pa.array([p.shape[0] for p in parts], pa.int32()),
            pa.array([p.shape[1] for p in parts], pa.int32()),
            pa.nulls(n, pa.list_(pa.int32())),
            pa.nulls(n, pa.list_(pa.int32())),
            pa.array([p.reshape(-1, order="F") for p in parts], pa.list_(pa.float64())),
            pa.array([False] * n),
        ],
        names=["type", "numRows", "numCols", "colPtrs", "rowIndices", "values", "isTransposed"],
    )
    return pa.RecordBatch.from_arrays([place, block], names=BLOCKS.names)


def _block_matrix(blocks: DataFrame, rows_each: int, columns_each: int, rows: int, columns: int) -> BlockMatrix:
    return BlockMatrix(callMLlibFunc("createBlockMatrix", blocks, rows_each, columns_each, rows, columns), rows_each, columns_each)


def _local_matrix(spark: SparkSession, values: np.ndarray) -> BlockMatrix:
    """A small matrix in blocks that fit those of the rows on its left."""
    cut = range(0, len(values), BLOCK_COLUMNS)
    parts = [values[c : c + BLOCK_COLUMNS] for c in cut]
    blocks = [((i, 0), Matrices.dense(*p.shape, p.reshape(-1, order="F"))) for i, p in enumerate(parts)]
    return _block_matrix(spark.createDataFrame(blocks, BLOCKS), min(len(values), BLOCK_COLUMNS), values.shape[1], *values.shape)


def _gram(matrix: BlockMatrix, blocks: int) -> np.ndarray:
    """The transpose times the matrix, columns squared, from as many tasks as the blocks need."""
    splits = -(-blocks // INNER_BLOCKS)
    with _held(matrix):
        product = matrix.transpose()._java_matrix_wrapper.call("multiply", matrix._java_matrix_wrapper._java_model, splits)
        return BlockMatrix(product, matrix.colsPerBlock, matrix.colsPerBlock).toLocalMatrix().toArray()


def _matrix_blocks(product: BlockMatrix) -> DataFrame:
    """``block`` and ``y``, its rows one after the other, of a product with one block of columns."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            numbers = batch.column(0).field(0).to_pylist()
            of = {name: batch.column(1).field(name) for name in ("numRows", "numCols", "isTransposed", "values")}
            for i, number in enumerate(numbers):
                values = of["values"][i].values.to_numpy(zero_copy_only=False)
                shape = of["numRows"][i].as_py(), of["numCols"][i].as_py()
                y = values.reshape(shape, order="C" if of["isTransposed"][i].as_py() else "F")
                yield pa.RecordBatch.from_arrays([pa.array([number], pa.int64()), pa.array([y.reshape(-1)], pa.list_(pa.float64()))], names=["block", "y"])

    return callMLlibFunc("getMatrixBlocks", product._java_matrix_wrapper._java_model).mapInArrow(rows, "block long, y array<double>")


def _projected_fit(projected: DataFrame, panel: int, rows_each: int, width: int, n_blocks: int, panel_blocks: int) -> BlockMatrix:
    """The projected fit list of a panel as blocks; its columns have mean zero, as they come from centred rows."""

    def dense(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, at, fit, y in _each(batches):
            chosen = np.zeros(rows_each, dtype=bool)
            chosen[at[fit]] = True
            yield _matrix_rows(block % panel_blocks, np.where(chosen[:, None], y.reshape(rows_each, width), 0.0))

    found = projected.where(F.col("panel") == panel).select("block", "at", "fit", "y").mapInArrow(dense, BLOCKS)
    return _block_matrix(found, rows_each, width, n_blocks * rows_each, width)


def _joined(numbered: DataFrame, projected: DataFrame, kept: list[str], x: str, place: str, rows_each: int, centre: Centre) -> DataFrame:
    """The numbered rows with their projection and exact deviation."""

    def by_place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, at, y in _each(batches):
            found = y.reshape(rows_each, -1)[at]
            ends = pa.array(np.arange(len(at) + 1, dtype=np.int32) * found.shape[1], pa.int32())
            yield pa.RecordBatch.from_arrays([pa.array(at + block * rows_each), pa.ListArray.from_arrays(ends, pa.array(found.reshape(-1)))], names=["place", "y"])

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                whole = batch.column(x).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
                squares = pa.array([str(s) for s in centre.squares(whole)])
                yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in (*kept, place)], squares], names=[*kept, place, "deviation"])

    found = projected.select("block", "at", "y").mapInArrow(by_place, "place long, y array<double>")
    schema = numbered.select(*kept, place, F.lit(None).cast("string").alias("deviation")).schema
    measured = numbered.select(*kept, place, x).mapInArrow(measure, schema)
    return measured.join(found, F.col(place) == F.col("place")).select(
        *[F.col(f"`{c}`") for c in kept], F.col("y").alias("whitened"), F.col("deviation").try_cast("decimal(38,0)").alias("deviation")
    )
