"""Best-fit packing of token documents into sequences by the sum-of-squares rule.

Texts become pieces of at most ``length`` tokens; the pieces, without their
ids, are dealt over tasks by hash, each task getting enough of them that what
its last open bins waste does not count.  A task packs its pieces longest
first: a piece goes where the sum, over all residual gaps, of the squared
number of open bins with that gap becomes smallest; ties take the tightest gap.

Defined edge cases: a null or empty text is its end token; equal rows are
packed each; an empty table gives no pieces.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapfold.llm.common import ENCODE_BYTES, slices, stage
from snapfold.llm.tokens import library_encoder, with_end

PIECES = "doc_id {id}, piece int, start long, length long, ids_crc32 long"


def pieces(docs: DataFrame, tokenizer: str, end: int = 0, length: int = 2048, text: str = "text", id_column: str = "doc_id", with_ids: bool = False) -> DataFrame:
    """Pieces of each text; one longer than ``length`` is cut from its end, so that only its first piece may be shorter."""
    plain = docs.select(F.col(id_column).alias("doc_id"), F.col(text).alias("text"))
    schema = PIECES.format(id=plain.schema["doc_id"].dataType.simpleString()) + (", ids array<int>" if with_ids else "")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = library_encoder(tokenizer, True)
        for batch in slices(batches, "text", ENCODE_BYTES):
            ids, counts = with_end(*encoder(batch.column("text")), end)
            begins = np.cumsum(counts) - counts
            parts = -(-counts // length)
            row = np.repeat(np.arange(len(counts)), parts)
            piece = np.arange(len(row)) - np.repeat(np.cumsum(parts) - parts, parts)
            short = counts - (parts - 1) * length
            start = np.where(piece == 0, 0, short[row] + (piece - 1) * length)
            size = np.where(piece == 0, short[row], length)
            raw = memoryview(ids.astype("<u4").tobytes())
            at = begins[row] + start
            crcs = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(at.tolist(), (at + size).tolist())]
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            columns = [batch.column("doc_id").take(pa.array(row)), pa.array(piece, pa.int32()), pa.array(start), pa.array(size), pa.array(crcs, pa.int64())]
            if with_ids:
                columns.append(pa.array([ids[a : a + b].astype(np.int32) for a, b in zip(at.tolist(), size.tolist())], pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return plain.mapInArrow(run, schema)


class OpenBins:
    """Bins with room left, by residual gap."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.count = np.zeros(capacity + 1, dtype=np.int64)
        self.bins: list[list[int]] = [[] for _ in range(capacity + 1)]
        self.opened = 0

    def place(self, size: int) -> tuple[int, int]:
        """Bin number and offset for a piece of ``size``."""
        count, capacity = self.count, self.capacity
        # Moving a bin from gap g to g - size changes the sum by 2 (count[g - size] - count[g] + 1);
        # closing it (gap 0) or opening one (from the full capacity) leaves one of the terms out.
        gaps = size + np.flatnonzero(count[size:capacity])
        gap = capacity
        least = 2 * count[capacity - size] + 1 if size < capacity else 0
        if len(gaps):
            change = 2 * (count[gaps - size] - count[gaps] + 1)
            if gaps[0] == size:
                change[0] = 1 - 2 * count[size]
            best = int(change.argmin())
            if change[best] <= least:
                gap = int(gaps[best])
        if gap == capacity:
            number = self.opened
            self.opened += 1
        else:
            number = self.bins[gap].pop()
            count[gap] -= 1
        left = gap - size
        if left:
            self.bins[left].append(number)
            count[left] += 1
        return number, capacity - gap


def pack(pieces_: DataFrame, length: int = 2048, task_pieces: int = 100_000, size: str = "length") -> DataFrame:
    """``pieces_`` (a stored table) with ``sequence_id`` and ``offset`` appended.

    Every row is placed, and a task keeps only its open bins in memory.
    """
    tasks = max(1, -(-pieces_.count() // task_pieces))
    keys = [c for c in pieces_.columns if c != "ids"]
    dealt = pieces_.repartition(tasks, F.xxhash64(*keys)).sortWithinPartitions(F.desc(size), *keys)
    schema = pieces_.select("*", F.lit(0).cast("long").alias("sequence_id"), F.lit(0).cast("long").alias("offset")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bins = OpenBins(length)
        base = TaskContext.get().partitionId() << 40
        for batch in batches:
            placed = np.array([bins.place(s) for s in batch.column(size).to_pylist()], dtype=np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(placed[:, 0] + base), pa.array(placed[:, 1])], names=[*batch.schema.names, "sequence_id", "offset"]
            )

    return dealt.mapInArrow(run, schema)


def packed_documents(docs: DataFrame, tokenizer: str, end: int = 0, length: int = 2048, with_ids: bool = False, **columns) -> DataFrame:
    """Tokenize, cut and pack: a row per piece with its sequence and offset."""
    return pack(stage(pieces(docs, tokenizer, end, length, with_ids=with_ids, **columns), "token-pieces"), length)
