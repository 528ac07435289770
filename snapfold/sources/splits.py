"""Large CSV files with line feeds inside quoted cells, read by many tasks.

Spark's line reader cuts a file anywhere and hands out whole lines.  Whether a line begins
inside a quoted cell follows from the number of quotes before it, odd or even, so:

1. the lines are read once and stored in chunks, a row for each, with the parity of their quotes;
2. running sums over the chunks of a file, read without their bytes, tell in which state each begins;
3. every chunk is cut into records from that state, as slices of its bytes;
4. a record that a chunk leaves open is joined with the heads of the chunks after it.

Records are then parsed by Spark's own CSV parser.  The chunks are stored because
a second scan of the files need not meet the same splits.  Every quote is checked to
open or close a cell, in both states at once; a file with a stray quote in the right state
is not told by parity, and is left to be read whole.

Rows keep their order: the offset of the split, then chunk and number of the record in it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from snapfold.session import scratch_dir

CHUNKS = "file long, block long, chunk long, odd boolean, stray boolean, stray_inside boolean, crlf boolean, bytes binary"
RECORDS = "file long, block long, seq long, part int, record binary"
#: A chunk holds so many bytes, or one line that is longer; what a task holds of a chunk is some ten times that.
CHUNK_BYTES = 1 << 20
#: Bits of ``seq`` that number the records of a chunk; the chunk is above them.
RECORD_BITS = 32
WHOLE, OPEN, HEAD = 0, 1, 2
#: States of so many chunks are sent to every task; beyond, chunks and states are shuffled.
MOST_STATES = 200_000


def file_id() -> Column:
    return F.xxhash64("_metadata.file_path")


def stored_chunks(spark: SparkSession, paths: Sequence[str], delimiter: str, quote: str, trim: bool) -> DataFrame:
    """The lines of text files in chunks, each of one split and of consecutive lines, stored in the scratch folder."""
    read = spark.read.option("lineSep", "\n").text(list(paths))
    line = F.concat(F.col("value").cast("binary"), F.lit(b"\n"))
    found = read.select(file_id().alias("file"), F.col("_metadata.file_block_start").alias("block"), line.alias("line"))

    most = CHUNK_BYTES

    # Nested functions travel to the executors by value, so these need no copy of this package.
    def count(batches):
        import numpy as np
        import pyarrow as pa

        mark, ends, blanks = quote.encode()[0], {delimiter.encode()[0], 10}, {13, *((32, 9) if trim else ())}
        is_end, is_blank = (np.isin(np.arange(256), list(s)) for s in (ends, blanks))
        names = [f.split()[0] for f in CHUNKS.split(", ")]

        def stray(data, at, opening):
            """Whether a quote neither opens nor closes a cell nor belongs to a pair, if those marked open."""
            before, after = np.concatenate([[10], data[:-1]]), np.concatenate([data[1:], [10]])
            left, right = before[at], after[at]
            if is_blank[left].any() or is_blank[right].any():
                # The nearest byte that is not blank stands for the neighbour.
                place, solid = np.arange(len(data)), ~is_blank[data]
                last = np.concatenate([[-1], np.maximum.accumulate(np.where(solid, place, -1))])
                following = np.minimum.accumulate(np.where(solid, place, len(data) - 1)[::-1])[::-1]
                left = np.where(last[at] >= 0, data[last[at]], 10)
                right = data[following[at + 1]]  # the data ends in a line feed
            opens = is_end[left] | (before[at] == mark)
            closes = is_end[right] | (after[at] == mark)
            return not np.where(opening, opens, closes).all()

        key, chunk = None, 0
        for batch in batches:
            file, block = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            if not len(file):
                continue
            column = batch.column(2)
            offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]
            every = np.frombuffer(column.buffers()[2], np.uint8)
            changes = (np.flatnonzero((file[1:] != file[:-1]) | (block[1:] != block[:-1])) + 1).tolist()
            pieces = []
            for a, b in zip([0, *changes], [*changes, len(file)]):
                while a < b:
                    pieces.append((a, min(b, max(a + 1, int(np.searchsorted(offsets, int(offsets[a]) + most, side="right")) - 1))))
                    a = pieces[-1][1]
            for a, b in pieces:
                now = (int(file[a]), int(block[a]))
                key, chunk = now, chunk + 1 if now == key else 0
                data = every[offsets[a] : offsets[b]]
                at = np.flatnonzero(data == mark)
                even = np.arange(len(at)) % 2 == 0
                end = int(np.argmax(data == 10))
                row = [*key, chunk, len(at) % 2 == 1, stray(data, at, even), stray(data, at, ~even), end > 0 and int(data[end - 1]) == 13]
                yield pa.RecordBatch.from_arrays(
                    [*[pa.array([v]) for v in row], pa.array([data.tobytes()], pa.binary())], names=names
                )

    folder = scratch_dir(spark, "csv-chunks")
    found.mapInArrow(count, CHUNKS).write.option("compression", "zstd").parquet(folder)
    chunks = spark.read.schema(CHUNKS).parquet(folder)
    chunks.staged_path = folder
    return chunks


def chunk_states(chunks: DataFrame) -> DataFrame:
    """A row for each chunk, without its bytes: ``inside``, whether it begins inside a cell, and ``stray``, whether a quote of it is."""
    earlier = Window.partitionBy("file").orderBy("block", "chunk").rowsBetween(Window.unboundedPreceding, -1)
    inside = F.coalesce(F.sum(F.col("odd").cast("int")).over(earlier), F.lit(0)) % 2 == 1
    stray = F.when(F.col("inside"), F.col("stray_inside")).otherwise(F.col("stray"))
    return chunks.drop("bytes").withColumn("inside", inside).select("file", "block", "chunk", "inside", stray.alias("stray"), "crlf")


def records(chunks: DataFrame, states: DataFrame, quote: str, n_chunks: int) -> DataFrame:
    """``file``, ``block``, ``seq`` and ``record`` of the files that ``states`` has, the records across chunks joined."""
    known = states.select("file", "block", "chunk", "inside")
    known = F.broadcast(known) if n_chunks <= MOST_STATES else known
    found = _cut(chunks.select("file", "block", "chunk", "bytes").join(known, ["file", "block", "chunk"]), quote)
    # At most two parts a chunk: the open record, and heads up to the one that closes it.
    order = Window.partitionBy("file").orderBy("block", "seq")
    owner = F.count_if(F.col("part") == OPEN).over(order)
    joined = (
        found.where(F.col("part") != WHOLE)
        .withColumn("owner", owner)
        .groupBy("file", "owner")
        .agg(F.sort_array(F.collect_list(F.struct("block", "seq", "record"))).alias("p"))
    )
    text = F.aggregate(F.transform("p", lambda x: x["record"]), F.lit(b""), lambda a, x: F.concat(a, x))
    crossing = joined.select("file", F.col("p")[0]["block"].alias("block"), F.col("p")[0]["seq"].alias("seq"), text.alias("record"))
    return found.where(F.col("part") == WHOLE).drop("part").unionByName(crossing)


def _cut(chunks: DataFrame, quote: str) -> DataFrame:
    """The records of every chunk; ``part`` marks the last one if it is left open, and what comes before the first begins."""

    def cut(batches):
        import numpy as np
        import pyarrow as pa

        mark = quote.encode()[0]
        names = [f.split()[0] for f in RECORDS.split(", ")]

        def batch_of(row, number, data, starts, part):
            """Records numbered on from ``number``, as slices of ``data``."""
            n = len(starts)
            offsets = pa.py_buffer(np.concatenate([starts, [len(data)]]).astype(np.int32).tobytes())
            column = pa.Array.from_buffers(pa.binary(), n, [None, offsets, pa.py_buffer(np.ascontiguousarray(data))])
            seq = (row["chunk"] << RECORD_BITS) + number + np.arange(n)
            place = [pa.array(np.full(n, row[k], np.int64)) for k in ("file", "block")]
            return pa.RecordBatch.from_arrays([*place, pa.array(seq), pa.array(np.full(n, part, np.int32)), column], names=names)

        for batch in batches:
            for i in range(batch.num_rows):
                row = {k: batch.column(k)[i].as_py() for k in ("file", "block", "chunk", "inside")}
                data = np.frombuffer(batch.column("bytes")[i].as_buffer(), np.uint8)
                starts = np.concatenate([[0], np.flatnonzero(data == 10)[:-1] + 1])
                quotes = np.concatenate([[0], np.cumsum(data == mark)])
                starts = starts[(quotes[starts] + row["inside"]) % 2 == 0]
                left_open = bool((int(quotes[-1]) + row["inside"]) % 2)
                head = int(starts[0]) if len(starts) else len(data)
                if head:
                    yield batch_of(row, 0, data[:head], np.zeros(1, np.int64), HEAD)
                if not len(starts):
                    continue
                last = int(starts[-1]) if left_open else len(data)
                whole = starts[:-1] if left_open else starts
                if len(whole):
                    yield batch_of(row, 1, data[head:last], whole - head, WHOLE)
                if left_open:
                    yield batch_of(row, 1 + len(whole), data[last:], np.zeros(1, np.int64), OPEN)

    return chunks.mapInArrow(cut, RECORDS)
