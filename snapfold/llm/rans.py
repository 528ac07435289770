"""Token ids as files of static range asymmetric numeral system (rANS) blocks.

A corpus is one folder:

* ``table``: the shared frequency table, (symbol, frequency), frequencies
  summing to 2**20; symbols are in ascending order and a symbol's range begins
  where the last one's ends.
* ``blocks``: one Parquet row per block of whole documents.  A shard is a
  contiguous run of the id order.  Token i of a block belongs to lane i mod 32;
  the lanes' 64-bit states are renormalised by 32-bit words, and the words of
  all lanes are interleaved in the order in which a decoder wants them.
  ``states`` and ``word_at`` hold a checkpoint every 256 steps: the states of
  all lanes and the place in ``words``, so any stretch between checkpoints can
  be decoded alone.  ``crc32`` is the checksum of the block's ids as
  little-endian unsigned 32-bit integers, the end padding left out.

Blocks do not need each other, so a reader decodes them in any split of the
files, and within a task all stretches of many blocks advance together.

Defined edge cases: a null or empty text is its end token; rows are in
ascending id order, null ids first, equal ids ordered by a hash of their ids'
bytes; an empty table gives an empty folder that reads back as no rows; a
block whose checksum or states disagree raises ``ValueError``.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from snapfold.llm.common import ENCODE_BYTES, batch_of, slices, stage
from snapfold.llm.tokens import library_encoder, vocabulary_size, with_end

SCALE = 20
LANES = 32
LOW = np.uint64(1 << 31)
#: Lane steps between checkpoints; documents fill a block up to about this many tokens.
STRETCH = 256
BLOCK_TOKENS = 32_768
#: Tokens that a task encodes at once, and that a shard should hold.
GROUP_TOKENS = 2_000_000
SHARD_TOKENS = 4_000_000
#: Shards whose offsets may be broadcast (16 bytes each).
BROADCAST_SHARDS = 1_000_000


def frequencies(counts: dict[int, int]) -> tuple[np.ndarray, np.ndarray]:
    """Symbols in ascending order and frequencies of at least one that sum to 2**SCALE."""
    if not counts:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    if len(counts) > 1 << SCALE:
        raise ValueError("more symbols than the frequency table has slots")
    symbols = np.array(sorted(counts), dtype=np.int64)
    found = np.array([counts[s] for s in symbols.tolist()], dtype=np.float64)
    scaled = np.maximum(1, np.floor(found / found.sum() * (1 << SCALE))).astype(np.int64)
    order = np.argsort(-scaled, kind="stable")
    left = (1 << SCALE) - int(scaled.sum())
    if left > 0:
        scaled[order[0]] += left
    for at in order if left < 0 else ():
        take = min(-left, int(scaled[at]) - 1)
        scaled[at] -= take
        left += take
        if not left:
            break
    return symbols, scaled


class Coder:
    """Encodes and decodes many blocks in step, with one frequency table."""

    def __init__(self, symbols, frequency):
        symbols = np.asarray(symbols, dtype=np.int64)
        self.symbols = symbols
        self.frequency = np.asarray(frequency, dtype=np.uint64)
        self.begin = np.concatenate([[0], np.cumsum(self.frequency)[:-1]]).astype(np.uint64) if len(symbols) else self.frequency
        self.code = np.zeros(int(symbols.max()) + 1 if len(symbols) else 0, dtype=np.int32)
        self.code[symbols] = np.arange(len(symbols))
        self.slot = np.repeat(np.arange(len(symbols), dtype=np.int32), self.frequency.astype(np.int64))
        self.pad = int(self.frequency.argmax()) if len(symbols) else 0

    def encode(self, blocks: list[np.ndarray]) -> list[tuple[bytes, bytes, np.ndarray]]:
        """``words``, ``states`` and ``word_at`` of each block of token ids."""
        order = sorted(range(len(blocks)), key=lambda k: -len(blocks[k]))
        steps = np.array([-(-len(blocks[k]) // LANES) for k in order])
        most = int(steps[0]) if len(steps) else 0
        grid = np.full((len(blocks), most * LANES), self.pad, dtype=np.int32)
        for row, k in enumerate(order):
            grid[row, : len(blocks[k])] = self.code[blocks[k]]
        grid = grid.reshape(len(blocks), most, LANES)
        state = np.full((len(blocks), LANES), LOW, dtype=np.uint64)
        words = np.zeros((most, len(blocks), LANES), dtype=np.uint32)
        emitted = np.zeros((most, len(blocks), LANES), dtype=bool)
        marks = np.zeros((-(-most // STRETCH), len(blocks), LANES), dtype=np.uint64)
        shift, low, scale = np.uint64(32), np.uint64(0xFFFFFFFF), np.uint64(SCALE)
        room = np.uint64(63 - SCALE)  # a state from here on, times the frequency, has no room for the next symbol
        for step in range(most - 1, -1, -1):
            n = int(np.searchsorted(-steps, -step, side="left"))  # blocks with more steps than this one come first
            code = grid[:n, step]
            f, x = self.frequency[code], state[:n]
            full = x >= (f << room)
            words[step, :n] = (x & low).astype(np.uint32)
            emitted[step, :n] = full
            x = np.where(full, x >> shift, x)
            quotient = x // f
            state[:n] = (quotient << scale) + (x - quotient * f) + self.begin[code]
            if step % STRETCH == 0:
                marks[step // STRETCH, :n] = state[:n]
        out: list = [None] * len(blocks)
        for row, k in enumerate(order):
            s = int(steps[row])
            used = emitted[:s, row]
            per_step = used.sum(axis=1)
            at = np.concatenate([[0], np.cumsum(per_step)])[:s:STRETCH].astype(np.int32)
            out[k] = (
                words[:s, row][used].astype("<u4").tobytes(),
                marks[: len(at), row].astype("<u8").tobytes(),
                at,
            )
        return out

    def decode(self, sizes: np.ndarray, words: list[bytes], states: list[bytes], word_at: list[np.ndarray]) -> list[np.ndarray]:
        """Token ids of each block; all stretches between checkpoints advance together."""
        stream = np.frombuffer(b"".join(words) + b"\0\0\0\0", dtype="<u4").astype(np.uint64)
        bases = np.concatenate([[0], np.cumsum([len(w) // 4 for w in words])])
        steps = -(-sizes // LANES)
        parts = -(-steps // STRETCH)
        block = np.repeat(np.arange(len(sizes)), parts)
        nth = np.arange(len(block)) - np.repeat(np.cumsum(parts) - parts, parts)
        length = np.minimum(STRETCH, steps[block] - nth * STRETCH)
        state = np.frombuffer(b"".join(states), dtype="<u8").reshape(-1, LANES).astype(np.uint64)
        if len(state) != len(block):
            raise ValueError("a block's checkpoints do not fit its size")
        place = np.concatenate([*word_at, []]).astype(np.int64) + bases[block]
        order = np.argsort(-length, kind="stable")
        x, at, long = state[order], place[order], length[order]
        out = np.zeros((len(block), STRETCH, LANES), dtype=np.int32)
        mask, scale, shift = np.uint64((1 << SCALE) - 1), np.uint64(SCALE), np.uint64(32)
        for step in range(int(long[0]) if len(long) else 0):
            n = int(np.searchsorted(-long, -step, side="left"))
            slot = x[:n] & mask
            code = self.slot[slot.astype(np.int64)]
            out[:n, step] = code
            y = self.frequency[code] * (x[:n] >> scale) + slot - self.begin[code]
            need = y < LOW
            nth_word = np.cumsum(need, axis=1)
            place_of = np.minimum(at[:n, None] + nth_word - 1, len(stream) - 1)
            x[:n] = np.where(need, (y << shift) | stream[np.maximum(place_of, 0)], y)
            at[:n] += nth_word[:, -1]
        back = np.empty(len(order), dtype=np.int64)
        back[order] = np.arange(len(order))
        # Each stretch must arrive at the next checkpoint, the last of a block where encoding began.
        arrived = x[back]
        last = nth == parts[block] - 1
        expected = np.where(last[:, None], LOW, np.roll(state, -1, axis=0))
        if not np.array_equal(arrived, expected):
            raise ValueError("a block does not decode to its checkpoints")
        rows = out[back]
        found, begin = [], 0
        for size, count in zip(sizes.tolist(), parts.tolist()):
            found.append(self.symbols[rows[begin : begin + count].reshape(-1)[:size]].astype(np.uint32))
            begin += count
        return found


def write_tokens(docs: DataFrame, path: str, tokenizer: str, end: int, text: str = "text", id_column: str = "doc_id") -> None:
    """Encode every text, append ``end``, and write the corpus folder ``path`` in ascending id order."""
    spark = docs.sparkSession
    plain = docs.select(F.col(id_column).alias("doc_id"), F.col(text).alias("text"))
    # Ids are staged and shuffled in two bytes where the vocabulary allows.
    kind_of_id = "<u2" if vocabulary_size(tokenizer) <= 1 << 16 and end < 1 << 16 else "<u4"
    id_bytes = int(kind_of_id[2])

    def tokenize(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = library_encoder(tokenizer, False)
        for batch in slices(batches, "text", ENCODE_BYTES):
            ids, counts = with_end(*encoder(batch.column("text")), end)
            raw = ids.astype(kind_of_id).tobytes()
            stops = (id_bytes * np.cumsum(counts)).tolist()
            parts = [raw[a:b] for a, b in zip([0, *stops], stops)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(parts, pa.binary()), pa.array(counts)], names=["doc_id", "ids", "n_tokens"])

    kind = plain.schema["doc_id"].dataType.simpleString()
    tokens = stage(plain.mapInArrow(tokenize, f"doc_id {kind}, ids binary, n_tokens long"), "token-ids")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, dtype=np.int64)
        for batch in slices(batches, "ids"):
            found = np.bincount(np.frombuffer(b"".join(batch.column("ids").to_pylist()), dtype=kind_of_id))
            if len(found) > len(total):
                total, found = found, total
            total[: len(found)] += found
        used = np.flatnonzero(total)
        yield batch_of(pa.schema([("symbol", pa.int64()), ("n", pa.int64())]), used, total[used])

    counted = tokens.select("ids").mapInArrow(count, "symbol long, n long").groupBy("symbol").agg(F.sum("n").alias("n"))
    # One row per symbol of the vocabulary, however large the corpus.
    symbols, frequency = frequencies({r["symbol"]: r["n"] for r in counted.collect()})
    spark.createDataFrame(
        pa.table({"symbol": pa.array(symbols, pa.int64()), "frequency": pa.array(frequency, pa.int64())}), "symbol long, frequency long"
    ).coalesce(1).write.parquet(f"{path}/table")

    total = tokens.agg(F.sum("n_tokens")).first()[0] or 0
    shards = max(1, -(-total // SHARD_TOKENS))
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("ids")]
    ordered = tokens.repartitionByRange(shards, *order).sortWithinPartitions(*order, "ids")
    schema = pa.schema(
        [
            ("shard", pa.int32()),
            ("block", pa.int32()),
            ("first_token", pa.int64()),
            ("n_tokens", pa.int64()),
            ("doc_ids", pa.list_(_arrow_type(plain))),
            ("doc_tokens", pa.list_(pa.int64())),
            ("words", pa.binary()),
            ("states", pa.binary()),
            ("word_at", pa.list_(pa.int32())),
            ("crc32", pa.int64()),
        ]
    )

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Coder(symbols, frequency)
        shard = TaskContext.get().partitionId()
        at = number = 0
        for group in _block_groups(batches):
            blocks_ = [np.frombuffer(raw, dtype=kind_of_id) for _, _, raw in group]
            coded = coder.encode(blocks_)
            rows = []
            for (ids, sizes, _), block_ids, (words, states, word_at) in zip(group, blocks_, coded):
                crc = zlib.crc32(block_ids.astype("<u4").tobytes())
                rows.append((shard, number, at, sum(sizes), ids, sizes, words, states, word_at, crc))
                number, at = number + 1, at + sum(sizes)
            yield batch_of(schema, *zip(*rows))

    blocks = ordered.mapInArrow(
        encode,
        f"shard int, block int, first_token long, n_tokens long, doc_ids array<{kind}>, doc_tokens array<long>, "
        "words binary, states binary, word_at array<int>, crc32 long",
    )
    blocks.write.option("compression", "none").parquet(f"{path}/blocks")


def _arrow_type(plain: DataFrame) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(plain.schema["doc_id"].dataType)


def _block_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple[list, list[int], bytes]]]:
    """Blocks (doc ids, token counts, id bytes) in lists of about GROUP_TOKENS tokens; documents stay whole."""
    group, held = [], 0
    ids, sizes, raw = [], [], []

    def block():
        return ids, sizes, b"".join(raw)

    size = 0
    for batch in slices(batches, "ids"):
        for doc, data, n in zip(batch.column("doc_id").to_pylist(), batch.column("ids").to_pylist(), batch.column("n_tokens").to_pylist()):
            ids.append(doc)
            sizes.append(n)
            raw.append(data)
            size += n
            if size >= BLOCK_TOKENS:
                group.append(block())
                held += size
                ids, sizes, raw, size = [], [], [], 0
                if held >= GROUP_TOKENS:
                    yield group
                    group, held = [], 0
    if ids:
        group.append(block())
    if group:
        yield group


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """``(doc_id, start, n_tokens, ids)`` of a corpus folder; ``ids`` are little-endian unsigned 32-bit integers.

    Blocks are decoded where their file splits are read and checked against
    their checkpoints and checksums.
    """
    rows = spark.read.parquet(f"{path}/table").orderBy("symbol").collect()  # bounded by the vocabulary
    symbols, frequency = [r["symbol"] for r in rows], [r["frequency"] for r in rows]
    blocks = spark.read.parquet(f"{path}/blocks")
    kind = blocks.schema["doc_ids"].dataType.elementType.simpleString()

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Coder(symbols, frequency)
        for batch in slices(batches, "words", 3 << 20):
            sizes = batch.column("n_tokens").to_numpy()
            found = coder.decode(
                sizes,
                batch.column("words").to_pylist(),
                batch.column("states").to_pylist(),
                [np.asarray(a, dtype=np.int64) for a in batch.column("word_at").to_pylist()],
            )
            for k, ids in enumerate(found):
                raw = ids.astype("<u4").tobytes()
                if zlib.crc32(raw) != batch.column("crc32")[k].as_py():
                    raise ValueError(f"checksum of shard {batch.column('shard')[k]} block {batch.column('block')[k]} is wrong")
                counts = np.asarray(batch.column("doc_tokens")[k].as_py(), dtype=np.int64)
                ends = np.cumsum(counts)
                docs = batch.column("doc_ids")[k].values
                parts = [raw[4 * a : 4 * b] for a, b in zip((ends - counts).tolist(), ends.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [
                        docs,
                        pa.array(np.full(len(counts), batch.column("shard")[k].as_py(), dtype=np.int32)),
                        pa.array(ends - counts + batch.column("first_token")[k].as_py()),
                        pa.array(counts),
                        pa.array(parts, pa.binary()),
                    ],
                    names=["doc_id", "shard", "at", "n_tokens", "ids"],
                )

    docs = blocks.mapInArrow(decode, f"doc_id {kind}, shard int, at long, n_tokens long, ids binary")
    sums = blocks.groupBy("shard").agg(F.sum("n_tokens").alias("n"))
    before = W.orderBy("shard").rowsBetween(W.unboundedPreceding, -1)  # one row per shard
    offsets = stage(sums.select("shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first")), "shard-offsets")
    if offsets.count() <= BROADCAST_SHARDS:
        offsets = F.broadcast(offsets)
    return docs.join(offsets, "shard").select("doc_id", (F.col("first") + F.col("at")).alias("start"), "n_tokens", "ids")
