"""Byte-level BPE encoding and decoding with a rank queue under a hierarchical bitmap.

The pairs of a pre-token wait in one bucket per merge rank.  A bitmap says
which buckets hold something, and a level above says which words of the bitmap
are not zero, so the next rank is two find-first-set steps away however long
the pre-token is.  Buckets hold positions of a linked list; an
entry whose pair has changed since is stale and skipped when it comes up.

Defined edge cases: a null text is empty and has no ids; ids outside the
vocabulary fail decoding with a ``KeyError``; null ids decode to no bytes.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapfold.llm.common import ENCODE_BYTES, free_name, null, slices
from snapfold.llm.tokens import ChunkEncoder

WORD_BITS = 256
#: Short pre-tokens whose ids a worker keeps.
SEEN = 100_000


class RankQueue:
    """Positions by rank; ``pop`` gives the lowest rank, and the leftmost position within it.

    Two levels of bits are enough for some 65,000 ranks: words of 256 ranks,
    and one integer that says which words are not zero.
    """

    __slots__ = ("words", "filled", "buckets")

    def __init__(self, ranks: int):
        self.words = [0] * -(-ranks // WORD_BITS)
        self.filled = 0
        self.buckets: dict[int, int | list[int]] = {}  # one position, or a heap of several

    def push(self, rank: int, position: int) -> None:
        bucket = self.buckets.get(rank)
        if bucket is None:
            self.buckets[rank] = position
            word = rank >> 8
            self.words[word] |= 1 << (rank & 255)
            self.filled |= 1 << word
        elif type(bucket) is int:
            self.buckets[rank] = [bucket, position] if bucket < position else [position, bucket]
        else:
            heappush(bucket, position)

    def fill(self, ranks: list[int | None]) -> None:
        """Push position i with ``ranks[i]`` for all i that have one, in order; the queue is empty before."""
        buckets, words, filled = self.buckets, self.words, self.filled
        for position, rank in enumerate(ranks):
            if rank is not None:
                bucket = buckets.get(rank)
                if bucket is None:
                    buckets[rank] = position
                    word = rank >> 8
                    words[word] |= 1 << (rank & 255)
                    filled |= 1 << word
                elif type(bucket) is int:
                    buckets[rank] = [bucket, position]
                else:  # ascending positions are a heap as they are
                    bucket.append(position)
        self.filled = filled

    def pop(self) -> tuple[int, int] | None:
        filled = self.filled
        if not filled:
            return None
        first = filled & -filled
        at = first.bit_length() - 1
        word = self.words[at]
        bit = word & -word
        rank = (at << 8) + bit.bit_length() - 1
        bucket = self.buckets[rank]
        if type(bucket) is not int:
            position = heappop(bucket)
            if bucket:
                return rank, position
        else:
            position = bucket
        del self.buckets[rank]
        word ^= bit
        self.words[at] = word
        if not word:
            self.filled = filled ^ first
        return rank, position


class BytePairs:
    """Encoder and decoder over ranks, ``{token bytes: id}``."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks, self.split = ranks, regex.compile(pattern).findall
        self.queue = RankQueue(max(ranks.values()) + 1)
        self.seen: dict[str, list[int]] = {}
        tokens = [b""] * (max(ranks.values()) + 1)
        for token, i in ranks.items():
            tokens[i] = token
        self.lengths = np.array([len(t) for t in tokens])
        self.tokens = pa.array(tokens, pa.large_binary())

    def encode(self, text: str) -> list[int]:
        ids: list[int] = []
        seen = self.seen
        for piece in self.split(text):
            found = seen.get(piece)
            if found is None:
                found = self.encode_piece(piece.encode())
                if len(piece) < 64:
                    if len(seen) >= SEEN:
                        seen.clear()
                    seen[piece] = found
            ids += found
        return ids

    def encode_piece(self, piece: bytes) -> list[int]:
        ranks, queue = self.ranks, self.queue
        whole = ranks.get(piece)
        if whole is not None:
            return [whole]
        n = len(piece)
        find, push, pop = ranks.get, queue.push, queue.pop
        end = list(range(1, n + 1))  # of the node that begins here
        before = list(range(-1, n - 1))
        pair = [find(piece[i : i + 2]) for i in range(n - 1)]
        pair.append(None)  # rank of the pair that begins here, None if it can't merge
        queue.fill(pair)
        while (found := pop()) is not None:
            rank, i = found
            if pair[i] != rank:
                continue
            j = end[i]
            stop = end[i] = end[j]
            pair[j] = None
            if stop < n:
                before[stop] = i
                new = pair[i] = find(piece[i : end[stop]])
                if new is not None:
                    push(new, i)
            else:
                pair[i] = None
            h = before[i]
            if h >= 0:
                new = pair[h] = find(piece[h:stop])
                if new is not None:
                    push(new, h)
        ids, i = [], 0
        while i < n:
            ids.append(ranks[piece[i : end[i]]])
            i = end[i]
        return ids

    def decode(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The bytes of all ids in a row, and how many each id has."""
        if len(ids) and (ids.min() < 0 or ids.max() >= len(self.lengths) or not self.lengths[ids].all()):
            raise KeyError("an id is outside the vocabulary")
        data = self.tokens.take(pa.array(ids)).buffers()[2]
        return np.frombuffer(data or b"", np.uint8), self.lengths[ids]


@lru_cache(maxsize=2)
def byte_pairs(path: str, pattern: str) -> BytePairs:
    """From a rank file (base64 token and rank a line), one per worker process."""
    with open(path, "rb") as lines:
        return BytePairs({base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}, pattern)


@lru_cache(maxsize=2)
def _chunks(path: str, pattern: str) -> ChunkEncoder:
    pairs = byte_pairs(path, pattern)
    return ChunkEncoder(lambda chunks: [pairs.encode(c) for c in chunks], True, most=600_000)


def encode(docs: DataFrame, ranks: str, pattern: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """``docs`` without its text, with ``ids`` (array of int) appended; no shuffle.

    ``pattern`` must keep a space with the word after it and otherwise match
    runs of white space up to the last character, as the public byte-level
    patterns do: chunks of text between such places are encoded once each.
    """
    rest = [c for c in docs.columns if c not in (text, ids)]
    schema = docs.select(*rest, null("array<int>").alias(ids)).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _chunks(ranks, pattern)
        for batch in slices(batches, text, ENCODE_BYTES):
            flat, counts = encoder(batch.column(text))
            offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat.view(np.int32)))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in rest), lists], names=[*rest, ids])

    return docs.mapInArrow(run, schema)


def decode(encoded: DataFrame, ranks: str, pattern: str, ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """``encoded`` with the bytes of its ids appended (binary: an id list need not end at a character)."""
    decoded = free_name(encoded, decoded)
    schema = encoded.select("*", null("binary").alias(decoded)).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs = byte_pairs(ranks, pattern)
        for whole in batches:
            for at in range(0, whole.num_rows, 512):
                batch = whole.slice(at, 512)
                lists = batch.column(ids)
                counts = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
                raw, lengths = pairs.decode(lists.flatten().to_numpy(zero_copy_only=False))
                ends = np.concatenate([[0], np.cumsum(lengths)])[np.concatenate([[0], np.cumsum(counts)])]
                out = pa.Array.from_buffers(pa.large_binary(), batch.num_rows, [None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(raw)])
                yield pa.RecordBatch.from_arrays([*batch.columns, out.cast(pa.binary())], names=[*batch.schema.names, decoded])

    return encoded.mapInArrow(run, schema)
