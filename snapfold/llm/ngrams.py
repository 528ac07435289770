"""Language-model scores from an Elias-Fano n-gram trie learned on the corpus.

Every word of the training documents is a class of its own, and every 2-gram and 3-gram of
them is counted: the model grows with the corpus.  (With ``head_share``, words with less
than one in so many of the tokens share the rare class instead; words that never occur in
training are always in it.)

Documents lie in buckets of bounded size.  A bucket sends its distinct words, then its
2-grams, then its 3-grams to shards, a block of sorted numbers to each, and gets back for
each of them its count and how many different classes follow its context; it can list them
again in the same order, so the n-grams do not travel back.  2-grams and 3-grams are sharded by
context, but those of a context with over a quarter of a shard's tokens by all they hold: its followers are
counted in several shards, and these counts are added up.

A shard holds its part of a level of the trie: sorted by context, the classes that follow each
as one Elias-Fano sequence, Elias-Fano pointers to where each context's followers begin,
and their counts.

Probabilities: interpolated absolute discounting down to add-one class shares; a rare word
has its add-one share of its class.

Defined edge cases: a null or blank text is its end token; a null id trains
(its text form is empty); without training tokens every token has probability
one; equal rows count each.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapfold.llm.buckets import bucket_count, bucketed, with_buckets
from snapfold.llm.common import batch_of, discard, free_name, null, stage

DISCOUNT = 0.75
#: Text to a bucket, and to a shard of each level: their blocks, one for each pair, should not become small.
BUCKET_BYTES = 5 << 20
#: Many shuffle partitions make them smaller, but not below this.
LEAST_BYTES = 1 << 20
#: The 3-grams go to the shards in so many turns, as their blocks take the most room.
TURNS = 2
#: Stands for the end token among word hashes; words hash to it with a chance of 2**-64.
END_HASH = np.uint64(0)

_IN_BYTE = np.zeros((256, 8), dtype=np.int64)
for _byte in range(256):
    for _k, _bit in enumerate(b for b in range(8) if _byte >> b & 1):
        _IN_BYTE[_byte, _k] = _bit


class EliasFano:
    """A non-decreasing sequence of integers; every method takes arrays of queries."""

    PARTS = ("low", "high", "ones")

    def __init__(self, n: int, bits: int, low: np.ndarray, high: np.ndarray, ones: np.ndarray):
        self.n, self.bits, self.low, self.high, self.ones = n, bits, low, high, ones
        self.zeros = 64 * np.arange(len(ones)) - ones

    @classmethod
    def build(cls, values: np.ndarray, universe: int) -> EliasFano:
        values = np.asarray(values, dtype=np.uint64)
        n = len(values)
        bits = max(0, (universe // max(n, 1)).bit_length() - 1)
        flags = np.zeros((n + (universe >> bits) + 2 + 63) // 64 * 64, dtype=bool)
        flags[(values >> np.uint64(bits)).astype(np.int64) + np.arange(n)] = True
        high = np.packbits(flags, bitorder="little").view("<u8")
        ones = np.concatenate([[0], np.cumsum(np.bitwise_count(high), dtype=np.int64)])
        spread = (values[:, None] >> np.arange(bits, dtype=np.uint64)) & np.uint64(1)
        packed = np.packbits(spread.astype(bool).reshape(-1), bitorder="little")
        low = np.zeros((len(packed) + 7) // 8 * 8 + 8, dtype=np.uint8)
        low[: len(packed)] = packed
        return cls(n, bits, low.view("<u8"), high, ones)

    def _select(self, rank: np.ndarray, ones: bool) -> np.ndarray:
        """Place of the ``rank``-th one (or zero) bit."""
        counts = self.ones if ones else self.zeros
        word = np.searchsorted(counts, rank, side="right") - 1
        inside = rank - counts[word]
        value = self.high[word] if ones else ~self.high[word]
        pieces = np.ascontiguousarray(value).view(np.uint8).reshape(-1, 8)
        running = np.cumsum(np.bitwise_count(pieces), axis=1, dtype=np.int64)
        byte = (running <= inside[:, None]).sum(axis=1)
        row = np.arange(len(rank))
        inside = inside - np.where(byte > 0, running[row, byte - 1], 0)
        return 64 * word + 8 * byte + _IN_BYTE[pieces[row, byte], inside]

    def _low(self, i: np.ndarray) -> np.ndarray:
        if not self.bits:
            return np.zeros(len(i), dtype=np.int64)
        at = i * self.bits
        word, shift = at >> 6, (at & 63).astype(np.uint64)
        upper = np.where(shift > 0, self.low[word + 1] << ((np.uint64(64) - shift) & np.uint64(63)), np.uint64(0))
        return (((self.low[word] >> shift) | upper) & np.uint64((1 << self.bits) - 1)).astype(np.int64)

    def access(self, i: np.ndarray) -> np.ndarray:
        return ((self._select(i, True) - i) << self.bits) | self._low(i)

    def find(self, begin: np.ndarray, end: np.ndarray, value: np.ndarray) -> np.ndarray:
        """Place of ``value`` in ``begin <= place < end`` (its successor there, if equal), -1 if it is not there."""
        if not self.n or not len(value):
            return np.full(len(value), -1, dtype=np.int64)
        upper, lower = value >> self.bits, value & ((1 << self.bits) - 1)
        first = np.where(upper > 0, self._select(np.maximum(upper - 1, 0), False) - (upper - 1), 0)
        lo, hi = np.maximum(begin, first), np.minimum(end, self._select(upper, False) - upper)
        stop = hi
        while True:
            open_ = lo < hi
            if not open_.any():
                break
            middle = (lo + hi) >> 1
            less = self._low(np.minimum(middle, self.n - 1)) < lower
            lo, hi = np.where(open_ & less, middle + 1, lo), np.where(open_ & ~less, middle, hi)
        hit = (lo < stop) & (self._low(np.minimum(lo, self.n - 1)) == lower)
        return np.where(hit, lo, -1)


class Level:
    """A shard's part of a level: the classes that follow each of its contexts, and how often."""

    def __init__(self, context: np.ndarray, follower: np.ndarray, n: np.ndarray, contexts: int):
        """``context``: numbers below ``contexts``, sorted, and within each ``follower``."""
        self.span, self.contexts = int(follower.max(initial=0)) + 1, contexts
        self.follow = EliasFano.build(context * self.span + follower, contexts * self.span)
        self.point = EliasFano.build(np.searchsorted(context, np.arange(contexts + 1)), len(context) + 1)
        self.n = n

    def lookup(self, context: np.ndarray, follower: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The count of each n-gram, 0 if it is not there, and how many classes follow its context.

        Asked of the sequences as they are: between the pointers of its context, a follower is found by its high and low bits.
        """
        pointers = self.pointers()
        begin, end = pointers[context], pointers[context + 1]
        if not len(self.n):
            return np.zeros(len(context), np.int64), end - begin
        there = follower < self.span
        at = self.follow.find(begin, end, context * self.span + np.where(there, follower, 0))
        return np.where((at >= 0) & there, self.n[at], 0), end - begin

    def pointers(self) -> np.ndarray:
        """Where the followers of each context begin, and where those of the last one end."""
        return self.point.access(np.arange(self.contexts + 1))


class Trie:
    """Levels 1 to 3 over ``classes`` classes in one piece, with quantised probabilities: for few classes."""

    def __init__(self, classes: int, parts: dict[str, np.ndarray], sizes: dict[str, list[int]]):
        self.classes, self.parts, self.sizes = classes, parts, sizes
        self.sequences = {
            name: EliasFano(*size, *(parts[f"{name}.{p}"] for p in EliasFano.PARTS)) for name, size in sizes.items()
        }

    @classmethod
    def build(cls, unigram: np.ndarray, grams: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]) -> Trie:
        """``unigram``: class shares; ``grams[order]``: sorted keys, counts and totals of their contexts (orders 2 and 3)."""
        classes = len(unigram)
        shares = {1: unigram.astype(np.float64)}
        keys = {1: np.arange(classes)}
        parts: dict[str, np.ndarray] = {}
        sizes: dict[str, list[int]] = {}
        for order in (2, 3):
            key, count, total = grams[order]
            context, last = key // classes, key % classes
            if order == 2:
                node, below = context, shares[1][last]
            else:  # the context must be a node, and what is backed off to is found among the bigrams
                node = np.searchsorted(keys[2], context)
                node = np.minimum(node, max(len(keys[2]) - 1, 0))
                there = keys[2][node] == context if len(keys[2]) else np.zeros(len(key), bool)
                key, count, total, node, last = key[there], count[there], total[there], node[there], last[there]
                middle = keys[2][node] % classes
                short = middle * classes + last
                at = np.minimum(np.searchsorted(keys[2], short), max(len(keys[2]) - 1, 0))
                known = keys[2][at] == short if len(key) else np.zeros(0, bool)
                below = np.where(known, shares[2][at], weight2[middle] * shares[1][last]) if len(key) else np.zeros(0)
            nodes = len(keys[order - 1])
            kept = np.bincount(node, weights=(count - DISCOUNT) / np.maximum(total, 1), minlength=nodes)
            weight = 1.0 - kept
            share = (count - DISCOUNT) / np.maximum(total, 1) + weight[node] * below
            if order == 2:
                weight2 = weight
            keys[order], shares[order] = key, share
            # Followers of node i are stored as i * classes + class, which never decreases along the level.
            for name, values, universe in (
                (f"follow{order}", node * classes + last, nodes * classes),
                (f"point{order}", np.searchsorted(node, np.arange(nodes + 1)), len(key) + 1),
            ):
                sequence = EliasFano.build(values, int(universe))
                sizes[name] = [sequence.n, sequence.bits]
                parts |= {f"{name}.{p}": getattr(sequence, p) for p in EliasFano.PARTS}
            for name, values in ((f"back{order}", np.log10(np.maximum(weight, 1e-12))), (f"share{order}", np.log10(np.maximum(share, 1e-12)))):
                parts[name], parts[f"{name}.book"] = _quantised(values)
        parts["share1"], parts["share1.book"] = _quantised(np.log10(shares[1]))
        return cls(classes, parts, sizes)

    def dump(self) -> bytes:
        head, body, at = {}, [], 0
        for name, array in self.parts.items():
            raw = np.ascontiguousarray(array).tobytes()
            head[name] = [array.dtype.str, at, len(array)]
            body.append(raw + b"\0" * (-len(raw) % 8))
            at += len(body[-1])
        header = json.dumps([self.classes, head, self.sizes]).encode()
        header += b" " * (-len(header) % 8)
        return len(header).to_bytes(8, "little") + header + b"".join(body)

    @classmethod
    def load(cls, buffer) -> Trie:
        view = memoryview(buffer)
        size = 8 + int.from_bytes(view[:8], "little")
        classes, head, sizes = json.loads(bytes(view[8:size]))
        return cls(classes, {n: np.frombuffer(view, dtype=d, count=c, offset=size + at) for n, (d, at, c) in head.items()}, sizes)

    def _read(self, name: str, i: np.ndarray) -> np.ndarray:
        return self.parts[f"{name}.book"][self.parts[name][i]].astype(np.float64) if len(self.parts[name]) else np.zeros(len(i))

    def _child(self, order: int, node: np.ndarray, last: np.ndarray) -> np.ndarray:
        point = self.sequences[f"point{order}"]
        return self.sequences[f"follow{order}"].find(point.access(node), point.access(node + 1), node * self.classes + last)

    def scores(self, u: np.ndarray, v: np.ndarray, w: np.ndarray) -> np.ndarray:
        """log10 of class ``w`` after ``v``, and after ``u`` and ``v`` where ``u`` is not negative."""
        out = self._read("back2", v) + self._read("share1", w)
        pair = self._child(2, v, w)
        hit = pair >= 0
        out[hit] = self._read("share2", pair[hit])
        context = np.full(len(u), -1, dtype=np.int64)
        some = u >= 0
        context[some] = self._child(2, u[some], v[some])
        some = np.flatnonzero(context >= 0)
        triple = self._child(3, context[some], w[some])
        hit = triple >= 0
        # A context that no kept trigram follows has the weight of backing off wholly.
        out[some[~hit]] += self._read("back3", context[some[~hit]])
        out[some[hit]] = self._read("share3", triple[hit])
        return out


def _quantised(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One byte a value and the code book: 256 quantiles."""
    if not len(values):
        return np.zeros(0, np.uint8), np.zeros(1, np.float32)
    unique = np.unique(values)
    book = unique if len(unique) <= 256 else np.quantile(values, np.linspace(0, 1, 256))
    edges = (book[1:] + book[:-1]) / 2
    return np.searchsorted(edges, values).astype(np.uint8), book.astype(np.float32)


def _tokens(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the distinct words in order, the place there of each token, and each text's begin and end among these."""
    # An empty word stands for the end.
    split = [[*(t or "").encode().lower().split(), b""] for t in texts]
    counts = np.fromiter(map(len, split), np.int64, len(split))
    coded = pa.array([w for words in split for w in words], pa.binary()).dictionary_encode()
    hashes = [xxhash.xxh64_intdigest(w, 1) if w else END_HASH for w in coded.dictionary.to_pylist()]
    unique, place = _distinct(np.array(hashes, dtype=np.uint64))
    ends = np.cumsum(counts)
    return unique, place[coded.indices.to_numpy()], ends - counts, ends


def _distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct keys in order, and which of them each key is."""
    bits = max(len(keys) - 1, 0).bit_length()
    if keys.dtype == np.int64 and int(keys.max(initial=0)).bit_length() + bits <= 64:  # sorts faster, with the place in the lowest bits
        both = np.sort(keys.view(np.uint64) << np.uint64(bits) | np.arange(len(keys), dtype=np.uint64))
        order, ranked = (both & np.uint64((1 << bits) - 1)).view(np.int64), (both >> np.uint64(bits)).view(np.int64)
    else:
        order = np.argsort(keys, kind="stable")
        ranked = keys[order]
    first = np.ones(len(keys), dtype=bool)
    first[1:] = ranked[1:] != ranked[:-1]
    where = np.empty(len(keys), dtype=np.int64)
    where[order] = np.cumsum(first) - 1
    return ranked[first], where


def _packed(values: np.ndarray) -> bytes:
    """The number of bytes a value takes, then the lowest bytes of all values, then the next ones."""
    values = np.ascontiguousarray(values).view(np.uint64)
    planes = max(1, -(-int(values.max(initial=0)).bit_length() // 8))
    return bytes([planes]) + b"".join([(values >> np.uint64(8 * k)).astype(np.uint8).tobytes() for k in range(planes)])


def _unpacked(raw: bytes, dtype: str = "<i8") -> np.ndarray:
    planes = np.frombuffer(raw, np.uint8, offset=1).reshape(raw[0], -1)
    out = planes[0].astype(np.uint64)
    for k in range(1, len(planes)):
        out |= planes[k].astype(np.uint64) << np.uint64(8 * k)
    return out.view(dtype)


def _joined(parts: list[np.ndarray], dtype: str = "<i8") -> np.ndarray:
    return np.concatenate([np.zeros(0, dtype), *parts])


def _mixed(values: np.ndarray) -> np.ndarray:
    values = values.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    values = (values ^ (values >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return values ^ (values >> np.uint64(32))


class _Grams:
    """The n-grams of a bucket that a level holds: distinct, by context and follower, and the shards they belong to."""

    def __init__(self, key: np.ndarray, train: np.ndarray):
        self.key, self.where = _distinct(key)
        self.trained = np.bincount(self.where, weights=train, minlength=len(self.key)).astype(np.int64)

    def deal(self, node: np.ndarray, last: np.ndarray, hot: np.ndarray, shards: int) -> None:
        """Contexts that are hot go to further shards, numbered from ``shards`` on."""
        self.node, self.last, self.hot = node, last, hot
        mixed = _mixed(node)
        spread = _mixed(mixed.view(np.int64) + last) % np.uint64(shards) + np.uint64(shards)
        self.shard = np.where(hot, spread, mixed % np.uint64(shards)).astype(np.int32)
        # Short numbers are sorted by radix.
        self.order = np.argsort(self.shard.astype(np.uint16) if 2 * shards <= 1 << 16 else self.shard, kind="stable")

    def blocks(self, bucket: int, turn: int, turns: int) -> Iterator[tuple]:
        shard = self.shard[self.order]
        edges = np.append(np.flatnonzero(np.diff(shard, prepend=-1)), len(shard))
        for a, b in zip(edges[:-1].tolist(), edges[1:].tolist()):
            if shard[a] % turns == turn:
                at = self.order[a:b]
                yield int(shard[a]), bucket, _packed(np.diff(self.node[at], prepend=0)), _packed(self.last[at]), _packed(self.trained[at])

    def answers(self, rows: dict[str, np.ndarray], hot_many: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Count of each, and how many classes follow its context, from the blocks that came back."""
        n, many = (np.empty(len(self.key), dtype=np.int64) for _ in range(2))
        n[self.order], many[self.order] = rows["a"], rows["b"]
        many[self.hot] = hot_many["many"][np.searchsorted(hot_many["node"], self.node[self.hot])]
        return n, many


class _Bucket:
    """The tokens of a bucket as numbers of their classes, with what came back from the levels."""

    def __init__(self, docs: pa.Table, rows: pa.Table, level: int, known: dict, column: str):
        raw = [_unpacked(t) for t in docs.column(column).to_pylist()]
        size = np.fromiter(map(len, raw), np.int64, len(raw))
        self.ends = np.cumsum(size)
        self.begins = self.ends - size
        words = _joined(raw)
        train = np.repeat(~docs.column("held_out").to_numpy(zero_copy_only=False), size)
        back = {k: _returned(rows, k) for k in range(1, level)}
        c, number = back[1]["a"], back[1]["b"]
        head = c > 0 if known["head_share"] is None else (c > 0) & (c * known["head_share"] >= known["total"])
        head[0] = c[0] > 0  # the end token is a class whatever its share
        classes, class_of = _distinct(np.where(head, number, 0))
        self.z = class_of[words]
        self.count = c[words]
        # Tokens of each class in training, all of which something follows, the end token as the one before a text.
        self.tokens = np.full(len(classes), known["rare_total"], dtype=np.int64)
        self.tokens[class_of[head]] = c[head]
        self.share = np.where(classes > 0, self.tokens + 1, known["rare_sum"]) / known["whole"]
        self.rare = classes[self.z] == 0
        before = np.concatenate([self.z[:1], self.z[:-1]])
        before[self.begins] = class_of[0]
        many = len(classes)
        self.pairs = _Grams(before * many + self.z, train)
        self.first, self.second = self.pairs.key // many, self.pairs.key % many
        self.pairs.deal(classes[self.first], classes[self.second], self.tokens[self.first] > known["hot"], known["shards"])
        if level == 2:
            return
        self.pair_n, self.pair_many = self.pairs.answers(back[2], known["hot_many"][2])
        # The context of all but the first token of a text is the 2-gram that ends before it.
        self.inner = np.ones(len(self.z), dtype=bool)
        self.inner[self.begins] = False
        here = np.flatnonzero(self.inner)
        self.triples = _Grams(self.pairs.where[here - 1] * many + self.z[here], train[here])
        self.context, last = self.triples.key // many, self.triples.key % many
        node = classes[self.first[self.context]] * known["span"] + classes[self.second[self.context]]
        self.triples.deal(node, classes[last], self.pair_n[self.context] > known["hot"], known["shards"])
        if level == 4:
            self.triple_n, self.triple_many = self.triples.answers(back[3], known["hot_many"][3])

    def scores(self) -> np.ndarray:
        """log10 of the probability of every token's class."""

        def level(n, many, total, below):
            total_ = np.maximum(total, 1)
            return np.where(total > 0, np.maximum(n - DISCOUNT, 0) / total_ + DISCOUNT * many / total_ * below, below)

        pair = level(self.pair_n, self.pair_many, self.tokens[self.first], self.share[self.second])[self.pairs.where]
        below = np.empty(len(self.triples.key))
        below[self.triples.where] = pair[self.inner]
        triple = level(self.triple_n, self.triple_many, self.pair_n[self.context], below)
        pair[self.inner] = triple[self.triples.where]
        return np.log10(pair)


def _returned(rows: pa.Table, level: int) -> dict[str, np.ndarray]:
    """What the shards sent back, in the order of the shards."""
    own = rows.filter(pc.equal(rows.column("level"), level)).sort_by("shard")
    return {name: _joined([_unpacked(x) for x in own.column(name).to_pylist()]) for name in ("a", "b")}


def held_out(id_column: str, folds: int = 7, fold: int = 2) -> F.Column:
    return F.crc32(F.coalesce(F.col(id_column).cast("string"), F.lit("")).cast("binary")) % folds == fold


def score_documents(docs: DataFrame, text: str = "text", id_column: str = "doc_id", head_share: int | None = None) -> DataFrame:
    """``docs`` without their texts, with ``held_out, n_tokens, n_known, train_tokens, base_score, score`` appended.

    Learns from the documents that are not held out, scores all.
    """
    added = ("held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")
    rest = [c for c in docs.columns if c.lower() not in added and c != text]
    bucket, numbers, words, trained = (free_name(docs, n) for n in ("_bucket", "_numbers", "_words", "_trained"))
    shards = bucket_count(docs, text, BUCKET_BYTES, LEAST_BYTES)
    marked = bucketed(docs.select(*rest, text), text, bucket, buckets=shards).withColumn("held_out", held_out(id_column))
    out = marked.select(bucket, *rest, "held_out", *(null("binary").alias(n) for n in (numbers, words, trained))).schema

    def tokenise(group: pa.Table) -> pa.Table:
        unique, z, begins, ends = _tokens(group.column(text).to_pylist())
        train = np.repeat(~group.column("held_out").to_numpy(zero_copy_only=False), ends - begins)
        # In the order in which the shards of the words give them back; the end token is the first.
        order = np.lexsort((unique, unique % np.uint64(shards)))
        place = np.empty(len(order), dtype=np.int64)
        place[order] = np.arange(len(order))
        z = place[z]
        counts = np.bincount(z, weights=train, minlength=len(unique)).astype(np.int64)
        none = [None] * (len(begins) - 1)
        columns = [group.column(c) for c in (bucket, *rest, "held_out")]
        columns += [
            pa.array([_packed(z[a:b]) for a, b in zip(begins.tolist(), ends.tolist())], pa.binary()),
            # The words of a bucket stand on one of its rows.
            pa.array([_packed(np.diff(unique[order], prepend=np.uint64(0))), *none], pa.binary()),
            pa.array([_packed(counts), *none], pa.binary()),
        ]
        return pa.table(columns, names=[bucket, *rest, "held_out", numbers, words, trained])

    state = stage(marked.groupBy(bucket).applyInArrow(tokenise, out), "numbered-documents")
    block_ddl = "shard int, bucket int, node binary, last binary, n binary"
    block_schema = pa.schema([("shard", pa.int32()), ("bucket", pa.int32()), *((n, pa.binary()) for n in ("node", "last", "n"))])
    # Rows with bucket -1 sum up a shard: counts of its words, or followers of the parts of hot contexts.
    back_ddl = "level int, shard int, bucket int, a binary, b binary"
    back_names = ["level", "shard", "bucket", "a", "b"]

    def back_table(level: int, shard: int, buckets: list[int], a: list[bytes], b: list[bytes]) -> pa.Table:
        same = [pa.array(np.full(len(buckets), x, np.int32)) for x in (level, shard)]
        return pa.table([*same, pa.array(buckets, pa.int32()), pa.array(a, pa.binary()), pa.array(b, pa.binary())], names=back_names)

    def word_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, raw, n in zip(*(c.to_pylist() for c in batch.columns)):
                hashes, counts = np.cumsum(_unpacked(raw, "<u8"), dtype=np.uint64), _unpacked(n)
                shard = (hashes % np.uint64(shards)).astype(np.int64)
                edges = np.append(np.flatnonzero(np.diff(shard, prepend=-1)), len(shard)).tolist()
                rows = [
                    (int(shard[a]), number, b"", _packed(np.diff(hashes[a:b], prepend=np.uint64(0))), _packed(counts[a:b]))
                    for a, b in zip(edges[:-1], edges[1:])
                ]
                yield batch_of(block_schema, *zip(*rows))

    def count_words(key: tuple, group: pa.Table) -> pa.Table:
        parts = [np.cumsum(_unpacked(x, "<u8"), dtype=np.uint64) for x in group.column("last").to_pylist()]
        unique, where = _distinct(_joined(parts, "<u8"))
        c = np.bincount(where, weights=_joined([_unpacked(x) for x in group.column("n").to_pylist()])).astype(np.int64)
        shard = key[0].as_py()
        number = np.where(c > 0, 1 + shard + shards * (np.cumsum(c > 0) - 1), 0)
        ends = np.cumsum([len(p) for p in parts])[:-1]
        a, b = ([*map(_packed, np.split(x[where], ends))] for x in (c, number))
        # Behind the counts, that of the end token once more.
        end = c[unique == END_HASH]
        return back_table(1, shard, [*group.column("bucket").to_pylist(), -1], [*a, _packed(c[c > 0])], [*b, _packed(end)])

    blocks = state.where(F.col(words).isNotNull()).select(bucket, words, trained).mapInArrow(word_blocks, block_ddl)
    back = {1: stage(blocks.groupBy("shard").applyInArrow(count_words, back_ddl), "word-counts")}

    def sums(share: int | None, total: int):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for raw, ends in zip(*(c.to_pylist() for c in batch.columns)):
                    c, end = _unpacked(raw), _unpacked(ends)
                    end = end[(end > 0) & (end * (share or 1) < total)]
                    kept = c if share is None else c[c * share >= total]
                    values = int(kept.sum()), len(kept), len(c)
                    if share is not None:  # the end token, if it is rare
                        values = values[0] + int(end.sum()), values[1] + len(end), len(c)
                    yield pa.RecordBatch.from_arrays([pa.array([v], pa.int64()) for v in values], names=["total", "types", "most"])

        shown = back[1].where("bucket = -1").select("a", "b").mapInArrow(run, "total long, types long, most long")
        return shown.agg(*[F.coalesce(f(c), F.lit(0)) for f, c in ((F.sum, "total"), (F.sum, "types"), (F.max, "most"))]).first()

    total, types, most = sums(None, 0)
    head_total, head_types, _ = (total, types, most) if head_share is None else sums(head_share, total)
    known = {
        "head_share": head_share,
        "total": total,
        "whole": total + types + 1,
        "rare_total": total - head_total,
        "rare_sum": total - head_total + types - head_types + 1,
        "span": 1 + shards * (most + 1),
        "shards": shards,
        "hot": total // (4 * shards),
        "hot_many": {},
    }

    def count_grams(level: int):
        def run(key: tuple, group: pa.Table) -> pa.Table:
            shard = key[0].as_py()
            parts = [np.cumsum(_unpacked(x)) for x in group.column("node").to_pylist()]
            ends = np.cumsum([len(p) for p in parts])[:-1]
            nodes, context = _distinct(_joined(parts))
            follower, n = (_joined([_unpacked(x) for x in group.column(c).to_pylist()]) for c in ("last", "n"))
            span = int(follower.max()) + 1
            grams, where = _distinct(context * span + follower)
            n = np.bincount(where, weights=n).astype(np.int64)
            kept = n > 0
            built = Level(grams[kept] // span, grams[kept] % span, n[kept], len(nodes))
            n, many = built.lookup(grams // span, grams % span)
            buckets = group.column("bucket").to_pylist()
            a, b = ([*map(_packed, np.split(x[where], ends))] for x in (n, many if shard < shards else np.zeros_like(many)))
            if shard < shards:
                return back_table(level, shard, buckets, a, b)
            return back_table(level, shard, [*buckets, -1], [*a, _packed(nodes)], [*b, _packed(np.diff(built.pointers()))])

        return run

    def unpack_hot(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in zip(*(c.to_pylist() for c in batch.columns)):
                yield pa.RecordBatch.from_arrays([pa.array(_unpacked(a)), pa.array(_unpacked(b))], names=["node", "many"])

    def returned(*levels: int) -> DataFrame:
        rows = reduce(DataFrame.unionByName, [back[k] for k in levels]).where("bucket >= 0")
        return rows.withColumnRenamed("bucket", bucket)

    slim = state.select(bucket, "held_out", numbers)

    def send(level: int, turn: int, turns: int, known: dict) -> DataFrame:
        def run(group: pa.Table, rows: pa.Table) -> pa.Table:
            held = _Bucket(group, rows, level, known, numbers)
            found = (held.pairs if level == 2 else held.triples).blocks(group.column(bucket)[0].as_py(), turn, turns)
            return pa.Table.from_batches([batch_of(block_schema, *(zip(*found_) if (found_ := [*found]) else [[]] * 5))])

        blocks = with_buckets(slim, returned(*range(1, level)), bucket, run, block_ddl)
        return stage(blocks.groupBy("shard").applyInArrow(count_grams(level), back_ddl), f"gram-counts-{level}")

    for level, turns in ((2, 1), (3, TURNS)):
        sent = [send(level, turn, turns, known) for turn in range(turns)]
        back[level] = reduce(DataFrame.unionByName, sent)
        # Contexts with over a quarter of a shard's tokens: fewer than four for each shard.
        parts = back[level].where("bucket = -1").select("a", "b").mapInArrow(unpack_hot, "node long, many long")
        hot = sorted(tuple(r) for r in parts.groupBy("node").agg(F.sum("many")).collect())
        many = np.array(hot, dtype=np.int64).reshape(-1, 2)
        known = known | {"hot_many": known["hot_many"] | {level: {"node": many[:, 0], "many": many[:, 1]}}}

    scored = marked.select(
        *rest, "held_out", *(null("long").alias(n) for n in added[1:4]), null("double").alias("base_score"), null("double").alias("score")
    ).schema

    def score(group: pa.Table, rows: pa.Table) -> pa.Table:
        held = _Bucket(group, rows, 4, known, numbers)
        own = np.where(held.rare, np.log10((held.count + 1) / known["rare_sum"]), 0.0)
        base = np.log10((held.count + 1) / known["whole"])
        parts = ((held.count > 0, np.int64), (base, np.float64), (held.scores() + own, np.float64))
        seen, base, model_score = (np.add.reduceat(x, held.begins, dtype=t) for x, t in parts)
        columns = [group.column(x) for x in (*rest, "held_out")]
        columns += [pa.array(held.ends - held.begins), pa.array(seen), pa.array(np.full(len(seen), total, np.int64)), pa.array(base), pa.array(model_score)]
        return pa.table(columns, names=[*rest, *added])

    return with_buckets(state.drop(words, trained), returned(1, 2, 3), bucket, score, scored)
