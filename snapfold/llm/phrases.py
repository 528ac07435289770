"""Removal of repeated word windows with sharded Aho-Corasick automata.

Any window of ``window`` words holds one sampled phrase of ``phrase`` words
(its minimizer), and equal windows hold the same one.  So:

1. sample the phrases of all documents and count them; those found twice or
   more are confirmed as recurring, and each bucket of documents gets the
   confirmed phrases that were sampled in it;
2. compile an automaton per bucket and stream the bucket's documents through
   it: it locates every occurrence of its phrases, and only windows around an
   occurrence can repeat;
3. of equal windows in a bucket only the first goes on, so no window has more
   rows than there are buckets; sorted by their 128-bit hash they are streamed
   past, and all but the first of each are marked;
4. the marks go back to the documents' buckets.

Defined edge cases: a null or blank text has no words; a text with fewer words
than a window loses nothing; documents of equal id are ordered by text, and
equal rows among themselves; null ids count as last.
"""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapfold.llm.buckets import bucketed, covered, in_order, minimizers, runs, with_buckets
from snapfold.llm.common import batch_of, discard, free_name, null, slices, stage

#: Odd multipliers of the two rolling hashes.
BASES = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))


class Words:
    """The words of several texts in a row, with hashes of their sequences."""

    def __init__(self, texts: list[str | None], lower: bool = False):
        split = [((t or "").encode().lower() if lower else (t or "").encode()).split() for t in texts]
        self.counts = np.fromiter(map(len, split), np.int64, len(split))
        self.ends = np.cumsum(self.counts)
        self.words = [w for words in split for w in words]
        coded = pa.array(self.words, pa.binary()).dictionary_encode()
        unique = coded.dictionary.to_pylist()
        self.codes = coded.indices.to_numpy()
        self.hashes = [
            np.array([xxhash.xxh64_intdigest(w, seed) for w in unique], dtype=np.uint64)[self.codes] if unique else np.zeros(0, np.uint64)
            for seed in (1, 2)
        ]
        sizes = np.fromiter(map(len, unique), np.int64, len(unique))[self.codes] if unique else np.zeros(0, np.int64)
        # Places of the words in all texts joined by single spaces, one space in front.
        self.begins = 1 + np.cumsum(sizes + 1) - (sizes + 1)
        self.stops = self.begins + sizes

    def joined(self) -> bytes:
        return b" " + b" ".join(self.words) + b" "

    def sequences(self, size: int, which: int = 0) -> np.ndarray:
        """Rolling hash of ``size`` words from each place on, across the borders of texts."""
        n = len(self.words) - size + 1
        out = np.zeros(max(n, 0), dtype=np.uint64)
        for j in range(size if n > 0 else 0):
            out = out * BASES[which] + self.hashes[which][j : j + n]
        return out

    def inside(self, size: int) -> np.ndarray:
        """True where ``size`` words from here on belong to one text."""
        n = len(self.words)
        return np.arange(n) + size <= np.repeat(self.ends, self.counts)


def sampled_phrases(docs: DataFrame, text: str, bucket: str, window: int, phrase: int) -> DataFrame:
    """``(bucket, hash, phrase, n)``: the sampled phrases of each bucket."""
    schema = pa.schema([(bucket, pa.int32()), ("hash", pa.int64()), ("phrase", pa.binary()), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text):
            words = Words(batch.column(text).to_pylist())
            hashes = words.sequences(phrase)
            places = minimizers(hashes, window - phrase + 1, words.inside(window))
            owner = batch.column(bucket).to_numpy()[np.searchsorted(words.ends, places, side="right")]
            order = np.lexsort((hashes[places], owner))
            places, owner = places[order], owner[order]
            found = hashes[places]
            first = np.ones(len(places), dtype=bool)
            first[1:] = (found[1:] != found[:-1]) | (owner[1:] != owner[:-1])
            at = np.flatnonzero(first)
            raw, pick = words.joined(), places[at]
            texts = [raw[a:b] for a, b in zip(words.begins[pick].tolist(), words.stops[pick + phrase - 1].tolist())]
            yield batch_of(schema, owner[at], found[at].view(np.int64), texts, np.diff(np.append(at, len(places))))

    return docs.select(bucket, text).mapInArrow(run, f"{bucket} int, hash long, phrase binary, n long")


def locate(words: Words, phrases: list[bytes]) -> np.ndarray:
    """Places of the first word of every occurrence of a phrase."""
    if not phrases or not words.words:
        return np.zeros(0, np.int64)
    automaton = ahocorasick.Automaton(ahocorasick.STORE_LENGTH)
    for p in set(phrases):
        automaton.add_word(f" {p.decode('latin-1')} ")  # one character a byte, and whole words only
    automaton.make_automaton()
    begins = np.fromiter(
        (end - length + 2 for end, length in automaton.iter(words.joined().decode("latin-1"))), np.int64
    )
    return np.unique(np.searchsorted(words.begins, begins))


def remove_repeats(
    docs: DataFrame, text: str = "text", id_column: str = "doc_id", window: int = 20, phrase: int = 8, joined: bool = True
) -> DataFrame:
    """``docs`` with ``n_words``, ``n_removed``, ``kept_words`` (joined by one space) and ``kept_text`` appended.

    ``kept_text`` is the text with its own white space and without the removed
    words; ``kept_words`` is null unless ``joined``.  Input columns with these names are replaced.
    """
    added = ("n_words", "n_removed", "kept_words", "kept_text")
    kept = [c for c in docs.columns if c.lower() not in added]
    bucket = free_name(docs, "_bucket")
    marked = bucketed(docs.select(*kept), text, bucket)

    sampled = stage(sampled_phrases(marked, text, bucket, window, phrase), "phrases")
    recurring = stage(sampled.groupBy("hash").agg(F.sum("n").alias("n")).where("n >= 2").select("hash"), "recurring")
    confirmed = stage(sampled.join(recurring, "hash", "left_semi").select(bucket, "phrase"), "confirmed")
    discard(sampled, recurring)

    kind = marked.schema[id_column].dataType.simpleString()
    keys = marked.select(bucket, F.col(id_column).alias("id"), F.col(text).alias("text"))
    arrow_id = _arrow_type(keys, "id")
    windows_schema = pa.schema(
        [(bucket, pa.int32()), ("doc", pa.int32()), ("start", pa.int32()), ("stop", pa.int32()), ("id", arrow_id), ("h1", pa.int64()), ("h2", pa.int64())]
    )

    def find(bucket_docs: pa.Table, bucket_phrases: pa.Table) -> pa.Table:
        """Rows with hashes are windows that come first in the bucket; rows without are runs of later ones."""
        ordered = in_order(bucket_docs, "id", "text")
        if not ordered.num_rows:
            return windows_schema.empty_table()
        words = Words(ordered.column("text").to_pylist())
        places = locate(words, bucket_phrases.column("phrase").to_pylist())
        near = covered(len(words.words), np.maximum(0, places - (window - phrase)), places + 1) & words.inside(window)
        at = np.flatnonzero(near)
        h1, h2 = (words.sequences(window, k)[at].view(np.int64) for k in (0, 1))
        order = np.lexsort((at, h2, h1))
        first = np.ones(len(at), dtype=bool)
        first[1:] = (h1[order][1:] != h1[order][:-1]) | (h2[order][1:] != h2[order][:-1])
        is_first = np.zeros(len(at), dtype=bool)
        is_first[order[first]] = True
        later = np.zeros(len(words.words), dtype=bool)
        later[at[~is_first]] = True
        # Runs end with their document, as a window does not begin in its last words.
        starts, stops = runs(later)
        places, h1, h2 = at[is_first], h1[is_first], h2[is_first]
        begin = words.ends - words.counts
        all_starts = np.concatenate([places, starts])
        doc = np.searchsorted(words.ends, all_starts, side="right")
        offset = begin[doc]
        none = np.zeros(len(starts), dtype=bool)
        hashed = np.concatenate([np.ones(len(places), dtype=bool), none])
        pad = np.zeros(len(starts), np.int64)
        return pa.table(
            [
                pa.array(np.full(len(doc), ordered.column(bucket)[0].as_py(), np.int32)),
                pa.array(doc.astype(np.int32)),
                pa.array((all_starts - offset).astype(np.int32)),
                pa.array((np.concatenate([places + 1, stops]) - offset).astype(np.int32)),
                ordered.column("id").combine_chunks().take(pa.array(doc)) if ordered.num_rows else pa.array([], arrow_id),
                pa.array(np.concatenate([h1, pad]), mask=~hashed),
                pa.array(np.concatenate([h2, pad]), mask=~hashed),
            ],
            schema=windows_schema,
        )

    places = f"{bucket} int, doc int, start int, stop int"
    windows = stage(with_buckets(keys, confirmed, bucket, find, f"{places}, id {kind}, h1 long, h2 long"), "windows")
    discard(confirmed)
    by_hash = windows.where("h1 IS NOT NULL").repartition("h1", "h2")
    by_hash = by_hash.sortWithinPartitions("h1", "h2", F.col("id").asc_nulls_last(), bucket, "doc", "start")

    def not_first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None
        for batch in batches:
            if not batch.num_rows:
                continue
            h = np.stack([batch.column("h1").to_numpy(), batch.column("h2").to_numpy()])
            again = np.zeros(batch.num_rows, dtype=bool)
            again[1:] = (h[:, 1:] == h[:, :-1]).all(axis=0)
            again[0] = last is not None and bool((h[:, 0] == last).all())
            last = h[:, -1].copy()
            yield batch.select([bucket, "doc", "start", "stop"]).filter(pa.array(again))

    repeated = by_hash.mapInArrow(not_first, places)
    marks = stage(repeated.unionByName(windows.where("h1 IS NULL").select(bucket, "doc", "start", "stop")), "marks")
    discard(windows)

    out = marked.select(
        *kept,
        null("long").alias("n_words"),
        null("long").alias("n_removed"),
        null("string").alias("kept_words"),
        null("string").alias("kept_text"),
    ).schema

    def cut(bucket_docs: pa.Table, bucket_marks: pa.Table) -> pa.Table:
        ordered = in_order(bucket_docs, id_column, text)
        texts = ordered.column(text).to_pylist()
        split = [(t or "").encode().split() for t in texts]
        counts = np.fromiter(map(len, split), np.int64, len(split))
        begin = np.cumsum(counts) - counts
        offset = begin[bucket_marks.column("doc").to_numpy()] if len(texts) else np.zeros(0, np.int64)
        starts = bucket_marks.column("start").to_numpy() + offset
        stops = bucket_marks.column("stop").to_numpy() + offset + window - 1
        gone = covered(int(counts.sum()), starts, stops)
        removed = np.add.reduceat(np.append(gone, False), begin, dtype=np.int64) * (counts > 0) if len(texts) else counts
        short, whole = [], []
        for t, words, b, n in zip(texts, split, begin.tolist(), removed.tolist()):
            keep = ~gone[b : b + len(words)]
            if joined:
                short.append(b" ".join(w for w, k in zip(words, keep.tolist()) if k) if n else b" ".join(words))
            whole.append(_without(t.encode(), keep) if n else t if t is None else t.encode())
        columns = [ordered.column(c) for c in kept]
        short = short if joined else [None] * len(whole)
        columns += [pa.array(counts), pa.array(removed, pa.int64()), *(pa.array(x, pa.binary()).cast(pa.string()) for x in (short, whole))]
        return pa.table(columns, names=[*kept, *added])

    return with_buckets(marked, marks, bucket, cut, out)


def _arrow_type(df: DataFrame, column: str) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(df.schema[column].dataType)


def _without(text: bytes, keep: np.ndarray) -> bytes:
    """The kept words, each with the white space that follows it."""
    space = np.isin(np.frombuffer(text, np.uint8), np.frombuffer(b" \t\n\x0b\x0c\r", np.uint8))
    starts, _ = runs(~space)
    stops = np.append(starts[1:], len(text))
    return b"".join(text[a:b] for a, b, k in zip(starts.tolist(), stops.tolist(), keep.tolist()) if k).rstrip(b" \t\n\x0b\x0c\r")
