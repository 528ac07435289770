"""Token ids of whole texts, each distinct chunk of text encoded once per worker.

Both tokenizer families here treat text between white space alike wherever it
stands, so a batch is split into chunks with Arrow, the chunks are dictionary
encoded, and only chunks not seen before go to the tokenizer.  A text's ids are
gathered from the chunks' ids.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Callable
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Fixed value: the characters that tokenizer patterns may count as white space.
SPACES = "\t-\r \x1c-\x1f\x85\xa0 ᠎ -​    　"
#: Texts where white space is more than single spaces and line feeds.
IRREGULAR = "[ \n]{2}|[\x01\t\x0b-\r\x1c-\x1f\x85\xa0 ᠎ -​    　]"
#: White space as the tokenizers' own patterns see it (Unicode White_Space).
WHITE = "\t-\r \x85\xa0  -     　"
#: ASCII marks at the end of a word, which both families' patterns keep apart from the letter or digit before them.
MARKS = r"([A-Za-z0-9À-ÖØ-öø-ÿ])([!-&(-/:-@\[-`{-~]+)( |$)"
#: Goes before marks cut off a word, which follow no space.
CUT = "\x01"
CHUNK = re.compile(f" ?[^{WHITE}]+|[{WHITE}]+(?![^{WHITE}])|[{WHITE}]+")


class ChunkEncoder:
    """Encodes lists of texts; ``encode`` maps distinct chunks to their id lists.

    ``joined``: a space belongs to the word after it (byte-level patterns);
    otherwise white space separates words and leaves no ids.  The cache is
    emptied when it holds ``most`` chunks, which bounds memory.  Texts with one of the
    strings ``whole`` in them, in any case, are encoded as they are.  With ``lower`` the
    encoder makes no difference between cases (of words without a space of their own).
    """

    def __init__(self, encode: Callable[[list[str]], list], joined: bool, most: int = 800_000, whole: tuple[str, ...] = (), lower: bool = False):
        self.encode, self.joined, self.most, self.lower = encode, joined, most, lower
        self.whole = "|".join(map(re.escape, whole))
        self._reset()

    def _reset(self) -> None:
        # Chunks that follow a space, without it, and chunks as they are.
        self.spaced: dict[str, int] = {}
        self.plain: dict[str, int] = {}
        self.starts = np.zeros(1 << 12, np.int64)
        self.lengths = np.zeros(1 << 12, np.int64)
        self.ids = np.zeros(1 << 14, np.uint32)
        self.used = 0

    def _entries(self, spaced: list[str], plain: list[str]) -> np.ndarray:
        """Places in the tables of ids, first of the chunks after a space, then of the plain ones."""
        found = [*map(self.spaced.get, spaced), *map(self.plain.get, plain)]
        if None not in found:
            return np.array(found, dtype=np.int64)
        if len(self.spaced) + len(self.plain) + found.count(None) > self.most:
            self._reset()
            found = [None] * len(found)
        split = len(spaced)
        for known, chunks, prefix, given in ((self.spaced, spaced, " ", found[:split]), (self.plain, plain, "", found[split:])):
            new = list(dict.fromkeys(c for c, at in zip(chunks, given) if at is None))
            for at in range(0, len(new), 4096):
                part = new[at : at + 4096]
                self._learn(known, part, [_spoken(c) for c in part] if prefix else part)
        # Only those just learned are looked up again.
        for i, at in enumerate(found):
            if at is None:
                found[i] = self.spaced[spaced[i]] if i < split else self.plain[plain[i - split]]
        return np.array(found, dtype=np.int64)

    def _learn(self, known: dict[str, int], keys: list[str], chunks: list[str]) -> None:
        lists = self.encode(chunks)
        lengths = np.fromiter(map(len, lists), np.int64, len(lists))
        flat = np.array([i for ids in lists for i in ids], dtype=np.uint32)
        first, end = len(self.spaced) + len(self.plain), self.used + len(flat)
        self.ids = _grown(self.ids, end)
        self.starts, self.lengths = _grown(self.starts, first + len(keys)), _grown(self.lengths, first + len(keys))
        self.ids[self.used : end] = flat
        self.starts[first : first + len(keys)] = self.used + np.cumsum(lengths) - lengths
        self.lengths[first : first + len(keys)] = lengths
        known.update(zip(keys, range(first, first + len(keys))))
        self.used = end

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row (unsigned 32 bit) and the number of ids of each text."""
        texts = pc.fill_null(texts, "")
        if not self.whole:
            return self._chunked(texts)
        marked = pc.match_substring_regex(texts, self.whole, ignore_case=True)
        at = np.flatnonzero(marked.to_numpy(zero_copy_only=False))
        if not len(at):
            return self._chunked(texts)
        ids, counts = self._chunked(pc.if_else(marked, "", texts))
        ends = np.cumsum(counts)
        parts, before = [], 0
        for i, own in zip(at.tolist(), self.encode(texts.take(pa.array(at)).to_pylist())):
            parts += [ids[before : ends[i]], np.array(own, dtype=np.uint32)]
            before, counts[i] = ends[i], len(own)
        return np.concatenate([*parts, ids[before:]]), counts

    def _chunked(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The same by chunks."""
        odd = np.zeros(0, np.int64)
        if self.joined:
            irregular = pc.match_substring_regex(texts, IRREGULAR)
            odd = np.flatnonzero(irregular.to_numpy(zero_copy_only=False))
            regular = pc.replace_substring(pc.if_else(irregular, "", texts), "\n", " \n")
            regular = pc.replace_substring_regex(regular, MARKS, rf"\1 {CUT}\2\3")
        else:
            regular = pc.replace_substring(pc.ascii_lower(texts) if self.lower else texts, "\n", " ")
            regular = pc.replace_substring_regex(regular, MARKS, r"\1 \2\3")
        lists = pc.split_pattern(regular, " ")
        offsets = lists.offsets.to_numpy() - lists.offsets[0].as_py()
        coded = lists.flatten().dictionary_encode()
        words = coded.dictionary.to_pylist()
        codes = coded.indices.to_numpy()
        firsts = [words[c] for c in codes[offsets[:-1]].tolist()] if self.joined else []
        rest = [CHUNK.findall(t) for t in texts.take(pa.array(odd)).to_pylist()]
        odd_chunks = [c for chunks in rest for c in chunks]
        found = self._entries(words, [*firsts, *odd_chunks]) if self.joined else self._entries([], words)
        entries = found[: len(words)][codes]
        if self.joined:
            entries[offsets[:-1]] = found[len(words) : len(words) + len(firsts)]
        if len(odd):  # each irregular text has one empty chunk so far; its own chunks take that place
            counts = np.diff(offsets)
            own = np.split(found[len(words) + len(firsts) :], np.cumsum([len(c) for c in rest])[:-1])
            parts, at = [], 0
            for i, entry in zip(odd.tolist(), own):
                parts += [entries[at : offsets[i]], entry]
                at, counts[i] = offsets[i] + 1, len(entry)
            entries = np.concatenate([*parts, entries[at:]])
            offsets = np.concatenate([[0], np.cumsum(counts)])
        lengths = self.lengths[entries]
        ends = np.cumsum(lengths)
        ids = self.ids[np.repeat(self.starts[entries] - (ends - lengths), lengths) + np.arange(ends[-1] if len(ends) else 0)]
        bounds = np.concatenate([[0], ends])[offsets]
        return ids, np.diff(bounds)


def _spoken(chunk: str) -> str:
    """A chunk that followed a space in the text as split, with that space where the text itself has it."""
    if chunk[:1] == CUT:
        return chunk[1:]
    return chunk if chunk[:1] == "\n" else f" {chunk}"


def _grown(array: np.ndarray, size: int) -> np.ndarray:
    if size <= len(array):
        return array
    larger = np.zeros(max(size, 2 * len(array)), array.dtype)
    larger[: len(array)] = array
    return larger


@lru_cache(maxsize=2)
def library_encoder(path: str, joined: bool) -> ChunkEncoder:
    """An encoder over a ``tokenizers`` file, one per worker process.

    None of the special tokens is added; their strings in a text are what the library makes of them.
    """
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    special = tuple(t.content for t in tokenizer.get_added_tokens_decoder().values())

    def encode(chunks: list[str]) -> list[list[int]]:
        return [e.ids for e in tokenizer.encode_batch_fast(chunks, add_special_tokens=False)]

    return ChunkEncoder(encode, joined, whole=special, lower="Lowercase" in str(json.loads(tokenizer.to_str())["normalizer"]))


def vocabulary_size(path: str) -> int:
    """Number of ids of a ``tokenizers`` file, those of special tokens included."""
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path).get_vocab_size()


def with_end(ids: np.ndarray, counts: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    """The same ids with ``end`` after each text, and the new counts."""
    counts = counts + 1
    out = np.full(int(counts.sum()), end, dtype=np.uint32)
    is_id = np.ones(len(out), dtype=bool)
    is_id[np.cumsum(counts) - 1] = False
    out[is_id] = ids
    return out, counts
