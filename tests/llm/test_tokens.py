"""Operators on token ids: rANS files, byte-level BPE, packing."""

import base64
import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from snapfold.llm import bpe, packing, rans
from snapfold.llm.tokens import ChunkEncoder, library_encoder
from tests.llm import corpus

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def strings(seed=3):
    rng = random.Random(seed)
    made = ["", "a" * 700, "a\x1cb\x1f c\x85 d", "  x", "é́ ​ 　 z", "😀😀 ok", "it's 12 o'clock\n", "x   y\n \nz", "<|endoftext|> hi", "Σας ΟΔΟΣ"]
    for letters in ("ab", "aab \n", "ab1 \n\t'.sé  <|>\x1c\x85　", "thereinaoust "):
        made += ["".join(rng.choice(letters) for _ in range(rng.randint(0, 50))) for _ in range(400)]
    return made


@pytest.fixture(scope="module")
def docs(spark):
    rows = [r for r in corpus.documents() if r[0] is not None] + [(1000 + i, t, "s") for i, t in enumerate(strings()[:60])]
    return spark.createDataFrame(rows, corpus.SCHEMA).repartition(3)


@pytest.mark.parametrize("name,joined", [("byte_bpe_50k.json", True), ("word_bpe_49k.json", False)])
def test_chunks_encode_like_the_library(name, joined):
    plain = Tokenizer.from_file(public_tokenizers.path(name))
    special = tuple(t.content for t in plain.get_added_tokens_decoder().values())
    assert special
    texts = [*strings(), None, *special, *(f"a {t.upper()} b{t}{t[1:]}c \n{t}" for t in special), "x<|STARTOFTEXT|>", "<| endoftext|>", "plain"]
    own = ChunkEncoder(lambda c: [plain.encode(x, add_special_tokens=False).ids for x in c], joined, most=50, whole=special)
    for encoder in (library_encoder(public_tokenizers.path(name), joined), own):
        ids, counts = encoder(pa.array(texts))
        parts = np.split(ids, np.cumsum(counts)[:-1])
        assert [p.tolist() for p in parts] == [plain.encode(t or "", add_special_tokens=False).ids for t in texts]


def test_rank_queue():
    rng = random.Random(0)
    queue, held = bpe.RankQueue(70_000), []
    for _ in range(5000):
        if held and rng.random() < 0.45:
            held.sort()
            assert queue.pop() == held.pop(0)
        else:
            held.append((rng.randrange(70_000) if rng.random() < 0.7 else 5, rng.randrange(100)))
            queue.push(*held[-1])
    assert [queue.pop() for _ in held] == sorted(held) and queue.pop() is None and not queue.buckets


def test_bpe_is_tiktokens(docs):
    pairs = bpe.byte_pairs(RANKS, public_tokenizers.PATTERN)
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    for text in [*strings(), "".join(random.Random(1).choice("abcdefgh") for _ in range(30_000))]:
        assert pairs.encode(text) == library.encode_ordinary(text)
    clash = docs.withColumn("decoded", F.lit("mine"))
    found = bpe.decode(bpe.encode(clash, RANKS, public_tokenizers.PATTERN), RANKS, public_tokenizers.PATTERN)
    texts = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    for r in found.collect():
        assert r["ids"] == library.encode_ordinary(texts[r["doc_id"]])
        assert bytes(r["decoded_"]).decode() == texts[r["doc_id"]] and r["decoded"] == "mine"
    assert bpe.encode(docs.limit(0), RANKS, public_tokenizers.PATTERN).count() == 0


def test_coder():
    rng = np.random.default_rng(0)
    tokens = np.minimum(rng.zipf(1.2, 200_000), 49_000).astype(np.uint32)
    coder = rans.Coder(*rans.frequencies(dict(zip(*(x.tolist() for x in np.unique(tokens, return_counts=True))))))
    assert int(coder.frequency.sum()) == 1 << rans.SCALE
    blocks = [tokens[:n] for n in (0, 1, 31, 32, 33, 8191, 8192, 8193, 100_000)] + [tokens[:1].repeat(20_000)]
    coded = coder.encode(blocks)
    sizes = np.array([len(b) for b in blocks])
    found = coder.decode(sizes, *zip(*coded))
    assert all(np.array_equal(a, b) for a, b in zip(found, blocks))
    words, states, at = coded[8]
    assert len(states) == 8 * rans.LANES * len(at)
    broken = bytearray(coded[8][0])
    broken[400] ^= 1
    with pytest.raises(ValueError):
        coder.decode(sizes[8:9], [bytes(broken)], [states], [at])
    with pytest.raises(ValueError):
        rans.frequencies(dict.fromkeys(range((1 << rans.SCALE) + 1), 1))


def test_token_files(spark, docs, tmp_path):
    tokenizer = public_tokenizers.path("word_bpe_49k.json")
    path = str(tmp_path / "tokens")
    rans.write_tokens(docs.withColumn("ids", F.lit(0)), path, tokenizer, end=1)
    found = sorted(rans.read_tokens(spark, path).collect(), key=lambda r: r["start"])
    plain = Tokenizer.from_file(tokenizer)
    ids_of = {r["doc_id"]: [*plain.encode(r["text"] or "", add_special_tokens=False).ids, 1] for r in docs.collect()}
    at = 0
    assert [r["doc_id"] for r in found] == sorted(r["doc_id"] for r in docs.collect())
    for r in found:
        assert r["start"] == at and np.frombuffer(r["ids"], "<u4").tolist() == ids_of[r["doc_id"]]
        at += r["n_tokens"]
    rans.write_tokens(docs.limit(0), str(tmp_path / "none"), tokenizer, end=1)
    assert rans.read_tokens(spark, str(tmp_path / "none")).count() == 0


def test_open_bins_keep_sums_of_squares_small():
    rng = random.Random(0)
    bins, room = packing.OpenBins(50), {}
    for _ in range(800):
        size = rng.randint(1, 50)
        counts = np.bincount([g for g in room.values() if g], minlength=51)

        def after(gap, counts=counts, size=size):
            c = counts.copy()
            if gap < 50:
                c[gap] -= 1
            if gap > size:
                c[gap - size] += 1
            return int((c[1:50] ** 2).sum())

        best = min(after(g) for g in {50, *(g for g in room.values() if g >= size)})
        number, offset = bins.place(size)
        gap = room.get(number, 50)
        assert offset == 50 - gap and gap >= size and after(gap) == best
        room[number] = gap - size


def test_packing(docs):
    tokenizer = public_tokenizers.path("byte_bpe_50k.json")
    found = packing.packed_documents(docs, tokenizer, length=128, with_ids=True).collect()
    plain = Tokenizer.from_file(tokenizer)
    sequences, pieces = {}, {}
    for r in found:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
        pieces.setdefault(r["doc_id"], []).append(r)
        assert r["ids_crc32"] == zlib.crc32(np.array(r["ids"], "<u4").tobytes()) and len(r["ids"]) == r["length"]
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 128
    copies = {r["doc_id"]: 0 for r in found}
    for r in docs.collect():
        copies[r["doc_id"]] += 1
    for r in docs.collect():
        ids = [*plain.encode(r["text"] or "", add_special_tokens=False).ids, 0]
        own = sorted(pieces[r["doc_id"]], key=lambda p: (p["piece"], p["sequence_id"]))[:: copies[r["doc_id"]]]
        assert [x for p in own for x in p["ids"]] == ids and all(p["length"] == 128 for p in own[1:])
    total = sum(r["length"] for r in found)
    assert len(sequences) <= 1.1 * total / 128 + 1
    assert packing.packed_documents(docs.limit(0), tokenizer).count() == 0
