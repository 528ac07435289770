"""Operators on words: quality rules, SimHash, repeated phrases, and the pipeline."""

import zlib

import numpy as np
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
import public_tokenizers
from snapfold.llm import components, decisions, phrases, simhash
from snapfold.llm.buckets import minimizers
from tests.conftest import plan
from tests.llm import corpus


@pytest.fixture(scope="module")
def rows():
    return corpus.documents()


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, corpus.SCHEMA).repartition(3)


def key(row):
    return (row[0] is None, row[0] or 0, row[1] is None, row[1] or "")


def test_stats(docs, rows):
    clash = docs.withColumns({"n_words": F.lit("x"), "_words": F.lit(1), "_Hashes": F.lit(2)})
    found = decisions.document_stats(clash)
    got = sorted(((r["doc_id"], r["text"]), tuple(r[n] for n in decisions.STATS)) for r in found.where("doc_id IS NOT NULL AND text IS NOT NULL").collect())
    assert got == sorted(((r[0], r[1]), corpus.stats(r[1])) for r in rows if r[0] is not None and r[1] is not None)
    nothing = found.where("text IS NULL").select(*decisions.STATS).distinct().collect()
    assert [tuple(r) for r in nothing] == [(0, 0, 0, 0, 0)]
    assert {"_words", "_Hashes", "source"} <= set(found.columns) and found.count() == len(rows)
    for unwanted in ("Python", "Pandas", "Arrow", "Exchange hashpartitioning"):
        assert unwanted not in plan(decisions.document_stats(docs))


def test_rules(spark):
    made = [(i, 200, 1000 + i % 7, (i % 5 == 0) * (3 + i % 11), 0, (i % 17 == 0) * 150) for i in range(3000)]
    stats = spark.createDataFrame(made, "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long")
    labels = spark.createDataFrame(
        [(r[0], int(not (r[3] > 2 or r[5] > 100))) for r in made] + [(None, 0), (1, None), (9999, 0), (0, 0)], "doc_id long, quality int"
    )
    rules = decisions.learn_rules(stats, labels)
    found = stats.select((rules.keep() == ~((F.col("n_symbols") > 2) | (F.col("n_repeat_words") > 100))).alias("right"))
    assert found.where("right").count() == len(made) and len(rules.rules) >= 2 and "reject if" in str(rules)
    assert rules == decisions.learn_rules(stats.repartition(5), labels.repartition(3))
    empty = decisions.learn_rules(stats, labels.limit(0))
    assert empty.rules == () and stats.where(empty.keep()).count() == len(made)
    assert decisions.learn_rules(stats.limit(0), labels).rules == ()


def test_fingerprints(docs, rows):
    found = simhash.near_duplicates(docs).collect()
    assert len(found) == len(rows)
    for r in found:
        w = corpus.words(corpus.lowered(r["text"]))
        shingles = [" ".join(w[i : i + 4]) for i in range(max(1, len(w) - 3))] if w else []
        hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
        assert int(r["fingerprint"], 16) == sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
    codes = [int(r["fingerprint"], 16) for r in found]
    pairs = [(i, j) for i in range(len(codes)) for j in range(i) if (codes[i] ^ codes[j]).bit_count() <= 4]
    group = corpus.roots(len(codes), pairs)
    for g in set(group):
        members = [r for r, x in zip(found, group) if x == g]
        ids = [r["doc_id"] for r in members if r["doc_id"] is not None]
        assert {r["component_id"] for r in members} == {min(ids, default=None)}
        assert sum(r["representative"] for r in members) == 1


@pytest.mark.parametrize("unit_rows", [1 << 14, 40])
def test_trie_links(spark, unit_rows):
    rng = np.random.default_rng(1)
    codes = set(rng.integers(0, 2**64, 300, dtype=np.uint64).tolist())
    for c in sorted(codes)[:120]:
        for _ in range(5):
            codes.add(c ^ sum(1 << int(b) for b in set(rng.integers(0, 64, rng.integers(1, 7)))))
    low = 0xFFFF << 40
    codes |= {low ^ (1 << a) ^ (1 << b) for a in range(20) for b in range(a)}  # a dense group
    codes = sorted(c - (1 << 64) if c >> 63 else c for c in codes)
    links = simhash.fingerprint_links(spark.createDataFrame([(c,) for c in codes], "f long"), unit_rows=unit_rows)
    got = {r["node"]: r["component"] for r in components.components(links).collect()}
    masked = np.array(codes, dtype=np.int64).view(np.uint64)
    i, j = np.nonzero(np.bitwise_count(masked[:, None] ^ masked[None, :]) <= 4)
    want = corpus.roots(len(codes), zip(i.tolist(), j.tolist()))
    assert [got.get(c, c) for c in codes] == [codes[k] for k in want]


def test_components(spark):
    chain = [(i, i + 1) for i in range(60)] + [(200, k) for k in range(201, 260)] + [(7, 7), (7, 8), (8, 7), (None, 3)]
    found = components.components(spark.createDataFrame(chain, "a long, b long").repartition(4))
    assert {(r["node"], r["component"]) for r in found.collect()} == {(i, 0) for i in range(61)} | {(i, 200) for i in range(200, 260)}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_minimizers():
    values = np.random.default_rng(0).integers(0, 20, 400).astype(np.uint64)
    valid = np.arange(400) % 50 < 40
    for width in (1, 2, 3, 7, 13):
        want = {i + j for i in range(400 - width + 1) if valid[i] for j in range(width) if values[i + j] == values[i : i + width].min()}
        assert minimizers(values, width, valid).tolist() == sorted(want)


def test_repeated_phrases(docs, rows):
    clash = docs.withColumns({"_bucket": F.lit("b"), "N_words": F.lit("old")})
    found = phrases.remove_repeats(clash)
    assert found.columns == ["doc_id", "text", "source", "_bucket", "n_words", "n_removed", "kept_words", "kept_text"]
    got = sorted(((r["doc_id"], r["text"]), (r["n_words"], r["n_removed"], r["kept_words"])) for r in found.where("doc_id IS NOT NULL AND text IS NOT NULL").collect())
    want = sorted(
        ((r[0], r[1]), (len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone)))
        for r, w, gone in corpus.without_repeats(rows)
        if r[0] is not None and r[1] is not None
    )
    assert got == want and sum(n for _, (_, n, _) in got) > 400
    for r in found.collect():
        assert corpus.words(r["kept_text"]) == corpus.words(r["kept_words"])
        assert r["n_removed"] or r["kept_text"] == r["text"]
    unjoined = phrases.remove_repeats(clash, joined=False)
    assert unjoined.drop("kept_words").exceptAll(found.drop("kept_words")).isEmpty() and unjoined.where("kept_words IS NOT NULL").isEmpty()
    assert phrases.remove_repeats(docs.limit(0)).count() == 0


def test_pipeline(spark, tmp_path, rows):
    """run() against all four stages done plainly; the learned rules come from the operator, which has its own tests."""
    known = [r for r in rows if r[0] is not None]
    documents = spark.createDataFrame(known, corpus.SCHEMA).withColumns({"n_words": F.lit(-1), "representative": F.lit(False), "row": F.lit("r")})
    documents.write.parquet(str(tmp_path / "documents.parquet"))
    labels = [(r[0], int("#" not in (r[1] or ""))) for r in known]
    spark.createDataFrame(labels, "doc_id long, quality int").write.parquet(str(tmp_path / "labels.parquet"))
    left = []
    for r in known:
        n, _, _, _, repeated = corpus.stats(r[1])
        if n >= 10 and 100 * repeated <= 20 * n:
            left.append(r)
    codes = [simhash.fingerprint(r[1], 4) for r in left]
    group = corpus.roots(len(left), [(i, j) for i in range(len(left)) for j in range(i) if (codes[i] ^ codes[j]).bit_count() <= 4])
    left = [min((left[i] for i in range(len(left)) if group[i] == g), key=key) for g in sorted(set(group))]
    ends = {r[0]: len(w) - len(gone) for r, w, gone in corpus.without_repeats(left)}
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    for name, function in corpus_pipeline.STAGES[:-1]:
        docs = function(spark, docs, str(tmp_path))
        assert docs.columns == documents.columns, name
    assert {r["doc_id"]: len(corpus.words(r["text"])) for r in docs.collect()} == ends
    packed = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r["doc_id"] for r in packed} == set(ends)


def test_pipeline_keeps_columns_of_any_type(spark, tmp_path):
    """Maps, arrays and structs, with names that operators use as well, come through all stages."""
    rows = [r for r in corpus.documents(6) if r[0] is not None]
    documents = spark.createDataFrame(rows, corpus.SCHEMA).withColumns(
        {
            "fingerprint": F.create_map(F.lit("k"), F.col("doc_id")),
            "n_words": F.array(F.create_map(F.lit(1), F.lit("v"))),
            "kept_text": F.struct(F.lit(1).alias("a.b"), F.create_map(F.lit("x"), F.lit(None).cast("string")).alias("m")),
            "a.b": F.lit(1.5),
        }
    )
    documents.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(r[0], 1) for r in rows], "doc_id long, quality int").write.parquet(str(tmp_path / "labels.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    for name, function in corpus_pipeline.STAGES[:-1]:
        docs = function(spark, docs, str(tmp_path))
        assert docs.dtypes == documents.dtypes, name
    for r in docs.collect():
        assert r["fingerprint"] == {"k": r["doc_id"]} and r["n_words"] == [{1: "v"}] and r["kept_text"]["m"] == {"x": None} and r["a.b"] == 1.5
    assert 0 < corpus_pipeline.run(spark, str(tmp_path)).count()


def test_pipeline_packs_every_piece(spark, tmp_path):
    """run() against a plain tokenise-and-cut of the texts that the stages before the last one leave."""
    rows = [r for r in corpus.documents(4, copies=False) if r[0] is not None]
    spark.createDataFrame(rows, corpus.SCHEMA).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(r[0], 1) for r in rows], "doc_id long, quality int").write.parquet(str(tmp_path / "labels.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    for _, function in corpus_pipeline.STAGES[:-1]:
        docs = function(spark, docs, str(tmp_path))
    plain = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = []
    for r in docs.collect():
        ids = [*plain.encode(r["text"] or "", add_special_tokens=False).ids, 0]
        short = (len(ids) - 1) % 2048 + 1  # only the first piece may be shorter
        cut = [ids[:short], *(ids[k : k + 2048] for k in range(short, len(ids), 2048))]
        want += [(r["doc_id"], k, len(p), zlib.crc32(np.array(p, "<u4").tobytes())) for k, p in enumerate(cut)]
    packed = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert sorted((r["doc_id"], r["piece"], r["length"], r["ids_crc32"]) for r in packed) == sorted(want)
    assert any(piece for _, piece, _, _ in want)
    sequences = {}
    for r in packed:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in sequences.values():
        ends = [0, *(o + n for o, n in sorted(parts))]
        assert [o for o, _ in sorted(parts)] == ends[:-1] and ends[-1] <= 2048
