"""Whitening, centroid clustering and sharding against plain computations."""

import hashlib
import math
import random
import zlib
from collections import Counter
from decimal import Decimal

import numpy as np
import pytest
from pyspark.sql import functions as F

from snapfold.llm import clustering, sharding, whitening
from tests.llm import corpus

VECTORS = "vec_id long, embedding array<float>, label int, Whitened string, Cluster string, _x int, _place int"


def vectors(width=64, rows=150, seed=3):
    """Clustered vectors with copies (a third of all rows one vector), ties, and all that is left out."""
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(6, width)) * 0.2
    found = [(i, (centres[i % 6] + rng.normal(size=width) * 0.05).astype(np.float32).tolist()) for i in range(rows)]
    found += [(1000 + i, found[7][1]) for i in range(rows // 2)]
    found += [(None, found[8][1]), (5, found[5][1]), (5, found[5][1])]
    out = [None, [], [None] * width, [float("nan")] + [0.0] * (width - 1), [float("inf")] * width, [1e30] * width, [0.1] * (width - 1)]
    found += [(2000 + i, v) for i, v in enumerate(out)]
    return [(i, v, 1, "old", "old", 0, 0) for i, v in found], len(out)


def plain_whitening(usable):
    """Fitted rows, deviations, eigenvalues and projections by numpy."""
    whole = [tuple(math.floor(64 * c) + 1_000_000 for c in v) for v in usable]
    fit = sorted(set(whole))
    n, total = len(fit), [sum(c) for c in zip(*fit)]
    deviation = [sum((n * a - s) ** 2 for a, s in zip(x, total)) for x in whole]
    centred = np.array([[(n * a - s) / n for a, s in zip(x, total)] for x in fit])
    values, axes = np.linalg.eigh(centred.T @ centred / n)
    order = np.argsort(-values)
    rows = np.array([[(n * a - s) / n for a, s in zip(x, total)] for x in whole])
    return n, deviation, values[order], rows @ axes[:, order], values.sum()


@pytest.mark.parametrize("cells, panel", [(whitening.BLOCK_CELLS, whitening.PANEL_BLOCKS), (64 * 16, 4)])
def test_whitening(spark, cells, panel):
    rows, left_out = vectors()
    frame = spark.createDataFrame(rows, VECTORS).repartition(5)
    found = whitening.whiten(frame, block_cells=cells, panel_blocks=panel)
    assert found.rows.columns == ["vec_id", "label", "Cluster", "_x", "_place", "whitened", "deviation"]
    got = sorted(((r["vec_id"] is None, r["vec_id"] or 0, int(r["deviation"]), tuple(r["whitened"])) for r in found.rows.collect()))
    usable = [r for r in rows if r[1] and len(r[1]) == 64 and r[0] not in range(2000, 2000 + left_out)]
    n, deviation, values, projected, trace = plain_whitening([r[1] for r in usable])
    assert found.fitted == n == 150 and len(got) == len(usable) and found.identity_error < 1e-9
    assert np.allclose(found.eigenvalues, values[:16], rtol=1e-10) and np.allclose(found.explained, values[:16] / trace, rtol=1e-10)
    expected = sorted((r[0] is None, r[0] or 0, d, tuple(p[:16] / np.sqrt(values[:16]))) for r, d, p in zip(usable, deviation, projected))
    assert [g[:3] for g in got] == [e[:3] for e in expected]
    a, b = np.array([g[3] for g in got]), np.array([e[3] for e in expected])
    signs = np.sign((a * b).sum(axis=0))  # one sign for a component and all rows
    assert np.abs(a - b * signs).max() < 1e-8


def test_whitening_of_few_vectors(spark):
    def made(values):
        return spark.createDataFrame([(i, v) for i, v in enumerate(values)], "vec_id long, embedding array<double>")

    assert whitening.whiten(made([])).rows.count() == 0
    assert whitening.whiten(made([None, []])).rows.count() == 0
    alone = whitening.whiten(made([[0.5, 2.0]] * 3))
    assert (alone.fitted, alone.eigenvalues) == (1, []) and [tuple(r)[1:] for r in alone.rows.collect()] == [([], Decimal(0))] * 3
    # Two points vary along one axis alone; of two as frequent lengths the longer counts.
    line = whitening.whiten(made([[0.0, 1.0], [1.0, 1.0], [7.0], [8.0]]))
    assert line.fitted == 2 and line.explained == [1.0] and sorted(abs(r["whitened"][0]) for r in line.rows.collect()) == [1.0, 1.0]
    # Deviations beyond 64 bits are exact as well.
    far = whitening.whiten(made([[2.0**40, 0.0], [-(2.0**40), 0.25], [0.0, 0.0]]))
    n, deviation, values, _, _ = plain_whitening([[2.0**40, 0.0], [-(2.0**40), 0.25], [0.0, 0.0]])
    assert sorted(int(r["deviation"]) for r in far.rows.collect()) == sorted(deviation) and far.fitted == n
    centre = whitening.Centre(1 << 30, [1 << 60, -5], 1 << 40)
    x = np.array([[1 << 40, -(1 << 39)]], dtype=np.int64)
    assert centre.deviations(x).tolist() == [[(1 << 70) - (1 << 60), -(1 << 69) + 5]]
    assert centre.squares(x) == [((1 << 70) - (1 << 60)) ** 2 + ((1 << 69) - 5) ** 2]


def plain_clusters(usable, count=40, rounds=5):
    whole = [(i, tuple(math.floor(256 * c) for c in v)) for i, v in usable]
    digest = {i: "~" if i is None else hashlib.sha256(f"2:{i}".encode()).hexdigest() for i, _ in whole}
    centroids = [v for _, v in sorted(whole, key=lambda r: (digest[r[0]], r[1]))][:count]

    def assign(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), k) for k, c in enumerate(centroids))

    for _ in range(rounds):
        held = [assign(v)[1] for _, v in whole]
        for k in set(held):
            mine = [v for (_, v), h in zip(whole, held) if h == k]
            centroids[k] = tuple(sum(c) // len(mine) for c in zip(*mine))
    return [(i, *assign(v)[::-1]) for i, v in whole], centroids


def test_clusters(spark):
    rows, left_out = vectors()
    rows += [(3000 + i, [0.01 * i] * 63 + [5e5], 1, "", "", 0, 0) for i in range(3)]  # values far apart
    found = clustering.cluster(spark.createDataFrame(rows, VECTORS).repartition(5))
    assert found.rows.columns == ["vec_id", "label", "Whitened", "_x", "_place", "cluster", "distance"]
    usable = [r[:2] for r in rows if r[0] not in range(2000, 2000 + left_out)]
    expected, centroids = plain_clusters(usable)
    got = [(r["vec_id"], r["cluster"], r["distance"]) for r in found.rows.collect()]
    assert Counter(got) == Counter(expected)
    known = {r["cluster"]: r for r in found.centroids.collect()}
    assert [tuple(known[k]["centroid"]) for k in range(40)] == centroids
    assert {k: (r["vectors"], int(r["inertia"])) for k, r in known.items()} == {
        k: (sum(c == k for _, c, _ in expected), sum(d for _, c, d in expected if c == k)) for k in range(40)
    }
    assert any(r["vectors"] == 0 for r in known.values())  # equal centroids: the later one is empty and stays


def test_few_vectors_to_cluster(spark):
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert clustering.cluster(empty).rows.count() == clustering.cluster(empty).centroids.count() == 0
    few = spark.createDataFrame([(1, [0.5, -0.5]), (2, [0.5, 0.5]), (3, [0.5])], "vec_id long, embedding array<float>")
    found = clustering.cluster(few, width=2)
    assert sorted(r["distance"] for r in found.rows.collect()) == [0, 0] and found.centroids.count() == 2


def test_lookup():
    for values in ([5], [3, -2, 3], [10**12, -(10**12), 0, 0]):
        occurring, place = clustering.lookup(np.array(values))
        assert occurring.tolist() == sorted(set(values)) and occurring[place].tolist() == values


def least_capacity(sizes, shards):
    """Smallest largest sum of a cut of ``sizes`` into at most so many runs, over all cuts."""
    ends = [0]
    for s in sizes:
        ends.append(ends[-1] + s)
    best = ends[:]
    for _ in range(shards - 1):
        best = [min(max(best[j], e - ends[j]) for j in range(i + 1)) for i, e in enumerate(ends)]
    return best[-1]


@pytest.mark.parametrize("cells", [sharding.CELLS, 8, 1])
def test_shards(spark, cells):
    rng = random.Random(4)
    rows = corpus.documents(3) + [(2000 + i, corpus.sentence(rng, rng.choice((1, 5, 80))), "web") for i in range(250)]
    rows += [(5000 + i, rows[-1][1] * 10, "copies") for i in range(120)]
    docs = spark.createDataFrame(rows, corpus.SCHEMA).repartition(6).withColumns({"SHARD": F.lit("old"), "_key": F.lit("mine")})
    placed = sharding.minimax_shards(docs, 9, cells=cells, piece_rows=7)
    assert placed.columns == ["doc_id", "text", "source", "_key", "size", "text_crc32", "shard", "slot"]
    found = placed.withColumn("h", F.xxhash64("text")).collect()
    assert Counter((r["doc_id"], r["text"], r["source"]) for r in found) == Counter(rows)
    for r in found:
        body = (r["text"] or "").encode()
        assert (r["size"], r["text_crc32"]) == (len(body) + 16, zlib.crc32(body))
    for k in range(9):
        assert sorted(r["slot"] for r in found if r["shard"] == k) == list(range(sum(r["shard"] == k for r in found)))
    of = {}
    for r in found:
        assert of.setdefault(r["text"], r["shard"]) == r["shard"]
    groups = Counter()
    for r in found:
        groups[r["h"]] += r["size"]
    loads = Counter()
    for r in found:
        loads[r["shard"]] += r["size"]
    # Groups above the mean of what is left stand alone; the others are cut at the smallest capacity there is.
    rest, alone = sum(groups.values()), []
    for h, s in sorted(groups.items(), key=lambda g: (-g[1], g[0]))[:8]:
        if s * (9 - len(alone)) <= rest:
            break
        alone.append(s)
        rest -= s
        groups.pop(h)
    assert alone and [loads[k] for k in range(len(alone))] == alone
    others = [loads[k] for k in range(len(alone), 9)]
    assert max(others) == least_capacity([s for _, s in sorted(groups.items())], 9 - len(alone))
    assert min(others) > 0


def test_capacity_is_exact_whatever_the_cells(spark):
    rng = random.Random(1)
    for shards in (1, 2, 5, 30):
        keys = sorted({rng.getrandbits(64) - (1 << 63) for _ in range(400)})
        sizes = {k: rng.choice((1, 3, 50, 400)) for k in keys}
        groups = spark.createDataFrame(list(sizes.items()), "key long, size long")
        cuts = sharding.minimax_cuts(groups, "key", "size", shards, cells=16)
        loads = Counter()
        for k, s in sizes.items():
            loads[sum(c <= k for c in cuts)] += s
        assert max(loads.values()) == least_capacity([sizes[k] for k in sorted(sizes)], shards) and len(loads) == shards


def test_shards_of_little(spark):
    assert sharding.minimax_shards(spark.createDataFrame([], corpus.SCHEMA)).count() == 0
    few = spark.createDataFrame([(1, "a", "s"), (1, "a", "s"), (None, None, None), (2, "", "s")], corpus.SCHEMA)
    placed = {(r["doc_id"], r["slot"]): r["shard"] for r in sharding.minimax_shards(few, 3).collect()}
    assert len(placed) == 4 and placed[1, 0] == placed[1, 1] and len(set(placed.values())) == 3
    assert {r["shard"] for r in sharding.minimax_shards(few, 1).collect()} == {0}


def test_written_shards(spark, tmp_path):
    docs = spark.createDataFrame(corpus.documents(5), corpus.SCHEMA)
    placed = sharding.minimax_shards(docs, 4)
    sharding.write_shards(placed, str(tmp_path / "shards"))
    back = spark.read.parquet(str(tmp_path / "shards"))
    assert Counter(map(tuple, back.select(*placed.columns).collect())) == Counter(map(tuple, placed.collect()))
    assert {p.name for p in (tmp_path / "shards").glob("shard=*")} == {f"shard={k}" for k in range(4)}


def test_cells_come_as_columns(spark, monkeypatch):
    """The driver holds no row object for each cell."""
    groups = spark.range(200).selectExpr("xxhash64(id) AS key", "id % 7 + 1 AS size")
    cuts = sharding.minimax_cuts(groups, "key", "size", 5, 8)
    monkeypatch.setattr(type(groups), "collect", None)
    assert sharding.minimax_cuts(groups, "key", "size", 5, 8) == cuts and len(cuts) == 4
