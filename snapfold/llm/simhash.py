"""Near-duplicates by SimHash fingerprints, linked with a self-join of a binary trie.

Fingerprints within the error budget of each other agree on at least one of
``budget + 1`` runs of bits.  Each run in turn is rotated to the top and is the
root of a trie, so all links of a trie lie below one node.  Inside a task the
tries are intervals of one sorted array; pairs of nodes descend together, add
up the bits in which they differ, and are dropped as soon as the budget is
spent.  A trie that is too large for one task is cut into pairs of its own
nodes first, by the same rule.  A task reports a spanning forest of the links
it finds, not the pairs, and components join the forests.

Defined edge cases: a null or blank text has fingerprint zero and links like
any other; equal rows have equal fingerprints; a null id takes part, and is
the representative only where no row of its component has an id.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapfold.llm.common import batch_of, free_name, slices, slots, stage
from snapfold.llm.components import components

BITS = 64
#: Fixed value: the seed of the shingle hash.
SEED = 42


def fingerprint(text: str | None, shingle: int, votes: float = 0.5) -> int:
    """Bit k is set if it is set in more than ``votes`` of the hashes of all shingles, repeats included."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    begins = (ends - np.fromiter(map(len, words), np.int64, len(words)) - 1).tolist()
    if len(words) > shingle:
        spans = zip(begins[: len(words) - shingle + 1], (ends[shingle - 1 :] - 1).tolist())
    else:
        spans = [(0, len(joined))]
    hash_of = xxhash.xxh64_intdigest
    hashes = np.array([hash_of(joined[i:j], SEED) for i, j in spans], dtype=">u8")
    ones = np.zeros(BITS, dtype=np.int64)
    for at in range(0, len(hashes), 1 << 16):
        part = hashes[at : at + (1 << 16)]
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones > votes * len(hashes)).tobytes(), "big")


def with_fingerprints(docs: DataFrame, text: str = "text", shingle: int = 4, name: str = "fingerprint") -> DataFrame:
    """``docs`` with the fingerprint as a signed long; every row is read once, no shuffle."""
    schema = docs.select("*", F.lit(0).cast("long").alias(name)).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text):
            found = np.array([fingerprint(t, shingle) for t in batch.column(text).to_pylist()], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found.view(np.int64))], names=[*batch.schema.names, name])

    return docs.mapInArrow(run, schema)


def fingerprint_links(prints: DataFrame, budget: int = 4, unit_rows: int = 1 << 14) -> DataFrame:
    """Edges ``(u, v)`` that connect all fingerprints within ``budget`` bits of each other, directly or through others.

    ``prints``: one column of distinct signed longs.  ``unit_rows`` is how many
    fingerprints one trie may hold before it is cut.
    """
    (column,) = prints.columns
    runs = budget + 1
    edges_of = [round(k * BITS / runs) for k in range(runs + 1)]
    code = F.col(column)

    def rotated(k: int):
        return F.shiftleft(code, edges_of[k]).bitwiseOR(F.shiftrightunsigned(code, BITS - edges_of[k])) if edges_of[k] else code

    tries = [
        F.struct(
            F.lit(k).alias("run"),
            F.shiftrightunsigned(rotated(k), BITS - (edges_of[k + 1] - edges_of[k])).alias("a"),
            F.shiftrightunsigned(rotated(k), BITS - (edges_of[k + 1] - edges_of[k])).alias("b"),
            F.lit(edges_of[k + 1] - edges_of[k]).alias("depth"),
            rotated(k).alias("code"),
        )
        for k in range(runs)
    ]
    units = stage(prints.select(F.explode(F.array(*tries)).alias("t")).select("t.*"), "trie-units")
    done = None
    step = 4
    near = {e: [m for m in range(1 << step) if m.bit_count() <= e] for e in range(budget + 1)}
    while True:
        # A unit is a pair of nodes (a, b) of one depth; a row is a fingerprint below either.
        heavy = stage(
            units.groupBy("run", "a", "b", "depth").count().where((F.col("count") > unit_rows) & (F.col("depth") <= BITS - step)).drop("count"),
            "trie-heavy",
        )
        unit = ["run", "a", "b", "depth"]
        if not heavy.head(1):
            break
        calm = units.join(heavy, unit, "left_anti")
        done = calm if done is None else done.unionByName(calm)
        child = F.expr(f"shiftrightunsigned(code, {BITS - step} - depth)")
        spent = F.bit_count(F.col("a").bitwiseXOR(F.col("b")))
        masks = F.element_at(
            F.array(*[F.array(*[F.lit(m).cast("long") for m in near[e]]) for e in range(budget, -1, -1)]),
            (spent + 1).cast("int"),
        )
        side_a = F.expr(f"shiftrightunsigned(code, {BITS} - depth)") == F.col("a")
        flip = F.col("a").bitwiseXOR(F.col("b"))
        split = (
            units.join(heavy, unit)
            .withColumn("child", child)
            .withColumn("on_a", side_a)
            .withColumn("mask", F.explode(masks))
            .withColumn("other", F.shiftleft(flip, step).bitwiseOR(F.col("mask")).bitwiseXOR(F.col("child")))
            # Within one node a pair of children comes up from either side; it is the same unit.
            .withColumn("first", F.when(flip == 0, F.least("child", "other")).when(F.col("on_a"), F.col("child")).otherwise(F.col("other")))
            .withColumn("second", F.when(flip == 0, F.greatest("child", "other")).when(F.col("on_a"), F.col("other")).otherwise(F.col("child")))
            .select("run", F.col("first").alias("a"), F.col("second").alias("b"), (F.col("depth") + step).alias("depth"), "code")
        )
        units = stage(split, "trie-units")
    units = units if done is None else done.unionByName(units)
    rows = units.repartition("run", "a", "b", "depth").sortWithinPartitions("run", "depth", "a", "b", "code")
    schema = pa.schema([("u", pa.int64()), ("v", pa.int64())])
    turn = np.array(edges_of[:-1], dtype=np.uint64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for unit in _whole_units(batches):
            codes = unit["code"].view(np.uint64)
            i, j = forest(codes, unit["starts"], unit["a"].view(np.uint64), unit["b"].view(np.uint64), unit["depth"], budget)
            if len(i):
                shift = turn[unit["run"][i]]

                def back(c, shift=shift):
                    return np.where(shift == 0, c, (c >> shift) | (c << ((np.uint64(64) - shift) & np.uint64(63)))).view(np.int64)

                yield batch_of(schema, back(codes[i]), back(codes[j]))

    return rows.mapInArrow(run, "u long, v long")


def _whole_units(batches: Iterator[pa.RecordBatch], most: int = 1 << 17) -> Iterator[dict]:
    """Column arrays of about ``most`` rows that end where a unit ends."""
    names = ("run", "a", "b", "depth", "code")
    held: list[list[np.ndarray]] = []

    def packed(columns):
        change = np.zeros(len(columns[0]), dtype=bool)
        change[:1] = True
        for c in columns[:4]:
            change[1:] |= c[1:] != c[:-1]
        return dict(zip(names, columns)) | {"starts": np.append(np.flatnonzero(change), len(change))}

    for batch in batches:
        if not batch.num_rows:
            continue
        held.append([batch.column(n).to_numpy(zero_copy_only=False) for n in names])
        if sum(len(h[0]) for h in held) < most:
            continue
        unit = packed([np.concatenate(c) for c in zip(*held)])
        cut = int(unit["starts"][-2])
        if cut:
            yield packed([unit[n][:cut] for n in names])
        held = [[unit[n][cut:] for n in names]]
    if held:
        yield packed([np.concatenate(c) for c in zip(*held)])


def forest(codes, starts, a, b, depth, budget: int, chunk: int = 1 << 16) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of a spanning forest of the links inside each unit.

    ``codes``: unsigned, sorted within each unit ``starts[k]:starts[k+1]``, whose
    rows lie below trie nodes ``a`` and ``b`` of ``depth``.
    """
    parent = np.arange(len(codes))
    ones: dict[int, np.ndarray] = {}

    def below(d: int) -> np.ndarray:
        """Running count of codes with bit d set, to find where a node's right child begins."""
        if d not in ones:
            bit = (codes >> np.uint64(BITS - 1 - d)) & np.uint64(1)
            ones[d] = np.concatenate([[0], np.cumsum(bit, dtype=np.int32)]).astype(np.int32)
        return ones[d]

    stack = []
    first, last = starts[:-1].astype(np.int32), starts[1:].astype(np.int32)
    at = depth[first]
    for d in np.unique(at):
        pick = np.flatnonzero(at == d)
        lo, hi = first[pick], last[pick]
        same = a[lo] == b[lo]
        # The rows of a unit of two nodes: those below a come first or last, as the codes are sorted.
        middle = lo + np.array(
            [0 if s else np.searchsorted(codes[x:y] >> np.uint64(BITS - int(d)), max(p, q)) for x, y, s, p, q in zip(lo, hi, same, a[lo], b[lo])],
            dtype=np.int32,
        ).reshape(-1)
        spent = np.array([int(p ^ q).bit_count() for p, q in zip(a[lo], b[lo])], dtype=np.int8)
        stack.append((int(d), lo, np.where(same, hi, middle), np.where(same, lo, middle), hi, spent))
    while stack:
        d, alo, ahi, blo, bhi, err = stack.pop()
        if len(alo) > chunk:
            for at_ in range(0, len(alo), chunk):
                stack.append((d, *(x[at_ : at_ + chunk] for x in (alo, ahi, blo, bhi, err))))
            continue
        itself = alo == blo
        na, nb = ahi - alo, bhi - blo
        keep = (na > 0) & (nb > 0) & (err <= budget) & ~(itself & (na < 2))
        # Nodes whose leaves are all connected already need no visit.
        turns = np.concatenate([[0], np.cumsum(parent[1:] != parent[:-1])])
        keep[keep] &= ~(
            (turns[alo[keep]] == turns[ahi[keep] - 1]) & (turns[blo[keep]] == turns[bhi[keep] - 1]) & (parent[alo[keep]] == parent[blo[keep]])
        )
        alo, ahi, blo, bhi, err, itself = (x[keep] for x in (alo, ahi, blo, bhi, err, itself))
        if not len(alo):
            continue
        few = (ahi - alo).astype(np.int64) * (bhi - blo) <= 16
        if d >= BITS:
            few[:] = True
        if few.any():
            i, j = _products(alo[few], ahi[few], blo[few], bhi[few])
            near = (i != j) & (np.bitwise_count(codes[i] ^ codes[j]) <= budget)
            _unite(parent, i[near], j[near])
        go = ~few
        if not go.any():
            continue
        alo, ahi, blo, bhi, err, itself = (x[go] for x in (alo, ahi, blo, bhi, err, itself))
        c = below(d)
        amid, bmid = ahi - (c[ahi] - c[alo]), bhi - (c[bhi] - c[blo])
        both = ~itself
        stack.append(
            (
                d + 1,
                np.concatenate([alo, amid, alo, amid[both]]),
                np.concatenate([amid, ahi, amid, ahi[both]]),
                np.concatenate([blo, bmid, bmid, blo[both]]),
                np.concatenate([bmid, bhi, bhi, bmid[both]]),
                np.concatenate([err, err, err + 1, err[both] + 1]),
            )
        )
    i = np.flatnonzero(parent != np.arange(len(parent)))
    return i, parent[i]


def _products(alo, ahi, blo, bhi) -> tuple[np.ndarray, np.ndarray]:
    """All index pairs of the interval pairs."""
    na, nb = (ahi - alo).astype(np.int64), (bhi - blo).astype(np.int64)
    total = na * nb
    which = np.repeat(np.arange(len(total)), total)
    nth = np.arange(total.sum()) - np.repeat(np.cumsum(total) - total, total)
    return alo[which] + nth // nb[which], blo[which] + nth % nb[which]


def _unite(parent: np.ndarray, i: np.ndarray, j: np.ndarray) -> None:
    """Join the components of the pairs; ``parent`` holds the smallest member for every index."""
    while len(i):
        pi, pj = parent[i], parent[j]
        apart = pi != pj
        i, j, pi, pj = i[apart], j[apart], pi[apart], pj[apart]
        if not len(i):
            return
        np.minimum.at(parent, np.maximum(pi, pj), np.minimum(pi, pj))
        while True:
            up = parent[parent]
            if np.array_equal(up, parent):
                break
            parent[:] = up


def near_duplicates(
    docs: DataFrame, text: str = "text", id_column: str = "doc_id", shingle: int = 4, budget: int = 4, unit_rows: int = 1 << 14
) -> DataFrame:
    """``docs`` with ``fingerprint`` (16 hex digits), ``component_id`` and ``representative`` appended.

    ``component_id`` is the smallest id reachable; ``representative`` is true
    for exactly one row of each component, one with that id.  Columns of the
    input with these names are replaced.
    """
    row, code = free_name(docs, "_row"), free_name(docs, "_code")
    kept = [c for c in docs.columns if c.lower() not in ("fingerprint", "component_id", "representative")]
    marked = stage(with_fingerprints(docs.select(*kept).withColumn(row, F.monotonically_increasing_id()), text, shingle, code), "fingerprints")
    # Rows without an id come last.
    rank = F.min(F.struct(F.col(id_column).isNull().alias("none"), F.col(id_column).alias("id"), F.col(row).alias("row"))).alias("best")
    classes = stage(marked.groupBy(code).agg(rank), "fingerprint-classes")
    links = components(fingerprint_links(classes.select(code), budget, unit_rows), "simhash-components")
    linked = stage(classes.join(links.withColumnRenamed("node", code), code), "linked-classes")
    heads = linked.groupBy("component").agg(F.min("best").alias("head"))
    over = stage(linked.drop("best").join(stage(heads, "component-heads"), "component").select(code, "head"), "class-heads")
    classes = classes.join(over, code, "left").select(code, F.coalesce("head", "best").alias("head"))
    return (
        marked.join(stage(classes, "classes"), code)
        .withColumns(
            {
                "fingerprint": F.lower(F.lpad(F.hex(code), 16, "0")),
                "component_id": F.col("head.id"),
                "representative": F.col(row) == F.col("head.row"),
            }
        )
        .select(*kept, "fingerprint", "component_id", "representative")
    )
