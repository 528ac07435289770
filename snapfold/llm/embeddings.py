"""Exact cosine links between embeddings of equal label by dual traversal of cover trees.

Equal vectors of a label form one class.  The classes of a label are dealt to
the nearest of a few centres; a pair of cells that lies further apart than
the threshold and both covering radii is pruned on the list of centres, and
the others, cut into blocks of bounded size, are units of work.  A task builds
a cover tree on each side of a unit (nested levels, every radius half of the
one above) and descends pairs of nodes together: a pair too far apart is
pruned, a pair wholly within the threshold is linked at once without listing
it, and leaves are compared exactly.  Counts and a spanning forest come out,
never the pairs.

Defined edge cases: a null label, a null, empty or zero vector, or one with a
null or non-finite component links with nothing; vectors link only with those
of their own length; equal rows are linked with each other; a null id takes
part, and counts as the smallest of its component only where there is no other.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapfold.llm.common import free_name, null, stage
from snapfold.llm.components import components
from snapfold.llm.simhash import _unite

#: Rows of a block; a unit holds two at most.
BLOCK_ROWS = 2_048
#: Centres over all labels, which bounds what is broadcast: their vectors and the list of cell pairs.
MAX_CENTRES = 1_024
LEAF = 8
#: What rounding may add to a distance; leaves are compared without it.
SLACK = 1e-6


class CoverTree:
    """Nodes of a cover tree over unit vectors; children follow from their parent's cover at half its radius."""

    def __init__(self, points: np.ndarray, weights: np.ndarray):
        self.points, self.weights = points, weights
        members = np.arange(len(points))
        distance = _distance(points @ points[0])
        self.root = self._node(members, 0, distance)

    def _node(self, members, centre, distance):
        return {"members": members, "centre": centre, "radius": float(distance.max()), "weight": int(self.weights[members].sum()), "children": None}

    def children(self, node) -> list[dict]:
        """Centres at least half the radius apart that cover the members within it; the first is the node's own centre."""
        if node["children"] is None:
            half, left, centre, out = node["radius"] / 2, node["members"], node["centre"], []
            while len(left):
                distance = _distance(self.points[left] @ self.points[centre])
                near = (distance <= half) | (left == centre)
                out.append(self._node(left[near], centre, distance[near]))
                left = left[~near]
                centre = left[0] if len(left) else centre
            node["children"] = out
        return node["children"]


def _distance(cosine: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(0.0, 2.0 - 2.0 * cosine))


def unit_links(a: np.ndarray, wa: np.ndarray, b: np.ndarray | None, wb: np.ndarray | None, least: float) -> tuple[np.ndarray, np.ndarray]:
    """Weighted number of linked partners and a forest root for every row of ``a`` followed by ``b``.

    ``b`` None compares ``a`` with itself, without a row's own copies.
    """
    alone = b is None
    first = CoverTree(a, wa)
    second = first if alone else CoverTree(b, wb)
    shift = 0 if alone else len(a)
    links = np.zeros(len(a) + (0 if alone else len(b)), dtype=np.int64)
    parent = np.arange(len(links))
    reach = float(_distance(np.array(least)))
    stack = [(first.root, second.root)]

    def join(i, j):
        _unite(parent, np.asarray(i), np.asarray(j))

    while stack:
        x, y = stack.pop()
        same = x is y
        mx, my = x["members"], y["members"] + shift
        if same and len(mx) == 1:
            continue
        gap = 0.0 if same else float(_distance(first.points[x["centre"]] @ second.points[y["centre"]]))
        if gap > reach + x["radius"] + y["radius"] + SLACK:
            continue
        if gap + x["radius"] + y["radius"] < reach - SLACK:
            links[mx] += y["weight"]
            if same:
                links[mx] -= wa[mx]
            else:
                links[my] += x["weight"]
            join(np.concatenate([mx, my]), np.full(len(mx) + len(my), mx[0]))
            continue
        if len(mx) * len(my) <= LEAF * LEAF or max(x["radius"], y["radius"]) <= SLACK:
            near = first.points[mx] @ second.points[y["members"]].T >= least
            if same:
                np.fill_diagonal(near, False)
            i, j = np.nonzero(near)
            links[mx] += near @ second.weights[y["members"]]
            if not same:
                links[my] += near.T @ wa[mx]
            join(mx[i], my[j])
            continue
        # The wider node is opened, both where they are alike.
        xs = first.children(x) if x["radius"] * 2 >= y["radius"] and len(mx) > 1 else [x]
        ys = xs if same else second.children(y) if y["radius"] * 2 >= x["radius"] and len(my) > 1 else [y]
        gaps = _distance(first.points[[n["centre"] for n in xs]] @ second.points[[n["centre"] for n in ys]].T)
        allowed = reach + np.array([n["radius"] for n in xs])[:, None] + np.array([n["radius"] for n in ys])[None, :] + SLACK
        i, j = np.nonzero(gaps <= allowed)
        stack += [(xs[p], ys[q]) for p, q in zip(i.tolist(), j.tolist()) if not same or p <= q]
    return links, parent


def _units_of(lists: pa.Array) -> list[np.ndarray | None]:
    """Unit vectors in double precision, None where there is nothing to compare."""
    out = []
    for value in lists:
        v = None
        if value.is_valid and len(value.values) and not value.values.null_count:
            v = value.values.to_numpy(zero_copy_only=False).astype(np.float64)
            if np.isfinite(v).all() and v.any():
                v = v / np.abs(v).max()
                v /= np.sqrt(v @ v)
            else:
                v = None
        out.append(v)
    return out


def embedding_links(
    vectors: DataFrame, embedding: str = "embedding", label: str = "label", id_column: str = "vec_id", least: float = 0.93, block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """``vectors`` with ``n_links``, ``component_id`` and ``kept`` appended (input columns of these names are replaced)."""
    added = ("n_links", "component_id", "kept")
    kept = [c for c in vectors.columns if c.lower() not in added]
    row, key, unit = (free_name(vectors, n) for n in ("_row", "_key", "_unit"))
    read = vectors.select(*kept).withColumn(row, F.monotonically_increasing_id())
    schema = read.select("*", null("binary").alias(key), null("array<double>").alias(unit)).schema

    def prepare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            units = [u if l is not None else None for u, l in zip(_units_of(batch.column(embedding)), batch.column(label).to_pylist())]
            keys = [
                None if u is None else hashlib.blake2b(f"{l!r} {len(u)} ".encode() + (u + 0.0).tobytes(), digest_size=16).digest()
                for u, l in zip(units, batch.column(label).to_pylist())
            ]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(keys, pa.binary()), pa.array(units, pa.list_(pa.float64()))], names=[*batch.schema.names, key, unit]
            )

    rows = stage(read.mapInArrow(prepare, schema), "unit-vectors")
    classes = stage(
        rows.where(F.col(key).isNotNull())
        .groupBy(key)
        .agg(
            F.min(row).alias("class"),
            F.count("*").alias("n"),
            F.min(id_column).alias("least_id"),
            F.any_value(unit).alias("v"),
            F.to_json(F.struct(F.any_value(label).alias("l"), F.any_value(F.size(unit)).alias("d"))).alias("part"),
        ),
        "vector-classes",
    )
    cells = _cells(classes, least, block_rows)
    outcome = stage(_work(cells, least), "vector-links")
    counted = outcome.groupBy("class").agg(F.sum("n_links").alias("n_links"))
    joined = components(outcome.select("class", "root"), "vector-components")
    by_class = stage(
        classes.select(key, "class", "n", "least_id")
        .join(counted, "class", "left")
        .join(joined.withColumnRenamed("node", "class"), "class", "left")
        .select(key, (F.coalesce("n_links", F.lit(0)) + F.col("n") - 1).alias("n_links"), F.coalesce("component", "class").alias("component"), "least_id"),
        "class-links",
    )
    heads = stage(by_class.groupBy("component").agg(F.min("least_id").alias("component_id")), "component-ids")
    by_key = stage(by_class.join(heads, "component").select(key, "n_links", "component_id"), "key-links")
    out = rows.drop(unit, row).join(by_key, key, "left").drop(key)
    return out.select(
        *kept,
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component_id", F.col(id_column)).alias("component_id"),
    ).withColumn("kept", F.col(id_column) == F.col("component_id"))


def _cells(classes: DataFrame, least: float, block_rows: int) -> DataFrame:
    """A row for each class and unit of work it belongs to: ``unit``, ``left`` and ``right`` (which side it is on)."""
    spark = classes.sparkSession
    parts = classes.groupBy("part").agg(F.count("*").alias("rows"))
    large = parts.where(F.col("rows") > block_rows)
    # Centres: the classes with the smallest hashes, about one for each block of a large label, at most MAX_CENTRES in all.
    total = large.agg(F.sum("rows")).first()[0] or 0
    each = max(block_rows, -(-total // MAX_CENTRES))
    order = F.xxhash64("class")
    drawn = classes.join(large, "part").where(F.pmod(order, F.lit(each)) == 0).orderBy(order, "class").limit(MAX_CENTRES)
    centres: dict[str, list[list[float]]] = {}
    for r in drawn.select("part", "v").collect():
        centres.setdefault(r["part"], []).append(r["v"])
    known = {p: np.array(c) for p, c in centres.items()}

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cell, far = np.zeros(batch.num_rows, np.int32), np.full(batch.num_rows, 2.0)
            of = np.array(batch.column("part").to_pylist(), dtype=object)
            for part in set(of.tolist()) & known.keys():
                at = np.flatnonzero(of == part)
                v = np.array(batch.column("v").take(pa.array(at)).to_pylist())
                distance = _distance(v @ known[part].T)
                cell[at] = distance.argmin(axis=1)
                far[at] = distance.min(axis=1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell), pa.array(far)], names=[*batch.schema.names, "cell", "far"])

    plain = classes.select("class", "n", "v", "part")
    dealt = stage(plain.mapInArrow(assign, f"{_ddl(plain)}, cell int, far double"), "vector-cells")
    sizes = stage(
        dealt.groupBy("part", "cell").agg(F.max("far").alias("radius"), F.ceil(F.count("*") / block_rows).cast("int").alias("blocks")), "cell-sizes"
    )
    # Cells of labels with centres, at most one for each centre; every other label is one cell, of several blocks if it is large.
    partners = []
    reach = float(_distance(np.array(least)))
    bounded = sizes.where(F.col("part").isin(list(known))).collect() if known else []
    by_part: dict[str, list] = {}
    for r in bounded:
        by_part.setdefault(r["part"], []).append(r)
    for part, found in by_part.items():
        for r in found:
            ok = []
            for o in found:
                gap = float(_distance(known[part][r["cell"]] @ known[part][o["cell"]]))
                if gap <= reach + SLACK + r["radius"] + o["radius"]:
                    ok.append((int(o["cell"]), int(o["blocks"])))
            partners.append((part, int(r["cell"]), int(r["blocks"]), ok))
    near = spark.createDataFrame(partners, "part string, cell int, blocks int, others array<struct<cell:int,blocks:int>>")
    # Labels without centres can be many, so their block counts are not broadcast by force.
    bare = sizes.where(~F.col("part").isin(list(known)) & (F.col("blocks") > 1)).select("part", "cell", F.col("blocks").alias("bare"))
    block = F.pmod(F.xxhash64(F.lit("block"), "class"), F.coalesce("blocks", "bare", F.lit(1))).cast("int")
    itself = F.when(F.col("bare").isNotNull(), F.array(F.struct("cell", F.col("bare").alias("blocks"))))
    placed = (
        dealt.join(F.broadcast(near), ["part", "cell"], "left")
        .join(bare, ["part", "cell"], "left")
        .withColumn("block", block)
        .withColumn("others", F.coalesce("others", itself))
    )
    own = F.struct("cell", "block")
    alone = F.array(F.struct(F.lit(0).alias("cell"), F.lit(0).alias("block")))
    others = F.flatten(
        F.transform("others", lambda o: F.transform(F.sequence(F.lit(0), o["blocks"] - 1), lambda k: F.struct(o["cell"].alias("cell"), k.cast("int").alias("block"))))
    )
    return (
        placed.withColumn("own", own)
        .withColumn("other", F.explode(F.coalesce(others, alone)))
        .select(
            "class",
            "n",
            "v",
            F.struct("part", F.least("own", "other").alias("a"), F.greatest("own", "other").alias("b")).alias("unit"),
            (F.col("own") <= F.col("other")).alias("left"),
        )
    )


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"{n} {t}" for n, t in df.dtypes)


def _work(cells: DataFrame, least: float) -> DataFrame:
    """``(class, n_links, root)`` of every class with links in a unit."""

    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        classes = table.column("class").to_numpy()
        weights = table.column("n").to_numpy()
        left = table.column("left").to_numpy()
        v = np.array(table.column("v").to_pylist(), dtype=np.float64)
        unit = table.column("unit")[0].as_py()
        order = np.argsort(~left, kind="stable")
        classes, weights, v, n = classes[order], weights[order], v[order], int(left.sum())
        if unit["a"] == unit["b"]:
            links, root = unit_links(v, weights, None, None, least)
        elif 0 < n < len(v):
            links, root = unit_links(v[:n], weights[:n], v[n:], weights[n:], least)
        else:
            links, root = np.zeros(len(v), np.int64), np.arange(len(v))
        some = links > 0
        return pa.table({"class": classes[some], "n_links": links[some], "root": classes[root[some]]})

    return cells.groupBy("unit").applyInArrow(run, "class long, n_links long, root long")
