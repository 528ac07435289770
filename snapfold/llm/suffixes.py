"""Removal of repeated byte strings with suffix arrays built by grouping Lyndon prefixes.

Any string of ``length`` bytes holds a sampled anchor of ``anchor`` bytes (its
minimizer) and equal strings hold the same one at the same place.  So:

1. each bucket of documents lists its anchors with a 128-bit hash of their
   surroundings, everything a string through the anchor can reach; an anchor
   with the same surroundings twice repeats all strings through it;
2. where an anchor recurs in different surroundings, one copy of each of them
   is sent to the anchor's shard, whose suffix array sorts them to the right
   and, reversed, to the left; two surroundings share the string at an offset
   if they stay together to the depths it needs on both sides;
3. the verdicts go back to the anchors' places and the bytes are cut.

Defined edge cases: a null text is empty; a text shorter than ``length`` loses
nothing; repeated rows lose all that is long enough.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapfold.llm.buckets import BLOCK, bucketed, covered, in_order, minimizers, runs, with_buckets
from snapfold.llm.common import batch_of, discard, free_name, null, stage

CELL = 64
#: Surroundings that a shard sorts at once, unless one anchor has more.
BATCH = 1_500
#: Anchors with more surroundings than this are cut, down to units of at most so many, by what those agree on.
HOT_ANCHOR = 2_000
#: Surroundings equal in these are compared together; a null range is all offsets.
UNIT = ["a", "first", "last", "k1", "k2"]
MULTIPLIER = 0x9E3779B97F4A7C15


def suffix_array(symbols: list[int]) -> list[int]:
    """Suffix array of integers that end with a single smallest one, in linear time without recursion.

    Suffixes are grouped by prefixes that grow to their Lyndon prefixes:
    groups are taken from the highest down; each member points to the nearest
    suffix before it in a lower group (previous smaller), whose prefix the
    member's prolongs.  Suffixes prolonged equally often move together to a new
    group right above their old one.  Then groups are final and a scan in
    ascending order puts the suffixes that a sorted one follows into the next
    free places of their groups.
    """
    n = len(symbols)
    order = sorted(range(n), key=symbols.__getitem__)
    place = [0] * n
    group = [0] * n  # of a suffix: where its group begins
    size = [0] * n  # of the group that begins here
    start = 0
    for at, i in enumerate(order):
        place[i] = at
        if symbols[i] != symbols[order[start]]:
            start = at
        group[i] = start
        size[start] += 1
    smaller = [-1] * n
    end = n - 1
    while end >= 0:
        begin = group[order[end]]
        prolonged: dict[int, int] = {}
        for i in sorted(order[begin : end + 1]) if end > begin else (order[end],):
            p = i - 1
            while p >= 0 and group[p] >= begin:
                p = smaller[p]
            smaller[i] = p
            if p >= 0:
                prolonged[p] = prolonged.get(p, 0) + 1
        if prolonged:
            sets: dict[tuple[int, int], list[int]] = {}
            for p, times in prolonged.items():
                sets.setdefault((-times, group[p]), []).append(p)
            for _, old in sorted(sets) if len(sets) > 1 else sets:
                moved = sets[(_, old)]
                stop = old + size[old]
                for p in moved:
                    stop -= 1
                    q, at = order[stop], place[p]
                    order[at], place[q] = q, at
                    order[stop], place[p] = p, stop
                size[old] -= len(moved)
                size[stop] = len(moved)
                for p in moved:
                    group[p] = stop
        end = begin - 1
    free = list(range(n))  # next free place of the group that begins here
    result = [0] * n
    placed = [False] * n
    result[0], placed[n - 1] = n - 1, True
    for at in range(n):
        p = result[at] - 1
        while p >= 0 and not placed[p]:
            g = group[p]
            result[free[g]] = p
            free[g] += 1
            placed[p] = True
            p = smaller[p]
    return result


def offset_ranges(reach: int) -> list[tuple[int, int]]:
    """Ranges that cover the offsets 0 .. ``reach``, single at both ends and doubling towards the middle."""
    middle, low, out = reach // 2, 0, []
    while low <= middle:
        high = min(max(low, 2 * low - 1), middle)
        out.append((low, high))
        low = high + 1
    mirrored = [(max(reach - high, middle + 1), reach - low) for low, high in out]
    return out + [(low, high) for low, high in mirrored if low <= high]


def shared_windows(
    left: np.ndarray, right: np.ndarray, left_size: np.ndarray, right_size: np.ndarray, length: int, unit: np.ndarray
) -> np.ndarray:
    """``[i, r]`` true if the string that begins ``r`` bytes before anchor i has an equal in other surroundings of its unit.

    ``left`` (reversed) and ``right`` (from the anchor on): bytes, a row for
    each surroundings, zero beyond their sizes.
    """
    m = len(left)
    orders = _sorted_rows(left, right)
    together = []
    for bytes_, order in zip((left, right), orders):
        differ = bytes_[order[1:]] != bytes_[order[:-1]]
        shared = np.where(differ.any(axis=1), differ.argmax(axis=1), bytes_.shape[1])
        together.append((order, shared))
    offsets = np.arange(left.shape[1] + 1)
    out = np.zeros((len(offsets), m), dtype=bool)
    step = max(1, (1 << 17) // max(m, 1))
    for at in range(0, len(offsets), step):
        r = offsets[at : at + step, None]
        keys = np.broadcast_to(unit, (len(r), m))
        for (order, shared), depth in zip(together, (r, length - r)):
            number = np.zeros((len(r), m), dtype=np.int64)
            number[:, order[1:]] = np.cumsum(shared < depth, axis=1)
            keys = keys * m + number
        keys = np.where((left_size >= r) & (right_size >= length - r), keys, -1 - np.arange(m))
        order = np.argsort(keys, axis=1)
        ranked = np.take_along_axis(keys, order, axis=1)
        equal = np.zeros_like(ranked, dtype=bool)
        equal[:, 1:] = ranked[:, 1:] == ranked[:, :-1]
        equal[:, :-1] |= equal[:, 1:]
        np.put_along_axis(out[at : at + step], order, equal, axis=1)
    return out.T


def _sorted_rows(*sides: np.ndarray) -> list[np.ndarray]:
    """Order of the rows of each matrix by their bytes, from one suffix array over cells of bytes; equal rows enter it once."""
    cells, copies = [], []
    for side in sides:
        numbers: dict[bytes, int] = {}
        copies.append(np.array([numbers.setdefault(row.tobytes(), len(numbers)) for row in side]))
        wide = np.zeros((len(numbers), -(-side.shape[1] // CELL) * CELL), dtype=np.uint8)
        wide[copies[-1], : side.shape[1]] = side
        cells.append(wide.reshape(len(numbers), -1, CELL))
    # Above the separators, one after every row. Zeros at the end of a cell, which numpy takes for padding, are that in every cell.
    rank = np.unique(np.concatenate([c.reshape(-1, CELL) for c in cells]).view(f"S{CELL}"), return_inverse=True)[1].reshape(-1)
    rank += 1 + sum(map(len, cells))
    text, begins, used, at, separator = [], [], 0, 0, 1
    for c in cells:
        m, n = c.shape[:2]
        rows = np.concatenate([rank[used : used + m * n].reshape(m, n), (separator + np.arange(m))[:, None]], axis=1)
        text.append(rows.reshape(-1))
        begins.append(at + np.arange(m) * (n + 1))
        used, at, separator = used + m * n, at + m * (n + 1), separator + m
    array = np.array(suffix_array([*np.concatenate(text).tolist(), 0]))
    position = np.empty(len(array), dtype=np.int64)
    position[array] = np.arange(len(array))
    return [np.argsort(position[b][k], kind="stable") for b, k in zip(begins, copies)]


def _padded(values: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Binary values as the rows of a matrix, zero beyond their sizes, and these sizes."""
    raw = values.to_pylist()
    size = np.fromiter(map(len, raw), np.int64, len(raw))
    out = np.zeros((len(raw), width), dtype=np.uint8)
    out[np.arange(width) < size[:, None]] = np.frombuffer(b"".join(raw), np.uint8)
    return out, size


class Bytes:
    """The bytes of several texts in a row."""

    def __init__(self, texts: list[str | None]):
        raw = [(t or "").encode() for t in texts]
        self.raw = b"".join(raw)
        self.counts = np.fromiter(map(len, raw), np.int64, len(raw))
        self.ends = np.cumsum(self.counts)
        self.begins = self.ends - self.counts

    def inside(self, size: int) -> np.ndarray:
        """True where ``size`` bytes from a place on are of one text."""
        begin = np.maximum(self.counts - size + 1, 0)
        lengths = np.stack([begin, self.counts - begin], axis=1).reshape(-1)
        return np.repeat(np.tile([True, False], len(begin)), lengths)

    def hashes(self, size: int) -> np.ndarray:
        """Rolling hash of ``size`` bytes from each place on; ``size`` is a power of two."""
        raw = np.frombuffer(self.raw, np.uint8)
        out = np.empty(max(len(raw) - size + 1, 0), np.uint64)
        for at in range(0, len(out), BLOCK):
            values = raw[at : at + BLOCK + size - 1].astype(np.uint64) + np.uint64(1)
            values *= np.uint64(0xC2B2AE3D27D4EB4F)
            done, base = 1, MULTIPLIER
            while done < size:
                values = values[: len(values) - done] * np.uint64(base) + values[done:]
                done, base = 2 * done, base * base % (1 << 64)
            # Mixed, so that small values, which minimizers prefer, are no kind of text.
            values ^= values >> np.uint64(29)
            values *= np.uint64(0xBF58476D1CE4E5B9)
            out[at : at + BLOCK] = values ^ (values >> np.uint64(32))
        return out


def hot_units(around: DataFrame, length: int, reach: int, most: int) -> tuple[DataFrame, DataFrame, list[DataFrame]]:
    """Verdicts ``(a, c1, c2, low, high)``, units ``(a, c1, c2, first, last, k1, k2)`` of at most ``most`` rows left to compare, and the tables behind both.

    Strings whose offset is in one range share its core, the bytes all of them
    hold, and lie in its hull, the bytes any of them holds.  Surroundings with
    the same hull repeat every string of the range, and one of them stands for
    all from there on; those alone with their core drop out.  While a core has
    more than ``most`` of them the range is halved, at last to single offsets,
    where hull and core are one.
    """
    id_ = ["a", "c1", "c2"]
    schema = pa.schema([*((n, pa.int64()) for n in id_), *((n, pa.int32()) for n in ("first", "last", "low", "high")), *((n, pa.int64()) for n in ("k1", "k2", "m1", "m2"))])
    ddl = "a long, c1 long, c2 long, first int, last int, low int, high int, k1 long, k2 long, m1 long, m2 long"

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            which, ranges, inner, outer = [], [], [], []
            columns = (batch.column(n).to_pylist() for n in ("left", "right", "firsts", "lasts"))
            for k, (x, y, firsts, lasts) in enumerate(zip(*columns)):
                for first, last in zip(firsts, lasts):
                    low, high = max(first, length - len(y)), min(last, len(x))
                    if low > high:
                        continue
                    which.append(k)
                    # The offsets at which a string of these surroundings can begin, as a half-open range.
                    ranges.append((first, last, low, high + 1))
                    inner.append(xxhash.xxh3_128_digest(x[:first] + y[: length - last]))
                    ends = x[:last]
                    outer.append(xxhash.xxh3_128_digest(len(ends).to_bytes(4, "little") + ends + y[: length - first]))
            own = batch.select(id_).take(pa.array(which, pa.int64()))
            spans = np.array(ranges, dtype=np.int32).reshape(-1, 4)
            k_, m_ = (np.frombuffer(b"".join(d), "<i8").reshape(-1, 2) for d in (inner, outer))
            yield batch_of(schema, *own.columns, *spans.T, k_[:, 0], k_[:, 1], m_[:, 0], m_[:, 1])

    ranges = offset_ranges(reach)
    work = around.withColumns({"firsts": F.array(*[F.lit(x) for x, _ in ranges]), "lasts": F.array(*[F.lit(y) for _, y in ranges])})
    hull = [*UNIT, "m1", "m2"]
    settled, units, used = [], [], []
    while True:
        keyed = stage(work.select(*id_, "left", "right", "firsts", "lasts").mapInArrow(keys, ddl), "cores")
        # One of each hull; these are counted, never gathered.
        hulls = stage(keyed.groupBy(*hull).agg(F.count("*").alias("n"), F.min(F.struct("c1", "c2")).alias("one")), "hulls")
        used += [keyed, hulls]
        shared = keyed.join(hulls.where("n > 1").select(*hull), hull)
        settled.append(shared.select(*id_, F.array("low").alias("low"), F.array("high").alias("high")))
        counts = stage(hulls.groupBy(*UNIT).count().where("count > 1"), "core-counts")
        used.append(counts)
        kept = hulls.select(*UNIT, "one.*").join(counts, UNIT)
        units.append(kept.where(F.col("count") <= most).select(*id_, *UNIT[1:]))
        large = kept.where(F.col("count") > most)
        if not counts.where(F.col("count") > most).head(1):
            break
        middle = F.expr("(first + last) div 2").cast("int")
        halves = large.select(*id_, F.array(F.col("first"), middle + 1).alias("f"), F.array(middle, F.col("last")).alias("l"))
        halves = stage(
            halves.groupBy(*id_).agg(F.flatten(F.collect_list("f")).alias("firsts"), F.flatten(F.collect_list("l")).alias("lasts")), "halved-ranges"
        )
        used.append(halves)
        work = around.select(*id_, "left", "right").join(halves, id_)
    return reduce(DataFrame.unionByName, settled), reduce(DataFrame.unionByName, units), used


def remove_repeats(
    docs: DataFrame, text: str = "text", length: int = 400, anchor: int = 64, hot_anchor: int = HOT_ANCHOR
) -> DataFrame:
    """``docs`` with ``n_bytes``, ``n_removed``, ``n_spans`` and ``kept_bytes`` (binary) appended; input columns of these names are replaced.

    Every byte covered by a string of ``length`` bytes that also begins
    anywhere else, in the same document or another, is removed.
    """
    if anchor & (anchor - 1) or anchor >= length:
        raise ValueError("anchor must be a power of two below length")
    added = ("n_bytes", "n_removed", "n_spans", "kept_bytes")
    kept = [c for c in docs.columns if c.lower() not in added]
    bucket = free_name(docs, "_bucket")
    marked = bucketed(docs.select(*kept), text, bucket)
    texts = marked.select(bucket, F.col(text).alias("text"))
    reach = length - anchor

    anchors_schema = pa.schema(
        [(bucket, pa.int32()), ("a", pa.int64()), ("c1", pa.int64()), ("c2", pa.int64()), ("n", pa.int64()), ("docs", pa.list_(pa.int32())), ("places", pa.list_(pa.int32()))]
    )

    def find(group: pa.Table) -> pa.Table:
        ordered = in_order(group, "text", "text")
        data = Bytes(ordered.column("text").to_pylist())
        hashes = data.hashes(anchor)
        places = minimizers(hashes, reach + 1, data.inside(length))
        if not len(places):
            return anchors_schema.empty_table()
        doc = np.searchsorted(data.ends, places, side="right")
        low = np.maximum(data.begins[doc], places - reach)
        high = np.minimum(data.ends[doc], places + length)
        raw = data.raw
        around = np.array([xxhash.xxh3_128_digest(raw[a:b]) for a, b in zip(low.tolist(), high.tolist())], dtype="S16").tobytes()
        around = np.frombuffer(around, dtype="<i8").reshape(-1, 2)
        # The anchor's place within its surroundings is part of them.
        c1, c2 = around[:, 0], around[:, 1] ^ (places - low)
        a = hashes[places].view(np.int64)
        order = np.lexsort((places, c2, c1, a))
        first = np.ones(len(order), dtype=bool)
        for values in (a, c1, c2):
            ranked = values[order]
            same = ranked[1:] == ranked[:-1] if values is a else same & (ranked[1:] == ranked[:-1])
        first[1:] = ~same
        at = np.append(np.flatnonzero(first), len(order))
        pick = order[at[:-1]]
        offsets = pa.array(at.astype(np.int32))
        return pa.table(
            [
                pa.array(np.full(len(pick), ordered.column(bucket)[0].as_py(), np.int32)),
                pa.array(a[pick]),
                pa.array(c1[pick]),
                pa.array(c2[pick]),
                pa.array(np.diff(at)),
                pa.ListArray.from_arrays(offsets, pa.array(doc[order].astype(np.int32))),
                pa.ListArray.from_arrays(offsets, pa.array((places - data.begins[doc])[order].astype(np.int32))),
            ],
            schema=anchors_schema,
        )

    anchors = stage(
        texts.groupBy(bucket).applyInArrow(find, f"{bucket} int, a long, c1 long, c2 long, n long, docs array<int>, places array<int>"), "anchors"
    )
    one = F.struct(F.col(bucket), F.col("docs")[0].alias("doc"), F.col("places")[0].alias("place"))
    classes = stage(anchors.groupBy("a", "c1", "c2").agg(F.sum("n").alias("n"), F.min(one).alias("one")), "surroundings")
    # Only an anchor with several surroundings, one of them single, leaves something to compare.
    several = stage(classes.groupBy("a").agg(F.count("*").alias("kinds"), F.min("n").alias("least")).where("kinds > 1 AND least = 1").select("a"), "mixed-anchors")
    wanted = stage(classes.join(several, "a").select("a", "c1", "c2", "one.*"), "wanted")
    around_ddl = "a long, c1 long, c2 long, left binary, right binary"

    def fetch(group: pa.Table, rows: pa.Table) -> pa.Table:
        data = Bytes(in_order(group, "text", "text").column("text").to_pylist())
        doc = rows.column("doc").to_numpy()
        places = data.begins[doc] + rows.column("place").to_numpy() if len(doc) else np.zeros(0, np.int64)
        low, high = np.maximum(data.begins[doc], places - reach), np.minimum(data.ends[doc], places + length)
        return pa.table(
            {
                **{c: rows.column(c) for c in ("a", "c1", "c2")},
                "left": pa.array([data.raw[x:y][::-1] for x, y in zip(low.tolist(), places.tolist())], pa.binary()),
                "right": pa.array([data.raw[x:y] for x, y in zip(places.tolist(), high.tolist())], pa.binary()),
            }
        )

    around = stage(with_buckets(texts, wanted, bucket, fetch, around_ddl), "surroundings-bytes")
    discard(several, wanted)
    verdict_schema = pa.schema([("a", pa.int64()), ("c1", pa.int64()), ("c2", pa.int64()), ("low", pa.list_(pa.int32())), ("high", pa.list_(pa.int32()))])
    verdict_ddl = "a long, c1 long, c2 long, low array<int>, high array<int>"
    hot = stage(around.groupBy("a").count().where(F.col("count") > hot_anchor).select("a"), "hot-anchors")
    whole = around.join(hot, "a", "left_anti").select(
        "a", "c1", "c2", *(null(t).alias(n) for n, t in (("first", "int"), ("last", "int"), ("k1", "long"), ("k2", "long"))), "left", "right"
    )
    settled, units, used = hot_units(around.join(hot, "a"), length, reach, hot_anchor)
    split = units.join(around, ["a", "c1", "c2"])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, unit in _whole_units(batches, UNIT):
            (left, left_size), (right, right_size) = (_padded(rows.column(n), w) for n, w in (("left", reach), ("right", length)))
            found = shared_windows(left, right, left_size, right_size, length, unit)
            first, last = (rows.column(n).fill_null(x).to_numpy()[:, None] for n, x in (("first", 0), ("last", reach)))
            found = found & (np.arange(reach + 1) >= first) & (np.arange(reach + 1) <= last)
            # A column more, so that no run goes on in the next row.
            begins, ends = runs(np.pad(found, ((0, 0), (0, 1))).reshape(-1))
            at, begins = np.divmod(begins, reach + 2)
            some, counts = np.unique(at, return_counts=True)
            offsets = pa.array(np.append(0, np.cumsum(counts)).astype(np.int32))
            spans = (pa.ListArray.from_arrays(offsets, pa.array(x.astype(np.int32))) for x in (begins, ends - at * (reach + 2)))
            keys = rows.select(["a", "c1", "c2"]).take(pa.array(some))
            yield batch_of(verdict_schema, *(keys.column(c).combine_chunks() for c in ("a", "c1", "c2")), *spans)

    shards = whole.unionByName(split.select(*whole.columns)).repartition(*UNIT).sortWithinPartitions(*UNIT)
    partial = shards.mapInArrow(compare, verdict_ddl).unionByName(settled)
    none = F.lit(None).cast("array<int>")
    repeated = classes.where("n > 1").select("a", "c1", "c2", none.alias("low"), none.alias("high"))
    # Surroundings found twice need no spans: everything through their anchor repeats.
    verdicts = stage(repeated.unionByName(partial.join(repeated.select("a", "c1", "c2"), ["a", "c1", "c2"], "left_anti")), "verdicts")
    marks = stage(anchors.join(verdicts, ["a", "c1", "c2"]).select(bucket, "docs", "places", "low", "high"), "byte-marks")
    discard(anchors, classes, around, verdicts, *used)
    out = marked.select(
        *kept, *(null("long").alias(n) for n in added[:3]), null("binary").alias("kept_bytes")
    ).schema

    def cut(group: pa.Table, rows: pa.Table) -> pa.Table:
        ordered = in_order(group, text, text)
        data = Bytes(ordered.column(text).to_pylist())
        row, doc = _unnested(rows.column("docs"))
        at = _unnested(rows.column("places"))[1] + data.begins[doc]
        every = rows.column("low").is_null().to_numpy()[row]
        begin, end = data.begins[doc[every]], data.ends[doc[every]]
        first, last = np.maximum(begin, at[every] - reach), np.minimum(at[every], end - length)
        first, last = first[first <= last], last[first <= last]
        # Every place of a row with every span of the row: offsets r of low .. high - 1 begin at - r.
        owner, low = _unnested(rows.column("low"))
        high = _unnested(rows.column("high"))[1]
        spans = np.bincount(owner, minlength=rows.num_rows)
        times = spans[row]
        at = np.repeat(at, times)
        span = np.arange(len(at)) + np.repeat((np.cumsum(spans) - spans)[row] - (np.cumsum(times) - times), times)
        starts = np.concatenate([first, at - high[span] + 1])
        gone = covered(len(data.raw), starts, np.concatenate([last, at - low[span]]) + length)
        begun = gone.copy()
        begun[1:] &= ~gone[:-1]
        filled = data.begins[data.counts > 0]
        begun[filled] = gone[filled]
        removed, runs_ = (np.diff(np.append(0, np.cumsum(x))[np.append(0, data.ends)]) for x in (gone, begun))
        left = np.frombuffer(data.raw, np.uint8)[~gone].tobytes()
        stops = np.cumsum(data.counts - removed)
        left = [left[a:b] for a, b in zip((stops - data.counts + removed).tolist(), stops.tolist())]
        columns = [ordered.column(c) for c in kept]
        columns += [pa.array(data.counts), pa.array(removed, pa.int64()), pa.array(runs_, pa.int64()), pa.array(left, pa.binary())]
        return pa.table(columns, names=[*kept, *added])

    return with_buckets(marked, marks, bucket, cut, out)


def _unnested(lists: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The items of all lists in a row, before them the numbers of their lists; a null list has none."""
    counts = pc.fill_null(pc.list_value_length(lists), 0).to_numpy()
    items = pc.list_flatten(lists).to_numpy().astype(np.int64)
    return np.repeat(np.arange(len(counts)), counts), items


def _whole_units(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Tables of about BATCH rows that end where a unit of equal keys ends, with the number of each row's unit."""

    def units(rows: pa.Table) -> np.ndarray:
        change = np.zeros(rows.num_rows, dtype=bool)
        for k in keys:
            values = rows.column(k).fill_null(-1).to_numpy()
            change[1:] |= values[1:] != values[:-1]
        return np.cumsum(change)

    held: list[pa.RecordBatch] = []
    for batch in batches:
        for at in range(0, batch.num_rows, BATCH):
            held.append(batch.slice(at, BATCH))
            if sum(b.num_rows for b in held) < BATCH:
                continue
            rows = pa.Table.from_batches(held).combine_chunks()
            unit = units(rows)
            cut = int(np.searchsorted(unit, unit[-1]))
            if cut:
                yield rows.slice(0, cut), unit[:cut]
                held = rows.slice(cut).to_batches()
    if held:
        rows = pa.Table.from_batches(held).combine_chunks()
        yield rows, units(rows)
