"""Filling down in file order without a shuffle.

Rows of a stored table come in file order already: a task meets the rows of a file split
one after the other, numbered without gaps.  Every such run fills itself down and leaves
what it has said last; a prefix over these few rows per run tells what each run begins with, and
only the rows ahead of the first word of their run are joined with it.

A row follows another in a run only if it is the very next of the same split, so the
result does not depend on how the rows are dealt to tasks; rows in any other order make
more and shorter runs.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from snapfold.functions.text import column
from snapfold.session import scratch_dir

TOLD, UNTOLD, LAST = 0, 1, 2
WRITERS = "spark.sql.maxConcurrentOutputFileWriters"


def fill_scanned(
    df: DataFrame,
    file: str,
    order: tuple[str, str],
    columns: Sequence[str],
    restart: Column | None = None,
    skip: Column | None = None,
    folder: str | None = None,
) -> DataFrame:
    """``forward_fill`` in each ``file`` for rows numbered by split and row, the ``order``, as the file sources do.

    Rows where ``skip`` is true stay as they are and say nothing; they must not be filtered out before, as they count.
    The rows are stored once in a new ``folder``, in scratch unless given, filled but for the first few of each run.
    """
    present = [c for c in columns if c in df.columns]
    if len(present) > 62:
        raise ValueError("at most 62 columns can be filled at once")
    block, row = order
    false = F.lit(False)
    flags = [false if c is None else F.coalesce(c, false) for c in (restart, skip)]
    number = F.lit(None).cast("long")
    cells = [column(c).alias(f"c{i}") for i, c in enumerate(present)]
    result = df.select(*cells, number.alias("run"), number.alias("untold"), F.lit(None).cast("int").alias("kind")).schema

    # A nested function travels to the executors by value, so they need no copy of this package.
    def fill(batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext

        context = TaskContext.get()
        run, before, told, state = ((context.partitionId() if context else 0) << 33) - 1, None, 0, {}

        for *marks, columns in ((*b[:6], b[6:]) for b in batches):
            files, block, row, begins, skipped, nameless = (a.to_numpy(zero_copy_only=False) for a in marks)
            n = len(files)
            if not n:
                continue
            place = np.arange(n)
            breaks = np.ones(n, bool)
            breaks[1:] = (files[1:] != files[:-1]) | (block[1:] != block[:-1]) | (row[1:] != row[:-1] + 1) | nameless[1:]
            breaks[0] = nameless[0] or before != (files[0], block[0], row[0] - 1)
            if breaks[0]:
                told, state = 0, {}
            runs = run + np.cumsum(breaks)
            since = np.maximum.accumulate(np.where(breaks, place, -1))  # the first row of a run, -1 for the one from the batch before
            filled, untold, gaps, ends = [], np.zeros(n, np.int64), 0, {}
            for i, values in enumerate(columns):
                said = (begins | values.is_valid().to_numpy(zero_copy_only=False)) & ~skipped
                at = np.maximum.accumulate(np.where(said, place, -1))
                at[at < since] = -1
                known = pa.concat_arrays([state.get(i, pa.nulls(1, values.type)), values])
                # Place 0 is what the batches before have said; a run that begins in this one has nothing of it.
                from_before = (since < 0) & bool(told >> i & 1)
                missing = (at < 0) & ~from_before & ~skipped
                source = np.where(skipped, place + 1, np.where(at >= 0, at + 1, 0))
                filled.append(known.take(pa.array(source, mask=missing)))
                untold |= np.where(missing, np.int64(1) << i, 0)
                if at[-1] >= 0 or from_before[-1]:
                    ends[i] = known.slice(at[-1] + 1, 1)
                    gaps |= 1 << i
            # The last row of a run that is not skipped says what the run leaves; the last of a batch may be that.
            counted = np.maximum.accumulate(np.where(skipped, -1, place))[np.append(breaks[1:], True)]
            last = np.zeros(n, bool)
            last[counted[counted >= np.maximum(since[np.append(breaks[1:], True)], 0)]] = True
            kind = np.where(untold != 0, UNTOLD, TOLD) + np.where(last, LAST, 0)
            yield pa.StructArray.from_arrays(
                [*filled, pa.array(runs), pa.array(untold), pa.array(kind.astype(np.int32))], names=[f.name for f in result]
            )
            run, before, told, state = int(runs[-1]), (files[-1], block[-1], row[-1]), gaps, ends

    # Only what is filled goes through Python; the rows wait for it.
    together = F.arrow_udf(fill, result).asNondeterministic()
    place = (F.xxhash64(column(file)), column(block), column(row))
    spark = df.sparkSession
    folder = folder or scratch_dir(spark, "filled")
    rest = [column(c) for c in df.columns if c not in present]
    passed = df.select(*rest, together(*place, *flags, column(file).isNull(), *cells).alias("_filled"))
    stored_as = passed.select(
        *[F.col("_filled")[f"c{present.index(c)}"].alias(c) if c in present else column(c) for c in df.columns],
        *[F.col("_filled")[f].alias(f"_{f}") for f in ("run", "untold", "kind")],
    )
    earlier = spark.conf.get(WRITERS)
    # Four open files a task, so that rows need no sort by kind.
    spark.conf.set(WRITERS, 4)
    try:
        stored_as.write.option("compression", "zstd").partitionBy("_kind").parquet(folder)
    finally:
        spark.conf.set(WRITERS, earlier)
    stored = spark.read.schema(stored_as.schema).parquet(folder)
    names = df.columns

    def said(i: int, name: str) -> Column:
        return F.when(F.col("_untold").bitwiseAND(F.lit(1 << i)) == 0, F.struct(column(name).alias("v")))

    runs = Window.partitionBy(column(file)).orderBy(column(block), column(row)).rowsBetween(Window.unboundedPreceding, -1)
    lasts = stored.where(F.col("_kind") >= LAST).withColumns({f"_said{i}": said(i, c) for i, c in enumerate(present)})
    before = [F.last(f"_said{i}", ignorenulls=True).over(runs).alias(f"_carry{i}") for i in range(len(present))]
    # The first of a run's rows here has only earlier runs before it.
    position = F.struct(column(block), column(row))
    carried = lasts.select("_run", position.alias("_at"), F.struct(*before).alias("_before")).groupBy("_run").agg(F.min_by("_before", "_at").alias("_b")).select("_run", "_b.*")
    # Few rows, but no fixed number: the planner picks the join.
    late = stored.where(F.col("_kind").isin(UNTOLD, UNTOLD + LAST)).join(carried, "_run", "left")

    def cell(name: str) -> Column:
        if name not in present:
            return column(name)
        i = present.index(name)
        lacking = F.col("_untold").bitwiseAND(F.lit(1 << i)) != 0
        return F.when(lacking, F.col(f"_carry{i}")["v"]).otherwise(column(name)).alias(name)

    whole = stored.where(F.col("_kind").isin(TOLD, TOLD + LAST)).select(*[column(c) for c in names])
    return whole.unionAll(late.select(*[cell(c) for c in names]))
