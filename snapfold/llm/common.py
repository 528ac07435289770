"""Shared helpers: staged tables, bounded batches, row identity."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snapfold.session import scratch_dir

#: ASCII white space, the word separators of all word operators here.
WORD = r"[^\x20\x09-\x0D]+"

#: Text bytes handled at once inside a task.
SLICE_BYTES = 4 << 20
#: The same where distinct chunks of text are looked up, which larger pieces make fewer of.
ENCODE_BYTES = 8 << 20


def stage(df: DataFrame, label: str, codec: str = "zstd") -> DataFrame:
    """Write ``df`` below the shared checkpoint folder and read it back.

    Cuts lineage the recoverable way: a lost executor takes nothing with it.
    The shuffle files of the finished write are released at once.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, label)
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, "false")
    spark.conf.set(key, "true")
    try:
        df.write.option("compression", codec).parquet(path)
    finally:
        spark.conf.set(key, before)
    table = spark.read.schema(df.schema).parquet(path)
    table.staged_path = path
    return table


def discard(*tables: DataFrame) -> None:
    """Free the files of staged tables that nothing reads any more, by overwriting them with no rows."""
    for staged in tables:
        empty = staged.sparkSession.createDataFrame([], staged.schema)
        empty.write.mode("overwrite").parquet(staged.staged_path)


def slices(batches: Iterator[pa.RecordBatch], column: str, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut record batches so that ``column`` holds about ``most`` bytes in each piece.

    A row is never cut, so a text longer than ``most`` makes a piece of its own.
    """
    for batch in batches:
        if batch.num_rows == 0:
            continue
        sizes = pa.compute.fill_null(pa.compute.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        start = held = 0
        for i, size in enumerate(sizes.tolist()):
            if held and held + size > most:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += size
        yield batch.slice(start)


def batch_of(schema: pa.Schema, *columns) -> pa.RecordBatch:
    """A record batch from arrays or sequences in schema order."""
    return pa.RecordBatch.from_arrays(
        [c if isinstance(c, (pa.Array, pa.ChunkedArray)) else pa.array(c, type=f.type) for c, f in zip(columns, schema, strict=True)],
        schema=schema,
    )


def null(kind: str) -> F.Column:
    """A null of a type, for the schemas of Python outputs: a literal that is not null would make its column so."""
    return F.lit(None).cast(kind)


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores added while ``df`` has such a column (case-insensitively)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def slots(spark: SparkSession, rows: int, each: int) -> int:
    """Partitions for ``rows`` rows at ``each`` rows a task, not fewer than the session's own number."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // each))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(column) -> F.Column:
    """Lower-case A to Z only."""
    return F.translate(column, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
