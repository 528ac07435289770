"""Tables with one row per key that are changed in place of being rewritten.

Rows lie in buckets by a hash of their key, and a bucket in folders by version.  A change
writes the buckets it touches under a new version and then says so in one small file, so
readers see the table before the change or after it, a crash leaves the one before, and the files of
other buckets are left alone.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from snapfold.functions.text import column
from snapfold.operators.dedup import latest_by_key
from snapfold.session import scratch_dir
from snapfold.sources.tables import exists

VERSION, BUCKET = "_version", "_bucket"


class Change(NamedTuple):
    """The rows of the changed keys before and after; a key that is new has none before, one that is gone none after."""

    before: DataFrame
    after: DataFrame


@dataclass(frozen=True)
class KeyedTable:
    """A table at ``path`` with a row for each value of ``keys``; the number of buckets is that of its first change."""

    spark: SparkSession
    path: str
    keys: tuple[str, ...]
    buckets: int = 64

    def versions(self) -> dict[int, int]:
        """Bucket to its version, for the buckets that have rows or had some."""
        path = f"{self.path}/shown"
        if not exists(self.spark, path):
            return {}
        shown = self.spark.read.schema("bucket int, version int").parquet(path)
        return {r["bucket"]: r["v"] for r in shown.groupBy("bucket").agg(F.max("version").alias("v")).collect()}  # a row for each bucket

    def read(self) -> DataFrame | None:
        """The rows as of now, None before the first change."""
        return self._rows(self.versions())

    def update(self, rows: DataFrame, fold: Callable[[DataFrame], DataFrame]) -> Change:
        """Bring ``rows`` into the table: ``fold`` makes one row a key of the rows held and the new ones.

        ``fold`` sees all rows of a bucket that new rows are in, or none.
        """
        shown = self.versions()
        number = 1 + max(shown.values(), default=0)
        # Stored once, as they are looked at several times.
        path = scratch_dir(self.spark, "incoming")
        rows.write.parquet(path)
        rows = self.spark.read.schema(rows.schema).parquet(path)
        incoming = rows.withColumn(BUCKET, self._bucket())
        touched = sorted(r[0] for r in incoming.select(BUCKET).distinct().collect())  # at most one for each bucket
        held = self._rows({b: v for b, v in shown.items() if b in touched})
        both = rows if held is None else held.unionByName(rows)
        folded = fold(both).select(*[column(c) for c in rows.columns])
        folder = f"{self.path}/rows/{VERSION}={number}"
        by_bucket = folded.withColumn(BUCKET, self._bucket())
        by_bucket.hint("rebalance", BUCKET).write.mode("overwrite").partitionBy(BUCKET).parquet(folder)
        said = self.spark.createDataFrame([(b, number) for b in touched], "bucket int, version int")
        said.coalesce(1).write.mode("append").parquet(f"{self.path}/shown")

        changed = rows.select(*[column(k).alias(f"_k{i}") for i, k in enumerate(self.keys)]).distinct()
        same = reduce(and_, [column(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(self.keys)])
        after = self._rows(dict.fromkeys(touched, number), rows)
        before = after.where(F.lit(False)) if held is None else held
        return Change(before.join(changed, same, "left_semi"), after.join(changed, same, "left_semi"))

    def upsert(self, rows: DataFrame, order: Sequence[Column | str], ties: Sequence[Column | str]) -> Change:
        """Keep the newest row of every key, of those held and the new ones."""
        return self.update(rows, lambda both: latest_by_key(both, list(self.keys), order, ties))

    def replace(self, rows: DataFrame) -> None:
        """Hold just these rows from now on; one row a key is taken for granted."""
        gone = {b for b in self.versions()}
        number = 1 + max(self.versions().values(), default=0)
        by_bucket = rows.withColumn(BUCKET, self._bucket()).hint("rebalance", BUCKET)
        by_bucket.write.mode("overwrite").partitionBy(BUCKET).parquet(f"{self.path}/rows/{VERSION}={number}")
        said = self.spark.createDataFrame([(b, number) for b in sorted(gone | set(range(self.buckets)))], "bucket int, version int")
        said.coalesce(1).write.mode("append").parquet(f"{self.path}/shown")

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(*[column(k) for k in self.keys]), F.lit(self.buckets)).cast("int")

    def _rows(self, versions: dict[int, int], like: DataFrame | None = None) -> DataFrame | None:
        """The rows of some buckets in some version, by their folders."""
        if not versions:
            return None
        numbers = sorted(set(versions.values()))
        found = []
        schema = "" if like is None else ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in like.schema) + f", {BUCKET} int"
        for number in numbers:
            folder = f"{self.path}/rows/{VERSION}={number}"
            reader = self.spark.read.schema(schema) if schema else self.spark.read
            if not schema and not any_file(self.spark, folder):
                continue  # a change that left none of its keys
            part = reader.parquet(folder)
            found.append(part.where(F.col(BUCKET).isin([b for b, v in versions.items() if v == number])).drop(BUCKET))
        return reduce(lambda a, b: a.unionByName(b), found) if found else None


def any_file(spark: SparkSession, folder: str) -> bool:
    """Whether a folder holds a table file, in the store that Spark itself would read."""
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(folder)
    return not listed.select("path").isEmpty()


def fold_totals(keys: Sequence[str], sums: Sequence[str], rows: str) -> Callable[[DataFrame], DataFrame]:
    """A fold that adds up ``sums`` and the count ``rows`` by key and drops keys that no row is left of."""

    def fold(both: DataFrame) -> DataFrame:
        added = both.groupBy(*[column(k) for k in keys]).agg(*[F.sum(column(s)).alias(s) for s in (*sums, rows)])
        return added.where(column(rows) != 0)

    return fold


def retraction(change: Change, keys: Sequence[str], sums: Sequence[str], rows: str) -> DataFrame:
    """What a change adds to totals by ``keys``: the rows after it less those before, for the keys it touches.

    Sums are of whole numbers or decimals, so that what was added can be taken away to the last digit; NULL adds nothing.
    """

    def signed(df: DataFrame, sign: int) -> DataFrame:
        return df.select(
            *[column(k) for k in keys], *[(F.coalesce(column(s), F.lit(0)) * sign).alias(s) for s in sums], F.lit(sign).cast("long").alias(rows)
        )

    both = signed(change.after, 1).unionByName(signed(change.before, -1))
    return both.groupBy(*[column(k) for k in keys]).agg(*[F.sum(column(s)).alias(s) for s in (*sums, rows)])
