"""Parquet tables below one root folder."""

from __future__ import annotations

import time
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from urllib.parse import quote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snapfold.functions.text import column
from snapfold.sources.snapshots import INGEST_TS, PROVENANCE

BATCH = "_batch_id"
SEASON = "_season"
RUN = "_run"
#: Which run a table (or season) shows, and since when.
POINTER = "season int, run string, since long"
#: The run of batches that are added without one.
FIRST_RUN = "initial"


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a folder is there, asked of the store that Spark itself would read."""
    try:
        spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    except AnalysisException:
        return False
    return True


@dataclass(frozen=True)
class Lake:
    """Where the datasets live: ``<root>/<layer>/<name>``."""

    spark: SparkSession
    root: str

    def path(self, layer: str, name: str) -> str:
        return f"{self.root.rstrip('/')}/{layer}/{name}"

    def scan(self, layer: str, name: str) -> DataFrame:
        """A view refreshed earlier."""
        return self.spark.read.parquet(self.path(layer, name))

    def refresh(
        self, df: DataFrame, layer: str, name: str, partition_by: Sequence[str] = (), more: bool = False
    ) -> DataFrame:
        """Replace the view by the frame's rows, or with ``more`` add them to it, and give it back as stored.

        Partitions get files by their size: a large one several, a small one a single file,
        and not one for each task that holds some of its rows.
        """
        mode = "append" if more else "overwrite"
        if partition_by:
            writer = df.hint("rebalance", *partition_by).write.mode(mode).partitionBy(*partition_by)
        else:
            writer = df.write.mode(mode)
        writer.option("compression", "zstd").parquet(self.path(layer, name))
        return self.scan(layer, name)

    # Ingest tables grow batch by batch and gain columns as exports do.  The
    # columns of each batch are noted next to the data, so a scan knows the full
    # schema without opening every file's footer.  Every run of an ingest has folders
    # of its own, and a pointer says which run a table (or season) shows.

    def append_batch(
        self, df: DataFrame, name: str, batch: int, season: int | None = None, more: bool = False, run: str | None = None
    ) -> None:
        """Add one ingest batch to a run, the one shown unless given, and to one season of the table if it has seasons.

        Repeating a batch replaces it.  Batch 0 starts the run's table (or season).
        A batch of several frames is one frame and then others with ``more``.
        """
        run = run or self._shown(name).get(season, FIRST_RUN)
        fields = [(i, f.name, f.dataType.simpleString()) for i, f in enumerate(df.schema)]
        noted = self.spark.createDataFrame(fields, "position int, name string, type string")
        for frame, part in ((noted.coalesce(1), "columns"), (df, "rows")):  # the rows are all text, which zstd halves
            folder = f"{self._ingest_path(name, part)}/{RUN}={quote(run, safe='')}"
            if season is not None:
                folder = f"{folder}/{SEASON}={season}"
            if more:
                frame.write.mode("append").option("compression", "zstd").parquet(f"{folder}/{BATCH}={batch}")
            elif batch == 0:
                (
                    frame.withColumn(BATCH, F.lit(0))
                    .write.mode("overwrite")
                    .option("partitionOverwriteMode", "static")
                    .option("compression", "zstd")
                    .partitionBy(BATCH)
                    .parquet(folder)
                )
            else:
                frame.write.mode("overwrite").option("compression", "zstd").parquet(f"{folder}/{BATCH}={batch}")

    def clear(self, name: str, season: int | None = None, run: str | None = None) -> None:
        """Leave no row in a run of an ingest table, or in one season of it."""
        kinds = ("string", "timestamp", "string", "long", "long")
        schema = ", ".join(f"{c} {kind}" for c, kind in zip(PROVENANCE, kinds))
        self.append_batch(self.spark.createDataFrame([], schema), name, 0, season, run=run)

    def show(self, name: str, run: str, season: int | None = None) -> None:
        """Let a table (or season) show a run from now on: one small file, there as a whole or not at all."""
        row = self.spark.createDataFrame([(season, run, time.time_ns())], POINTER)
        row.coalesce(1).write.mode("append").parquet(self._ingest_path(name, "shown"))

    def shown_run(self, name: str, season: int | None = None) -> str | None:
        """The run a table (or season) shows, None before its first."""
        return self._shown(name).get(season)

    def free_old_runs(self, name: str) -> None:
        """Empty the folders of runs that are shown no more; for when nobody reads them any longer."""
        shown = self._shown(name)
        for season, run in {(r["season"], r["run"]) for r in self._pointers(name)}:
            if shown[season] != run:
                self.clear(name, season, run)

    def _pointers(self, name: str) -> list:
        path = self._ingest_path(name, "shown")
        pointers = self.spark.read.schema(POINTER)  # there may be no file yet while the first is written
        return pointers.parquet(path).collect() if exists(self.spark, path) else []  # a row for each run and season

    def _shown(self, name: str) -> dict[int | None, str]:
        return {r["season"]: r["run"] for r in sorted(self._pointers(name), key=lambda r: r["since"])}

    def _of_shown_runs(self, rows: DataFrame, name: str) -> DataFrame:
        """Rows of the runs shown, by their folders."""
        shown, run = self._shown(name), F.col(RUN)
        if SEASON not in rows.columns:
            return rows.where(run == shown.get(None, FIRST_RUN))
        season, known = F.col(SEASON), [s for s in shown if s is not None]
        chosen = ~season.isin(known) & (run == FIRST_RUN) if known else run == FIRST_RUN
        for one in sorted(set(shown.values())):
            chosen = chosen | ((run == one) & season.isin([s for s in known if shown[s] == one]))
        return rows.where(chosen)

    def has(self, name: str) -> bool:
        """Whether anything has been ingested under the name."""
        return exists(self.spark, self._ingest_path(name, "columns"))

    def ingested(self, name: str, after: Mapping[int | None, int] | None = None) -> DataFrame:
        """All rows of an ingest table; a column a batch lacks is NULL there.

        With ``after``, season to batch, only those of later batches, by their folders.
        """
        types, seasonal = {}, False
        for season, columns in self.ingested_columns(name).items():
            seasonal = seasonal or season is not None
            types.update({c: t for c, t in columns.items() if c not in types})
        stored = {**types, SEASON: "int"} if seasonal else types
        schema = ", ".join(f"`{c.replace('`', '``')}` {t}" for c, t in {**stored, RUN: "string", BATCH: "int"}.items())
        rows = self.spark.read.schema(schema).parquet(self._ingest_path(name, "rows"))
        for season, batch in (after or {}).items():
            later = F.col(BATCH) > batch
            rows = rows.where(later if season is None else (F.col(SEASON) != season) | later)
        return self._of_shown_runs(rows, name).select(*[column(c) for c in stored])

    def ingested_seasons(self, name: str) -> dict[int, DataFrame]:
        """The table season by season, each with just the columns its files had."""
        rows = self.ingested(name)
        every = set(rows.columns) - {SEASON}
        return {
            season: rows.filter(F.col(SEASON) == season).drop(*(every - set(columns)))
            for season, columns in sorted(self.ingested_columns(name).items())
        }

    def ingested_columns(self, name: str) -> dict[int | None, dict[str, str]]:
        """Season to column types, in order of first appearance."""
        path = self._ingest_path(name, "columns")
        fields = f"position int, name string, type string, {RUN} string"
        noted = self._of_shown_runs(self.spark.read.schema(fields).option("basePath", path).parquet(path), name)
        season = F.col(SEASON) if SEASON in noted.columns else F.lit(None).cast("int")
        first_seen = (
            noted.groupBy(season.alias("season"), "name", "type")
            .agg(F.min(F.struct(BATCH, "position")).alias("first_seen"))
            .collect()  # one row per season and column
        )
        # A header that changes its case is still that column, under its first spelling.
        spelling: dict[str, str] = {}
        columns: dict[int | None, dict[str, str]] = {}
        for row in sorted(first_seen, key=lambda r: (r.first_seen, r.season or 0)):
            name = spelling.setdefault(row["name"].lower(), row["name"])
            columns.setdefault(row.season, {}).setdefault(name, row.type)
        return columns

    def ingested_batches(self, name: str) -> dict[int | None, int]:
        """Season to its last batch, of the runs shown."""
        path = self._ingest_path(name, "columns")
        fields = f"position int, name string, type string, {RUN} string"
        noted = self._of_shown_runs(self.spark.read.schema(fields).option("basePath", path).parquet(path), name)
        season = F.col(SEASON) if SEASON in noted.columns else F.lit(None).cast("int")
        return {r["season"]: r["batch"] for r in noted.groupBy(season.alias("season")).agg(F.max(BATCH).alias("batch")).collect()}

    def ingested_files(self, name: str) -> DataFrame:
        """Rows and latest ingest time per source file, newest first."""
        return (
            self.ingested(name)
            .groupBy("_source_file")
            .agg(F.count(F.lit(1)).alias("rows"), F.max(INGEST_TS).alias("ingested"))
            .orderBy(F.desc("ingested"), "_source_file")
        )

    def _ingest_path(self, name: str, part: str) -> str:
        return f"{self.path('bronze', name)}/{part}"
