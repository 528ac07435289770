"""File drops as a stream: every new file is ingested once."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from snapfold.sources.snapshots import WINDOWS_1252, Dialect, read_each
from snapfold.sources.tables import Lake, exists

# Schema of Spark's binary file source.  Only ``path`` and ``length`` are used, and
# the source reads no content that is not selected.
ARRIVALS = "path string, modificationTime timestamp, length long, content binary"


def stream_snapshots(
    lake: Lake,
    folder: str,
    pattern: str,
    table: str,
    dialect: Dialect = WINDOWS_1252,
    season: int | None = None,
    files_per_batch: int = 10_000,
    run: str = "initial",
) -> Ingest:
    """Ingest the files matching ``pattern`` that earlier runs have not seen.

    The stream is one of file arrivals, so its checkpoint remembers files and
    each micro-batch may bring new headers.  A micro-batch is written to its own
    folder, which makes a replay after a failure replace what it left behind.
    Stops when all present files are in.  With a ``season`` the rows go to that
    season of the table, which reads as its ``_season`` column.

    ``run`` names the checkpoint and the folders written.  A new name starts over with all
    files present, even if there is none, which is the full reload: until it is through, and
    after a crash, the table goes on showing the rows of the run before.
    """
    checkpoint = f"{lake.path('checkpoints', table)}/{season or 'all'}/{run}"
    shown = lake.shown_run(table, season)
    if shown is None:
        lake.show(table, run, season)
    if lake.has(table) and not exists(lake.spark, checkpoint):
        lake.clear(table, season, run)

    def ingest(arrivals: DataFrame, batch: int) -> None:
        # One header at a time, however many a batch brings.
        written = False
        for rows in read_each(arrivals, dialect):
            lake.append_batch(rows, table, batch, season, more=written, run=run)
            written = True
        if not written and batch == 0 and lake.has(table):
            lake.clear(table, season, run)

    query = (
        lake.spark.readStream.format("binaryFile")
        .schema(ARRIVALS)
        .option("pathGlobFilter", pattern)
        .option("maxFilesPerTrigger", files_per_batch)
        # A snapshot delivered late is still a snapshot: never age files out.
        .option("maxFileAge", "36500d")
        .load(folder)
        .select("path", "length")
        .writeStream.foreachBatch(ingest)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    return Ingest(query, lake, table, run, season)


@dataclass(frozen=True)
class Ingest:
    """A running ingest; the table shows its run once it has been awaited."""

    query: StreamingQuery
    lake: Lake
    table: str
    run: str
    season: int | None

    def awaitTermination(self) -> None:  # noqa: N802 - the name that streaming queries have
        """Wait until all present files are in; raises what went wrong, and then shows nothing new."""
        self.query.awaitTermination()
        if self.lake.shown_run(self.table, self.season) != self.run:
            self.lake.show(self.table, self.run, self.season)
