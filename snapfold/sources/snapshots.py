"""CSV snapshot files: every cell as text, with full provenance."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from itertools import groupby, islice

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from snapfold.functions.text import column
from snapfold.operators.conform import conform_union
from snapfold.session import emptied
from snapfold.sources import splits

SOURCE_FILE = "_source_file"
INGEST_TS = "_ingest_ts"
RESCUED = "_rescued_data"
# Position of a row in its file: byte offset of the file split it was read
# from, then the row number within the reading task.
FILE_ORDER = ("_block_start", "_row_seq")
PROVENANCE = (SOURCE_FILE, INGEST_TS, RESCUED, *FILE_ORDER)

# Paths named in one read, so that no list grows with the number of files.
FILES_PER_READ = 10_000


@dataclass(frozen=True)
class Dialect:
    """How the exporting system writes its files.

    ``multi_line`` allows line feeds inside quoted cells.  Files above
    ``split_over`` bytes are read by many tasks all the same (see ``sources.splits``), at
    the price of a scan of their quotes.  Where cells hold carriage returns at most and rows end
    in a line feed, switch ``multi_line`` off and no such scan is needed.
    """

    encoding: str = "windows-1252"
    multi_line: bool = True
    delimiter: str = ","
    quote: str = '"'
    escape: str = '"'
    trim: bool = True
    split_over: int = 64 << 20

    @property
    def is_windows_1252(self) -> bool:
        return self.encoding.lower() in {"windows-1252", "cp1252"}

    @property
    def splits(self) -> bool:
        """Whether large files can be cut at line feeds: single-byte marks, quotes escaped by doubling."""
        marks = len(self.delimiter.encode()) == len(self.quote.encode()) == 1
        return self.multi_line and marks and self.escape == self.quote and self.charset is not None

    @property
    def charset(self) -> str | None:
        """The encoding as Spark decodes it, if a line feed is always the byte 10 in it."""
        known = {"utf-8": "UTF-8", "utf8": "UTF-8", "iso-8859-1": "ISO-8859-1", "latin-1": "ISO-8859-1", "us-ascii": "US-ASCII"}
        return "ISO-8859-1" if self.is_windows_1252 else known.get(self.encoding.lower())

    def reader_options(self) -> dict[str, str]:
        options = {
            "header": "true",
            "sep": self.delimiter,
            "quote": self.quote,
            "escape": self.escape,
            "multiLine": str(self.multi_line).lower(),
            "ignoreLeadingWhiteSpace": str(self.trim).lower(),
            "ignoreTrailingWhiteSpace": str(self.trim).lower(),
            # Spark has no windows-1252 decoder: read the bytes one to one,
            # see decode_windows_1252.
            "encoding": "ISO-8859-1" if self.is_windows_1252 else self.encoding,
            "mode": "PERMISSIVE",
            "columnNameOfCorruptRecord": RESCUED,
            # Ragged rows are recognised by their cell count, so every cell is
            # parsed whichever columns a query selects.
            "columnPruning": "false",
        }
        if not self.multi_line:
            options["lineSep"] = "\n"
        return options


WINDOWS_1252 = Dialect()
UTF_8 = Dialect(encoding="UTF-8")


def _windows_1252_pairs() -> tuple[str, str]:
    """Bytes 0x80 to 0x9F as Latin-1 text, and what windows-1252 means by them."""
    raw = bytes(range(0x80, 0xA0))
    return raw.decode("latin-1"), raw.decode("cp1252", errors="replace")


def decode_windows_1252(col: Column) -> Column:
    """Text read as ISO-8859-1 to what it says in windows-1252."""
    return _unless_ascii(col, F.translate(col, *_windows_1252_pairs()))


def encode_windows_1252(col: Column) -> Column:
    """The inverse, for writing: ISO-8859-1 bytes of the result are windows-1252."""
    latin, meant = _windows_1252_pairs()
    defined = [(m, l) for l, m in zip(latin, meant) if m != "\ufffd"]
    return _unless_ascii(col, F.translate(col, "".join(m for m, _ in defined), "".join(l for _, l in defined)))


def _unless_ascii(col: Column, translated: Column) -> Column:
    """``translated`` where a text has other characters than ASCII; looking each one up costs far more than counting them."""
    return F.when(F.octet_length(col) == F.char_length(col), col).otherwise(translated)


def list_files(spark: SparkSession, location: str | Sequence[str]) -> DataFrame:
    """``(path, length)`` of the files a glob matches; no content is read."""
    return spark.read.format("binaryFile").load(location).select("path", "length")


def read_headers(files: DataFrame, dialect: Dialect) -> DataFrame:
    """``(path, length, header)`` for files with content.

    Tasks open the files and decode only the first record of each.
    """
    encoding = "utf-8-sig" if dialect.encoding.lower() in {"utf-8", "utf8"} else dialect.encoding
    delimiter, quote, trim = dialect.delimiter, dialect.quote, dialect.trim

    # A nested function travels to the executors by value, so they need no copy
    # of this package.
    def first_records(batches):
        import csv
        import io
        from urllib.parse import urlsplit

        import pandas as pd
        from pyarrow import fs

        def first_record(path):
            parts = urlsplit(path)
            if parts.scheme in {"", "file"}:
                filesystem, key = fs.LocalFileSystem(), path.removeprefix("file:")
            else:
                filesystem, key = fs.FileSystem.from_uri(path.replace("s3a://", "s3://", 1))
            with filesystem.open_input_stream(key) as stream:
                text = io.TextIOWrapper(stream, encoding=encoding, errors="replace", newline="")
                return next(csv.reader(text, delimiter=delimiter, quotechar=quote), None)

        def safe_names(cells):
            names, seen = [], set()
            for position, cell in enumerate(cells):
                name = (cell.strip() if trim else cell) or f"_c{position}"
                if name.lower() in seen:
                    name = f"{name}{position}"
                seen.add(name.lower())
                names.append(name)
            return names

        for batch in batches:
            found = [(path, length, first_record(path)) for path, length in zip(batch["path"], batch["length"])]
            yield pd.DataFrame(
                [(path, length, safe_names(cells)) for path, length, cells in found if cells],
                columns=["path", "length", "header"],
            )

    return files.select("path", "length").mapInPandas(first_records, "path string, length long, header array<string>")


def sorted_headers(files: DataFrame, dialect: Dialect) -> Iterator[Row]:
    """``read_headers`` by header and path, a partition at a time.

    Not an iterator of the frame: where a session frees the shuffles of what it has run, that of the sort would be
    freed while it is being read, and what is read of a shuffle that is gone can be an error or no rows at all.
    """
    return read_headers(files, dialect).sort("header", "path").rdd.toLocalIterator()


def read_snapshots(
    spark: SparkSession, location: str | Sequence[str], dialect: Dialect = WINDOWS_1252
) -> DataFrame:
    """All rows of the matching files as text, plus the provenance columns."""
    rows = read_files(list_files(spark, location), dialect)
    if rows is None:
        raise FileNotFoundError(f"no file with a header at {location}")
    return rows


def read_each(files: DataFrame, dialect: Dialect = WINDOWS_1252) -> Iterator[DataFrame]:
    """Rows of the files named in ``files.path``, a frame or two per header and so many files.

    Spark binds CSV cells to a given schema by position, so files of different
    headers are read apart.  File names and headers pass through the driver one
    frame at a time, as for any file listing; rows never do.

    A frame is good until the next is asked for; then the chunks of its large files are freed.
    """
    for rows, chunks in _frames(files, dialect):
        yield rows
        if chunks:
            emptied(files.sparkSession, chunks)


def _frames(files: DataFrame, dialect: Dialect) -> Iterator[tuple[DataFrame, str | None]]:
    """The frames of ``read_each``, and the folder of chunks that a frame reads."""
    spark = files.sparkSession
    headers = sorted_headers(files, dialect)
    for header, found in groupby(headers, key=lambda r: r.header):
        while some := list(islice(found, FILES_PER_READ)):
            large = {r.path for r in some if dialect.splits and r.length > dialect.split_over}
            if large:
                rows, stray, chunks = _read_in_splits(spark, sorted(large), header, dialect)
                large -= stray
                if large:
                    yield rows, chunks
                else:
                    emptied(spark, chunks)
            if whole := [r.path for r in some if r.path not in large]:
                yield _read_one(spark, whole, header, dialect), None


def read_files(files: DataFrame, dialect: Dialect = WINDOWS_1252) -> DataFrame | None:
    """The frames of ``read_each`` united by name; None where no file has a header.

    A column a file lacks is NULL in its rows; names that differ in case only are one column.
    """
    frames = [rows for rows, _ in _frames(files, dialect)]
    return conform_union(frames) if frames else None


def _read_one(
    spark: SparkSession, paths: Sequence[str], header: Sequence[str], dialect: Dialect
) -> DataFrame:
    fields = [*header, RESCUED]
    rows = (
        spark.read.schema(_schema(fields))
        .options(**dialect.reader_options())
        .csv([_literal_path(p) for p in paths])
    )
    return rows.select(
        *_cells(fields, dialect),
        F.col("_metadata.file_path").alias(SOURCE_FILE),
        F.current_timestamp().alias(INGEST_TS),
        F.col("_metadata.file_block_start").alias(FILE_ORDER[0]),
        F.monotonically_increasing_id().alias(FILE_ORDER[1]),
    )


def _read_in_splits(
    spark: SparkSession, paths: Sequence[str], header: Sequence[str], dialect: Dialect
) -> tuple[DataFrame | None, set[str], str]:
    """Rows of large files read by many tasks, the paths that have to be read whole for a stray quote, and the folder of the chunks."""
    chunks = splits.stored_chunks(spark, [_literal_path(p) for p in paths], dialect.delimiter, dialect.quote, dialect.trim)
    states = splits.chunk_states(chunks)
    of_file = states.groupBy("file").agg(
        F.bool_or("stray").alias("stray"),
        F.bool_or(F.col("crlf") & (F.col("block") == 0) & (F.col("chunk") == 0)).alias("crlf"),
        F.count("*").alias("chunks"),
    )
    # A row for each file: its name as Spark gives it, which its chunks know by a hash.
    listed = spark.read.format("binaryFile").load([_literal_path(p) for p in paths])
    names = listed.select("path", F.col("_metadata.file_path").alias(SOURCE_FILE), splits.file_id().alias("file"))
    clean = [r for r in names.join(of_file, "file").collect() if not r["stray"]]
    # A file without a line has no chunk and is read like any other.
    stray = set(paths) - {r["path"] for r in clean}
    if not clean:
        return None, stray, chunks.staged_path

    known = spark.createDataFrame([(r["file"], r[SOURCE_FILE], r["crlf"]) for r in clean], f"file long, {SOURCE_FILE} string, crlf boolean")
    known = F.broadcast(known)  # at most FILES_PER_READ rows
    of_clean = states.drop("crlf").join(known.select("file"), "file")
    found = splits.records(chunks, of_clean, dialect.quote, sum(r["chunks"] for r in clean))
    text = F.rtrim(F.decode("record", dialect.charset), F.lit("\r\n"))
    # Rows that end in both are read with line feeds only, as Spark's parser does with a whole file.
    normal = F.when(F.col("crlf"), F.replace(text, F.lit("\r\n"), F.lit("\n"))).otherwise(text)
    fields = [*header, RESCUED]
    options = {**dialect.reader_options(), "multiLine": "false"}
    rows = (
        found.join(known, "file")
        .where((F.col("block") > 0) | (F.col("seq") > 1))  # the header
        .withColumn("text", normal)
        .where("text <> ''")
        .withColumn("cells", F.from_csv("text", _schema(fields), options))
    )
    return rows.select("cells.*", SOURCE_FILE, "block", "seq").select(
        *_cells(fields, dialect),
        SOURCE_FILE,
        F.current_timestamp().alias(INGEST_TS),
        F.col("block").alias(FILE_ORDER[0]),
        F.col("seq").alias(FILE_ORDER[1]),
    ), stray, chunks.staged_path


def _schema(fields: Sequence[str]) -> str:
    return ", ".join("`" + f.replace("`", "``") + "` string" for f in fields)


def _cells(fields: Sequence[str], dialect: Dialect) -> list[Column]:
    decode = decode_windows_1252 if dialect.is_windows_1252 else (lambda c: c)
    return [decode(column(f)).alias(f) for f in fields]


def _literal_path(path: str) -> str:
    """Protect characters of a file name that a path glob would interpret."""
    return "".join("\\" + ch if ch in "\\*?[]{}" else ch for ch in path)
