"""Files in, tables out: CSV snapshots, encodings, schema changes, streams, refreshes."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Window
from pyspark.sql import functions as F

from catalogue.base import once_per_session, query, table
from catalogue.drops import RANKED_LINES, ranked_lines, write_drop
from snapfold import functions as S
from snapfold import operators as O
from snapfold.session import scratch_dir
from snapfold.sources import FILE_ORDER, UTF_8, WINDOWS_1252, Dialect, KeyedTable, Lake, read_snapshots
from snapfold.streaming import stream_snapshots, upsert_latest, write_latest

EARLY, LATE = "20011001000000", "20011201000000"


@once_per_session
def order_files(spark, sf):
    """Two exports of every order; the earlier one has doubled prices."""
    folder = scratch_dir(spark, "orders")
    orders = table(spark, sf, "orders").select(
        F.year("o_orderdate").alias("_season"),
        F.col("o_orderkey").alias("_order"),
        F.col("o_orderkey").cast("string"),
        F.col("o_totalprice").cast("string"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("o_orderdate"),
        F.concat(F.lit(" "), "o_orderpriority", F.lit('"\r, \n"')).alias("o_orderpriority"),
    )
    for stamp, price in ((EARLY, F.col("o_totalprice").cast("double") * 2), (LATE, F.col("o_totalprice"))):
        export = orders.withColumns({"_stamp": F.lit(stamp), "o_totalprice": price.cast("string")})
        write_drop(export, folder, "Orders_{season}Season", ["_order"])
    return folder


ORDER_ROWS = f"""SELECT o_orderkey, year(o_orderdate)::INT AS season, exported::DATE AS exported,
        o_totalprice * factor AS o_totalprice, o_orderdate::DATE AS o_orderdate,
        ' ' || o_orderpriority || '"' || chr(13) || ', ' || chr(10) || '"' AS o_orderpriority
    FROM orders, (VALUES ('2001-10-01', 2), ('2001-12-01', 1)) AS t(exported, factor)"""


def _typed_orders(rows):
    return S.cast_all(
        rows,
        [S.CastSpec("o_orderkey", "long"), S.CastSpec("o_totalprice", "double"), S.CastSpec("o_orderdate", "date")],
    ).select(
        "o_orderkey",
        S.season_from_name(F.col("_source_file")).alias("season"),
        S.snapshot_ts(F.col("_source_file")).cast("date").alias("exported"),
        "o_totalprice",
        "o_orderdate",
        "o_orderpriority",
    )


@query("a1_csv_snapshots", ORDER_ROWS)
def csv_snapshots(spark, sf):
    return _typed_orders(read_snapshots(spark, f"{order_files(spark, sf)}/Orders_*Season*.csv"))


#: Lines of a large file. A file is written by one task, so that more lines make more files.
LINES_A_FILE = 2_000_000


@once_per_session
def large_export(spark, sf):
    """All order lines in large files: the order's cells on its first line only, and line feeds in the text of most lines."""
    folder = scratch_dir(spark, "large")
    lines = ranked_lines(spark, sf).selectExpr(
        "o_orderkey AS _order",
        "pos AS _pos",
        f"'{LATE}' AS _stamp",
        "CASE WHEN pos = 1 THEN CAST(o_orderkey AS string) END AS reference",
        "CASE WHEN pos = 1 THEN o_orderpriority END AS priority",
        "CAST(pos AS string) AS line",
        """concat(repeat('"', CAST(pos % 3 AS int)), p_name, repeat(concat(',', chr(10)), CAST(pos % 4 AS int)), '; ', p_type) AS note""",
    )
    files = -(-table(spark, sf, "lineitem").count() // LINES_A_FILE)
    write_drop(lines, folder, "Lines", ["_order", "_pos"], parts=max(files, 1))
    return folder


#: Every file is read in splits, however small.
IN_SPLITS = replace(WINDOWS_1252, split_over=0)


@query(
    "a1_large_export",
    f"""SELECT CASE WHEN pos = 1 THEN o_orderkey END AS reference, pos::BIGINT AS line, CASE WHEN pos = 1 THEN o_orderpriority END AS priority,
        repeat('"', (pos % 3)::INT) || p_name || repeat(',' || chr(10), (pos % 4)::INT) || '; ' || p_type AS note, true AS in_order
    FROM ({RANKED_LINES})""",
)
def large_export_rows(spark, sf):
    """A file with line feeds in cells, read by many tasks; every line of an order comes after the one before it."""
    rows = read_snapshots(spark, f"{large_export(spark, sf)}/*.csv", IN_SPLITS)
    line = S.safe_cast("line", "long")
    before = F.lag(line).over(Window.partitionBy("_source_file", "_block_start").orderBy("_row_seq"))
    return rows.select(
        S.safe_cast("reference", "long").alias("reference"),
        line.alias("line"),
        "priority",
        "note",
        F.coalesce((line == 1) | (line == before + 1), F.lit(True)).alias("in_order"),
    )


@once_per_session
def stored_lines(spark, sf):
    """The large export as an ingest table."""
    lake = Lake(spark, scratch_dir(spark, "large-lake"))
    stream_snapshots(lake, large_export(spark, sf), "Lines_*.csv", "lines", IN_SPLITS).awaitTermination()
    return lake.ingested("lines")


@query(
    "i3_large_export_fill",
    f"""SELECT o_orderkey AS reference, pos::BIGINT AS line, o_orderpriority AS priority, length(p_name)::INT AS n FROM ({RANKED_LINES})""",
)
def large_export_fill(spark, sf):
    """Every line with the cells of its order, filled in the order of the file by a scan without a shuffle."""
    lines = stored_lines(spark, sf)
    filled = O.fill_scanned(lines, "_source_file", FILE_ORDER, ["reference", "priority"], restart=F.col("reference").isNotNull())
    return filled.select(
        S.safe_cast("reference", "long").alias("reference"),
        S.safe_cast("line", "long").alias("line"),
        "priority",
        F.length(F.regexp_extract("note", '^"*([^",;]*)', 1)).alias("n"),
    )


@query(
    "i2_large_export_groups",
    "SELECT l_orderkey AS reference, count(*) AS lines FROM lineitem GROUP BY 1",
)
def large_export_groups(spark, sf):
    """Lines per parent row: a group is told by the place of its first row, filled down like any cell."""
    place = F.when(F.col("reference").isNotNull(), F.struct(*FILE_ORDER))
    lines = stored_lines(spark, sf).withColumn("_group", place)
    grouped = O.fill_scanned(lines, "_source_file", FILE_ORDER, ["_group"]).groupBy("_source_file", "_group")
    return grouped.agg(F.max("reference").cast("long").alias("reference"), F.count(F.lit(1)).alias("lines")).select("reference", "lines")


@once_per_session
def document_files(spark, sf):
    """Every document in both encodings, with a label full of windows-1252 characters."""
    folder = scratch_dir(spark, "documents")
    documents = table(spark, sf, "documents").select(
        F.col("doc_id").alias("_order"),
        F.col("doc_id").cast("string"),
        "text",
        F.concat(F.lit("“naïve” – 5 € "), "lang").alias("label"),
        F.lit(LATE).alias("_stamp"),
    )
    encodable = ~F.col("text").rlike("[^\\x00-\\x7F\\xA0-\\xFF]")
    write_drop(documents.filter(encodable), folder, "Western", ["_order"], WINDOWS_1252, quote_all=True)
    write_drop(documents, folder, "Unicode", ["_order"], UTF_8, quote_all=True)
    return folder


@query(
    "a2_encodings",
    r"""SELECT doc_id, t.source, length(text) AS n_chars, sha256(text) AS digest, '“naïve” – 5 € ' || lang AS label
    FROM documents, (VALUES ('Western'), ('Unicode')) AS t(source)
    WHERE t.source = 'Unicode' OR NOT regexp_matches(text, '[^\x00-\x7F\x{A0}-\x{FF}]')""",
)
def encodings(spark, sf):
    folder = document_files(spark, sf)
    parts = [
        read_snapshots(spark, f"{folder}/{name}_*.csv", dialect).withColumn("source", F.lit(name))
        for name, dialect in (("Western", WINDOWS_1252), ("Unicode", UTF_8))
    ]
    return parts[0].unionByName(parts[1]).select(
        S.safe_cast("doc_id", "long").alias("doc_id"),
        "source",
        F.length("text").cast("long").alias("n_chars"),
        F.sha2("text", 256).alias("digest"),
        "label",
    )


@once_per_session
def part_files(spark, sf):
    """Three exports of every part: a header, a reordered and wider one, a narrower one."""
    folder = scratch_dir(spark, "parts")
    part = table(spark, sf, "part").withColumns({"_order": F.col("p_partkey")})
    headers = {
        "20240101000000": ["p_partkey", "p_name", "p_brand"],
        "20240102000000": ["p_brand", "p_type", "p_partkey", "p_name"],
        "20240103000000": ["p_name", "p_partkey"],
    }
    for stamp, columns in headers.items():
        write_drop(part.select("_order", *columns).withColumn("_stamp", F.lit(stamp)), folder, "Parts", ["_order"])
    return folder


@query(
    "a3_changing_headers",
    """SELECT DATE '2024-01-01' AS exported, p_partkey, p_name, p_brand, NULL AS p_type FROM part
    UNION ALL SELECT DATE '2024-01-02', p_partkey, p_name, p_brand, p_type FROM part
    UNION ALL SELECT DATE '2024-01-03', p_partkey, p_name, NULL, NULL FROM part""",
)
def changing_headers(spark, sf):
    rows = read_snapshots(spark, f"{part_files(spark, sf)}/Parts_*.csv")
    return rows.select(
        S.snapshot_ts(F.col("_source_file")).cast("date").alias("exported"),
        S.safe_cast("p_partkey", "long").alias("p_partkey"),
        "p_name",
        "p_brand",
        "p_type",
    )


@once_per_session
def ragged_files(spark, sf):
    """Every customer; some lines have a cell too many or too few."""
    folder = scratch_dir(spark, "ragged")
    lines = table(spark, sf, "customer").selectExpr(
        "c_custkey AS _order",
        f"'{LATE}' AS _stamp",
        """CASE c_custkey % 5 WHEN 0 THEN concat_ws(',', c_custkey, c_name, c_mktsegment, 'surplus')
            WHEN 1 THEN concat_ws(',', c_custkey, c_name)
            ELSE concat_ws(',', c_custkey, c_name, c_mktsegment) END AS `c_custkey,c_name,c_mktsegment`""",
    )
    # One column under another delimiter: lines are written as they are.
    write_drop(lines, folder, "Ragged", ["_order"], Dialect(delimiter="\t"))
    return folder


@query(
    "a4_rescued_rows",
    """SELECT c_custkey, c_name, CASE WHEN c_custkey % 5 <> 1 THEN c_mktsegment END AS c_mktsegment,
        CASE c_custkey % 5 WHEN 0 THEN concat_ws(',', c_custkey, c_name, c_mktsegment, 'surplus')
            WHEN 1 THEN concat_ws(',', c_custkey, c_name) END AS rescued
    FROM customer""",
)
def rescued_rows(spark, sf):
    rows = read_snapshots(spark, f"{ragged_files(spark, sf)}/*.csv")
    return rows.select(
        S.safe_cast("c_custkey", "long").alias("c_custkey"),
        "c_name",
        "c_mktsegment",
        F.col("_rescued_data").alias("rescued"),
    )


@query("q1_stream_ingest", ORDER_ROWS)
def stream_ingest(spark, sf):
    """Two runs of the stream: the second takes in only what the first has not seen."""
    folder = order_files(spark, sf)
    lake = Lake(spark, scratch_dir(spark, "stream"))
    for pattern in (f"Orders_*_{EARLY}.csv", "Orders_*.csv"):
        stream_snapshots(lake, folder, pattern, "orders", files_per_batch=20).awaitTermination()
    return _typed_orders(lake.ingested("orders"))


@query(
    "q1_full_reload",
    """SELECT year(o_orderdate)::INT AS season, count(*) * 2 AS rows, sum(o_totalprice::DECIMAL(18, 2) * 3)::DOUBLE AS billed
    FROM orders GROUP BY 1""",
)
def full_reload(spark, sf):
    """A run under a new name replaces the table instead of adding to it."""
    folder = order_files(spark, sf)
    lake = Lake(spark, scratch_dir(spark, "reload"))
    for run in ("initial", "again"):
        stream_snapshots(lake, folder, "Orders_*.csv", "orders", run=run).awaitTermination()
    orders = _typed_orders(lake.ingested("orders"))
    return orders.groupBy("season").agg(
        F.count(F.lit(1)).alias("rows"), S.from_cents(F.sum(S.to_cents(F.col("o_totalprice")))).alias("billed")
    )


@query(
    "q2_stream_latest",
    """SELECT o_custkey, o_orderkey, o_totalprice FROM (
        SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS r FROM orders)
    WHERE r = 1""",
)
def stream_latest(spark, sf):
    stream = (
        spark.readStream.schema(table(spark, sf, "orders").schema)
        .option("pathGlobFilter", "orders.parquet")
        .parquet(sf)
    )
    target = scratch_dir(spark, "latest")
    write_latest(
        stream.select("o_custkey", "o_orderkey", "o_totalprice", "o_orderdate"),
        ["o_custkey"],
        ["o_orderdate", "o_orderkey"],
        target,
        scratch_dir(spark, "latest-state"),
    ).awaitTermination()
    return spark.read.parquet(target).select("o_custkey", "o_orderkey", "o_totalprice")


@query(
    "q2_stream_upsert",
    """SELECT o_custkey, o_orderkey, o_totalprice FROM (
        SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS r FROM orders
        WHERE year(o_orderdate) < 2001 OR o_custkey % 50 = 0)
    WHERE r = 1""",
)
def stream_upsert(spark, sf):
    """Two runs of a stream into a table of one row a customer; the second has orders of a few customers only."""
    source, orders = scratch_dir(spark, "orders-stream"), table(spark, sf, "orders")
    latest = KeyedTable(spark, scratch_dir(spark, "latest-by-key"), ("o_custkey",), buckets=32)
    columns = ["o_custkey", "o_orderkey", "o_totalprice", "o_orderdate"]
    checkpoint = scratch_dir(spark, "upsert-state")
    for some in ("year(o_orderdate) < 2001", "year(o_orderdate) >= 2001 AND o_custkey % 50 = 0"):
        orders.where(some).select(*columns).write.mode("append").parquet(source)
        stream = spark.readStream.schema(orders.select(*columns).schema).parquet(source)
        upsert_latest(stream, ["o_custkey"], ["o_orderdate", "o_orderkey"], latest, checkpoint).awaitTermination()
    return latest.read().select("o_custkey", "o_orderkey", "o_totalprice")


@query(
    "h3_stored_sketches",
    "SELECT year(o_orderdate)::INT AS season, count(DISTINCT o_custkey) AS customers, true AS within_two_percent FROM orders GROUP BY 1",
)
def stored_sketches(spark, sf):
    """Customers of a season from the stored sketches of its exports, against the exact count; one export came twice, one late."""
    orders = table(spark, sf, "orders").selectExpr("year(o_orderdate) AS season", "month(o_orderdate) AS export", "o_custkey", "1L AS taken")
    stored = KeyedTable(spark, scratch_dir(spark, "sketches"), ("season", "export"), buckets=8)
    for some in ("export <> 12", "export IN (6, 12)"):
        new = O.distinct_sketches(orders.where(some), ["season", "export", "taken"], "o_custkey")
        stored.upsert(new, ["taken"], ["season", "export"])
    about = O.merged_distinct(stored.read(), ["season"], "about")
    exact = orders.groupBy("season").agg(F.count_distinct("o_custkey").alias("customers"))
    close = F.abs(F.col("about") - F.col("customers")) <= 0.02 * F.col("customers")
    return exact.join(about, "season").select("season", "customers", close.alias("within_two_percent"))


@query(
    "v1_rows_per_export",
    """SELECT year(o_orderdate)::INT AS season, exported::DATE AS exported, count(*) AS rows, true AS ingested
    FROM orders, (VALUES ('2001-10-01'), ('2001-12-01')) AS t(exported) GROUP BY 1, 2""",
)
def rows_per_export(spark, sf):
    lake = Lake(spark, scratch_dir(spark, "audit"))
    stream_snapshots(lake, order_files(spark, sf), "Orders_*.csv", "orders").awaitTermination()
    # An export consists of one or more files.
    return (
        lake.ingested_files("orders")
        .groupBy(
            S.season_from_name(F.col("_source_file")).alias("season"),
            S.snapshot_ts(F.col("_source_file")).cast("date").alias("exported"),
        )
        .agg(F.sum("rows").alias("rows"), F.max("ingested").isNotNull().alias("ingested"))
    )


@query(
    "w1_refreshed_view",
    """SELECT c_custkey, c_name, c_mktsegment, c_acctbal FROM customer""",
)
def refreshed_view(spark, sf):
    lake = Lake(spark, scratch_dir(spark, "views"))
    customers = table(spark, sf, "customer").select("c_custkey", "c_name", "c_mktsegment", "c_acctbal")
    for frame in (customers.withColumn("c_acctbal", F.col("c_acctbal") * 2), customers):
        lake.refresh(frame, "silver", "customers", ["c_mktsegment"])
    return lake.scan("silver", "customers")
