import time

import pytest
from pyspark.sql import functions as F

from snapfold.functions import column
from snapfold.session import shuffles_released
from snapfold.sources import (
    FILE_ORDER,
    UTF_8,
    Dialect,
    decode_windows_1252,
    encode_windows_1252,
    read_snapshots,
    snapshots,
)
from tests.conftest import plan, rows


def put(folder, name, content, encoding="utf-8"):
    folder.mkdir(exist_ok=True)
    (folder / name).write_bytes(content.encode(encoding))


def test_dialect(spark, tmp_path):
    put(
        tmp_path,
        "a.csv",
        'id, text ,note\n1,"fee\rperson",x\n2,"a\r\nb",  padded  \n3,"say ""hi"", ok",\n4," kept ",""\n',
    )
    got = read_snapshots(spark, f"{tmp_path}/*.csv", UTF_8)
    assert rows(got.select("id", "text", "note", "_rescued_data")) == [
        ("1", "fee\rperson", "x", None),
        ("2", "a\r\nb", "padded", None),
        ("3", 'say "hi", ok', None, None),
        ("4", " kept ", None, None),
    ]
    provenance = got.select("_source_file", "_ingest_ts", *FILE_ORDER)
    assert [t for _, t in provenance.dtypes] == ["string", "timestamp", "bigint", "bigint"]
    assert provenance.filter("_source_file LIKE '%/a.csv' AND _ingest_ts IS NOT NULL").count() == 4


def test_encodings_agree(spark, tmp_path):
    text = "café “quoted” – 5 € Žluťoučký".replace("ť", "t").replace("č", "c")
    put(tmp_path, "west.csv", f"name é,v\n{text},1\n", "cp1252")
    put(tmp_path, "uni.csv", f"﻿name é,v\n{text},1\n", "utf-8")
    west = read_snapshots(spark, f"{tmp_path}/west.csv")
    uni = read_snapshots(spark, f"{tmp_path}/uni.csv", UTF_8)
    assert west.columns[:2] == uni.columns[:2] == ["name é", "v"]
    assert rows(west.select("name é")) == rows(uni.select("name é")) == [(text,)]


def test_windows_1252_round_trip(spark):
    meant = bytes(range(0x20, 0x100)).decode("cp1252", errors="ignore")
    df = spark.createDataFrame([(meant,)], "c string")
    encoded = df.select(encode_windows_1252(F.col("c")).alias("c"))
    assert encoded.first()[0].encode("latin-1") == meant.encode("cp1252")
    assert encoded.select(decode_windows_1252(F.col("c"))).first()[0] == meant


def test_windows_1252_leaves_ascii_cells_alone(spark, monkeypatch):
    cells = ["plain, \"text\"\n~", "", None, "caf\xe9", "\x93quoted\x94", "\x80", "a\x7f"]
    df = spark.createDataFrame([(c,) for c in cells], "c string")
    want = [c and c.encode("latin-1").decode("cp1252") for c in cells]
    assert [r[0] for r in df.select(decode_windows_1252(F.col("c"))).collect()] == want
    back = spark.createDataFrame([(c,) for c in want], "c string")
    assert [r[0] for r in back.select(encode_windows_1252(F.col("c"))).collect()] == cells
    # No character of a cell of ASCII is looked up.
    monkeypatch.setattr(snapshots.F, "translate", lambda *_: F.raise_error(F.lit("looked up")))
    ascii_ = df.where("c IS NOT NULL AND octet_length(c) = char_length(c)")
    for change in (decode_windows_1252, encode_windows_1252):
        assert [r[0] for r in ascii_.select(change(F.col("c"))).collect()] == [cells[0], "", "a\x7f"]


def test_headers_may_differ(spark, tmp_path):
    put(tmp_path, "1.csv", "id,name\n1,a\n")
    put(tmp_path, "2.csv", "name,extra,id\nb,x,2\n")
    put(tmp_path, "3.csv", '"id"\n3\n')
    put(tmp_path, "4.csv", '"wide\nname, too",id,id,\nv,4,5,6\n')
    put(tmp_path, "empty.csv", "")
    got = read_snapshots(spark, f"{tmp_path}/*.csv", UTF_8)
    cells = got.select("id", "name", "extra", column("wide\nname, too"), "id2", "_c3", "_rescued_data")
    assert rows(cells) == [
        ("1", "a", None, None, None, None, None),
        ("2", "b", "x", None, None, None, None),
        ("3", None, None, None, None, None, None),
        ("4", None, None, "v", "5", "6", None),
    ]


def test_ragged_rows_are_rescued(spark, tmp_path):
    put(tmp_path, "a.csv", "id,name\n1,a\n2\n3,c,surplus\n")
    got = read_snapshots(spark, f"{tmp_path}/*.csv", UTF_8)
    assert rows(got.select("id", "name", "_rescued_data")) == [("1", "a", None), ("2", None, "2"), ("3", "c", "3,c,surplus")]
    # Whatever is selected, a ragged row is recognised.
    assert rows(got.filter("_rescued_data IS NOT NULL").select("id")) == [("2",), ("3",)]


def test_glob_and_odd_file_names(spark, tmp_path):
    put(tmp_path, "Teams_2026Season-All(x) [1]_20260101000000.csv", "id\n1\n")
    put(tmp_path, "Other_2026Season_20260101000000.csv", "id\n2\n")
    assert rows(read_snapshots(spark, f"{tmp_path}/Teams_*.csv").select("id")) == [("1",)]
    with pytest.raises(FileNotFoundError):
        put(tmp_path, "Empty_1.csv", "")
        read_snapshots(spark, f"{tmp_path}/Empty_*.csv")


@pytest.mark.parametrize("multi_line", [True, False])
def test_row_order_is_file_order(spark, tmp_path, multi_line):
    """Also where a large file is read in splits by several tasks."""
    n = 4_000
    for name in ("a", "b"):
        put(tmp_path, f"{name}.csv", "n,t\n" + "".join(f'{i},"x\ry{i:09d}"\n' for i in range(n)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        got = read_snapshots(spark, f"{tmp_path}/*.csv", Dialect("UTF-8", multi_line=multi_line))
        assert (got.rdd.getNumPartitions() > 4) is not multi_line
        # Stored first: the order columns are fixed at the scan.
        got.write.parquet(str(tmp_path / "stored"))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    stored = spark.read.parquet(str(tmp_path / "stored")).repartition(5)
    for name in ("a", "b"):
        one = stored.filter(F.col("_source_file").endswith(f"{name}.csv")).orderBy(*FILE_ORDER)
        assert [int(r.n) for r in one.select("n").collect()] == list(range(n))
    assert stored.filter("_rescued_data IS NOT NULL").count() == 0


def test_refresh_replaces(spark, lake):
    first = spark.createDataFrame([(1, "x"), (2, "y")], "id int, k string")
    lake.refresh(first, "silver", "t", ["k"])
    again = lake.refresh(first.filter("id = 2"), "silver", "t", ["k"])
    assert rows(again) == [(2, "y")] and rows(lake.scan("silver", "t")) == [(2, "y")]
    lake.refresh(first, "silver", "t", ["k"])
    pruned = lake.scan("silver", "t").filter("k = 'x'")
    assert "PartitionFilters: [isnotnull(k" in plan(pruned)


def test_ingest_table_gains_columns(spark, lake):
    batch = lambda *r, schema: spark.createDataFrame(list(r), schema)
    lake.append_batch(batch(("1", "a"), schema="id string, `a b` string"), "t", 0, 2024)
    lake.append_batch(batch(("2", "z"), schema="id string, new string"), "t", 1, 2024)
    lake.append_batch(batch(("3",), schema="id string"), "t", 0, 2025)
    everything = lake.ingested("t")
    assert everything.columns == ["id", "a b", "new", "_season"]
    want = [("1", "a", None, 2024), ("2", None, "z", 2024), ("3", None, None, 2025)]
    assert rows(everything) == want
    assert {s: d.columns for s, d in lake.ingested_seasons("t").items()} == {
        2024: ["id", "a b", "new", "_season"],
        2025: ["id", "_season"],
    }
    # A repeated batch replaces itself, batch 0 starts the season over.
    lake.append_batch(batch(("2", "z"), schema="id string, new string"), "t", 1, 2024)
    assert rows(lake.ingested("t")) == want
    lake.append_batch(batch(("9", "a"), schema="id string, `a b` string"), "t", 0, 2024)
    assert rows(lake.ingested("t")) == [("3", None, 2025), ("9", "a", 2024)]


def test_partitions_get_files_by_their_size(spark, lake):
    """A large season in several files, a small one in one, however many tasks hold their rows."""
    big = spark.range(60_000, numPartitions=16).select(F.lit(2025).alias("Season"), F.sha2(F.col("id").cast("string"), 512).alias("v"))
    small = spark.range(64, numPartitions=16).select(F.lit(2024).alias("Season"), F.col("id").cast("string").alias("v"))
    size = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(size)
    spark.conf.set(size, "2MB")
    try:
        stored = lake.refresh(big.unionAll(small), "silver", "sized", ["Season"])
    finally:
        spark.conf.set(size, before)
    of = stored.select("Season", F.col("_metadata.file_path").alias("f")).distinct()
    files = {r[0]: r[1] for r in of.groupBy("Season").count().collect()}
    assert files[2024] == 1 and 2 <= files[2025] <= 8 and stored.count() == 60_064


def test_headers_outlive_a_freed_shuffle(spark, tmp_path):
    """What has been sorted is still there when the headers are asked for, and no file is opened again."""
    for i in range(24):
        put(tmp_path / "drops", f"{i}.csv", f"k,c{i % 6}\n{i},x\n")
    coalesce = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(coalesce, "false")
    try:
        with shuffles_released(spark):
            headers = snapshots.sorted_headers(snapshots.list_files(spark, f"{tmp_path}/drops"), UTF_8)
            time.sleep(1)
            for f in (tmp_path / "drops").iterdir():
                f.unlink()
            found = [*headers]
    finally:
        spark.conf.set(coalesce, "true")
    assert [r.header[1] for r in found] == [f"c{i}" for i in range(6) for _ in range(4)]
