import datetime as dt

import pytest
from pyspark.sql import functions as F

from snapfold import operators as O
from snapfold.sources import UTF_8, read_snapshots
from snapfold.streaming import ingest, stream_snapshots, write_latest
from tests.conftest import rows
from tests.test_sources import put

CELLS = ("id", "name", "extra", "_source_file")


def test_stream_equals_batch_in_any_split(spark, lake, tmp_path):
    drop = tmp_path / "drop"
    put(drop, "T_1.csv", "id,name\n1,a\n2,b\n")
    put(drop, "T_2.csv", "id,name\n3,c\n")
    put(drop, "X_1.csv", "id\n99\n")

    def run(run="initial", files=1):
        stream_snapshots(lake, str(drop), "T_*.csv", "t", UTF_8, files_per_batch=files, run=run).awaitTermination()

    run()
    run()  # nothing new
    put(drop, "T_3.csv", "extra,name,id\nx,d,4\n")
    put(drop, "T_4.csv", "")
    run()
    want = rows(read_snapshots(spark, f"{drop}/T_*.csv", UTF_8).select(*CELLS))
    assert len(want) == 4 and rows(lake.ingested("t").select(*CELLS)) == want
    run("reload", files=100)
    assert rows(lake.ingested("t").select(*CELLS)) == want
    files = [(r["_source_file"].rsplit("/", 1)[1], r["rows"]) for r in lake.ingested_files("t").collect()]
    assert sorted(files) == [("T_1.csv", 2), ("T_2.csv", 1), ("T_3.csv", 1)]


def test_a_reload_that_fails_shows_the_old_rows(spark, lake, tmp_path, monkeypatch):
    drop = tmp_path / "drop"
    put(drop, "T_1.csv", "id\n1\n")
    put(drop, "T_2.csv", "id,more\n2,x\n")

    def run(name, season=2024):
        stream_snapshots(lake, str(drop), "T_*.csv", "t", UTF_8, season=season, files_per_batch=1, run=name).awaitTermination()

    run("initial")
    run("initial", 2025)
    old = rows(lake.ingested("t").select("id", "more", "_season"))
    assert old == [("1", None, 2024), ("1", None, 2025), ("2", "x", 2024), ("2", "x", 2025)]
    put(drop, "T_3.csv", "id,more\n3,y\n")
    read, taken = ingest.read_each, []

    def failing(files, dialect):
        taken.append(1)
        if len(taken) == 2:
            raise OSError("the store is away")
        return read(files, dialect)

    monkeypatch.setattr(ingest, "read_each", failing)
    with pytest.raises(Exception, match="the store is away"):
        run("again")
    assert len(taken) == 2 and rows(lake.ingested("t").select("id", "more", "_season")) == old
    run("again")  # goes on where it broke off
    assert rows(lake.ingested("t").select("id", "_season")) == [("1", 2024), ("1", 2025), ("2", 2024), ("2", 2025), ("3", 2024)]
    lake.free_old_runs("t")
    assert rows(lake.ingested("t").select("id", "_season")) == [("1", 2024), ("1", 2025), ("2", 2024), ("2", 2025), ("3", 2024)]
    (drop / "T_1.csv").unlink()
    run("01")
    assert lake.shown_run("t", 2024) == "01" and rows(lake.ingested("t").where("_season = 2024").select("id")) == [("2",), ("3",)]


def test_late_and_old_files_are_taken_in(spark, lake, tmp_path):
    import os

    drop = tmp_path / "drop"
    put(drop, "T_1.csv", "id\n1\n")
    stream_snapshots(lake, str(drop), "T_*.csv", "t", UTF_8).awaitTermination()
    put(drop, "T_0.csv", "id\n0\n")
    year_ago = dt.datetime.now().timestamp() - 365 * 86400
    os.utime(drop / "T_0.csv", (year_ago, year_ago))
    stream_snapshots(lake, str(drop), "T_*.csv", "t", UTF_8).awaitTermination()
    assert rows(lake.ingested("t").select("id")) == [("0",), ("1",)]


def test_streaming_latest_equals_batch(spark, tmp_path):
    df = spark.range(200).select(
        (F.col("id") % 7).alias("k"), (F.col("id") % 11).alias("ts"), F.col("id").alias("v")
    )
    source = str(tmp_path / "source")
    df.repartition(6).write.parquet(source)
    stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 2).parquet(source)
    target = str(tmp_path / "target")
    write_latest(stream, ["k"], ["ts", "v"], target, str(tmp_path / "state")).awaitTermination()
    want = rows(O.latest_by_key(df, ["k"], ["ts"], ["v"]))
    assert rows(spark.read.parquet(target)) == want
    # More input arrives: the checkpointed state is extended.
    df.withColumns({"v": F.col("v") + 1000, "ts": F.col("ts") + 5}).filter("k = 3").write.mode("append").parquet(source)
    stream = spark.readStream.schema(df.schema).parquet(source)
    write_latest(stream, ["k"], ["ts", "v"], target, str(tmp_path / "state")).awaitTermination()
    newest = {r.k: r.v for r in spark.read.parquet(target).collect()}
    assert newest[3] > 1000 and {k: v for k, v in newest.items() if k != 3} == {k: v for k, t, v in want if k != 3}
