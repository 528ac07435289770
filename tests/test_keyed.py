"""Tables that change by key: against recomputes, with untouched files, replays and failures."""

import datetime as dt
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from snapfold import operators as O
from snapfold.plans import incremental, star
from snapfold.plans import constants as K
from snapfold.plans.debts import debts
from snapfold.plans.incremental import Collections
from snapfold.sources import Dialect, KeyedTable, fold_totals, retraction
from snapfold.streaming import stream_snapshots, upsert_latest
from tests.conftest import rows

ROW = "k string, ts long, v long, g string"


def files(folder):
    return {p.relative_to(folder): p.stat().st_mtime_ns for p in folder.rglob("*.parquet")}


def test_upserts_and_retracted_totals_equal_a_recompute(spark, tmp_path):
    rng = random.Random(2)
    table = KeyedTable(spark, str(tmp_path / "t"), ("k",), buckets=8)
    totals = KeyedTable(spark, str(tmp_path / "s"), ("g",), buckets=4)
    assert table.read() is None
    given = []
    for step in range(4):
        keys = [None, *map(str, range(30))] if not step else [str(rng.randrange(40)) for _ in range(4)]
        batch = [(k, rng.randrange(5) + step, rng.randrange(100), rng.choice(("a", "b", None, "c"))) for k in keys for _ in range(2)]
        given += batch
        change = table.upsert(spark.createDataFrame(batch, ROW), ["ts"], ["v", "g"])
        totals.update(retraction(change, ["g"], ["v"], "n"), fold_totals(["g"], ["v"], "n"))
        want = O.latest_by_key(spark.createDataFrame(given, ROW), ["k"], ["ts"], ["v", "g"])
        assert rows(table.read()) == rows(want)
        summed = want.groupBy("g").agg(F.sum("v").alias("v"), F.count(F.lit(1)).alias("n"))
        assert rows(totals.read()) == rows(summed.select(*totals.read().columns))


def test_only_touched_buckets_are_written(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path / "t"), ("k",), buckets=16)
    whole = spark.range(400).select(F.col("id").cast("string").alias("k"), F.lit(0).cast("long").alias("ts"), F.col("id").alias("v"), F.lit("g").alias("g"))
    table.upsert(whole, ["ts"], ["v"])
    before, shown = files(tmp_path / "t" / "rows"), table.versions()
    change = table.upsert(spark.createDataFrame([("7", 1, -7, "g"), ("new", 1, 0, "g")], ROW), ["ts"], ["v"])
    after = files(tmp_path / "t" / "rows")
    assert all(after[f] == t for f, t in before.items())  # no file is touched, the new ones stand beside
    written = {f.parts[1] for f in after if f not in before}
    assert 1 <= len(written) <= 2 and sum(table.versions()[b] != v for b, v in shown.items()) == len(written)
    assert rows(change.before.select("k", "v")) == [("7", 7)] and rows(change.after.select("k", "v")) == [("7", -7), ("new", 0)]
    assert table.read().count() == 401
    # An older row changes nothing that is seen, and neither does the same change once more.
    table.upsert(spark.createDataFrame([("7", 0, 99, "g")], ROW), ["ts"], ["v"])
    assert rows(table.read().where("k = '7'").select("v")) == [(-7,)]


def test_a_change_that_fails_leaves_the_table(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path / "t"), ("k",), buckets=2)
    table.upsert(spark.createDataFrame([("a", 1, 1, "g")], ROW), ["ts"], ["v"])

    def broken(both):
        return both.withColumn("v", F.raise_error(F.lit("no room")).cast("long"))

    with pytest.raises(Exception, match="no room"):
        table.update(spark.createDataFrame([("a", 2, 2, "g")], ROW), broken)
    assert rows(table.read().select("k", "v")) == [("a", 1)]
    table.upsert(spark.createDataFrame([("a", 2, 2, "g")], ROW), ["ts"], ["v"])
    assert rows(table.read().select("k", "v")) == [("a", 2)]


def test_a_key_that_goes(spark, tmp_path):
    totals = KeyedTable(spark, str(tmp_path / "t"), ("k",), buckets=1)
    fold = fold_totals(["k"], ["v"], "n")
    totals.update(spark.createDataFrame([("a", Decimal("1.10"), 1)], "k string, v decimal(10,2), n long"), fold)
    totals.update(spark.createDataFrame([("a", Decimal("-1.10"), -1)], "k string, v decimal(10,2), n long"), fold)
    assert totals.read() is None or totals.read().count() == 0
    totals.update(spark.createDataFrame([("b", Decimal("2.00"), 1)], "k string, v decimal(10,2), n long"), fold)
    assert [r["k"] for r in totals.read().collect()] == ["b"]


def test_streaming_upsert(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path / "t"), ("k",), buckets=8)
    source, given = str(tmp_path / "source"), []
    for step in range(3):
        batch = [(str(i % 20), step * 10 + i % 3, i + step, "g") for i in range(60 if not step else 2)]
        given += batch
        spark.createDataFrame(batch, ROW).coalesce(2).write.mode("append").parquet(source)
        stream = spark.readStream.schema(ROW).option("maxFilesPerTrigger", 1).parquet(source)
        upsert_latest(stream, ["k"], ["ts", "v"], table, str(tmp_path / "state")).awaitTermination()
        assert rows(table.read()) == rows(O.latest_by_key(spark.createDataFrame(given, ROW), ["k"], ["ts", "v"], ["k"]))


def test_collections_by_changes(spark, lake, tmp_path, monkeypatch):
    drop = tmp_path / "drop"
    drop.mkdir()
    header = "InvoiceRef,PlayerSurname,PlayerFirstName,TeamName,InvoiceAmount,TotalPaymentAmount,TotalCreditAmount,OutstandingAmount,CommitmentAmount,PendingAmount,PayableAmount,NumberOfPayments,NumberOfCredits,InvoiceDate,LastPaymentDate,LastCreditDate"

    def export(stamp, *lines):
        body = "".join(f"{ref},{name},Al,{team},{billed},{paid},0,0.1,0,0,0,{n},0,2025-01-01,{day},\n" for ref, name, team, billed, paid, n, day in lines)
        (drop / f"D_{stamp}.csv").write_text(f"{header}\n{body}")

    kept = Collections(lake, buckets=4)

    def refresh(run="initial"):
        stream_snapshots(lake, str(drop), "D_*.csv", incremental.BRONZE, Dialect("UTF-8"), 2025, run=run).awaitTermination()
        kept.take_in()
        whole = star.fact_collections(O.keep_passing(debts(lake.ingested(incremental.BRONZE)), K.DEBT_RULES), "2026-01-01")
        assert rows(kept.fact("2026-01-01").select(*whole.columns)) == rows(whole)
        return whole

    export("20250101000000", ("1", "Fern", "U9", 10.1, 5, 1, "2025-02-01"), ("2", "Fern", "U9", 0.2, 0, 0, ""), ("", "Reed", "U8", 3, 3, 1, "2025-02-03"), ("3", "Ash", "", 7, 7, 1, "2025-03-01"))
    refresh()
    refresh()  # nothing new
    export("20250201000000", ("1", "Fern", "U9", 10.1, 6, 2, "2025-01-15"), ("3", "Ash", "U9", 7, 0, 0, ""), ("4", "Oak", "U7", 1e20, 0, 0, ""))
    found = refresh()
    # The latest day of a group goes back with the row that had it, and a group without rows goes.
    assert {(r.player_surname, r.last_payment_date) for r in found.collect()} == {
        ("Fern", dt.date(2025, 1, 15)), ("Reed", dt.date(2025, 2, 3)), ("Ash", None), ("Oak", None)
    }
    # A failure between debts and totals: the next call adds the totals up afresh.
    export("20250301000000", ("2", "Fern", "U9", 5, 5, 1, "2025-05-05"))
    stream_snapshots(lake, str(drop), "D_*.csv", incremental.BRONZE, Dialect("UTF-8"), 2025).awaitTermination()
    with monkeypatch.context() as broken:
        broken.setattr(incremental, "retraction", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            kept.take_in()
    refresh()
    (drop / "D_20250101000000.csv").unlink()
    refresh("again")  # a reload replaces everything
