"""Exports of the queries: only what a query reads, and no more on disk than is being taken in."""

import datetime as dt
import glob
import os

import pytest

from catalogue import drops, ingest


@pytest.fixture
def tables(spark, tmp_path, monkeypatch):
    """A folder with a few tables, and scratch folders of its own; there are no lines and no parts."""
    folder = tmp_path / "tables"
    frames = {
        "nation": ([(i, f"N{i}", i % 2) for i in range(3)], "n_nationkey int, n_name string, n_regionkey int"),
        "customer": ([(i, f"C{i}", i % 3, "M") for i in range(1, 5)], "c_custkey long, c_name string, c_nationkey int, c_mktsegment string"),
        "supplier": ([(i, f"S{i}", i % 3) for i in range(1, 3)], "s_suppkey long, s_name string, s_nationkey int"),
        "orders": (
            [(i, i % 4 + 1, dt.datetime(1995 + i % 7, 3, 1 + i % 28), 10.25 * i) for i in range(1, 50)],
            "o_orderkey long, o_custkey long, o_orderdate timestamp, o_totalprice double",
        ),
    }
    for name, (rows, schema) in frames.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{folder}/{name}.parquet")
    monkeypatch.setattr(drops, "scratch_dir", lambda _, label: f"{tmp_path}/scratch/{label}-{os.urandom(4).hex()}")
    return str(folder)


def exports(tmp_path):
    return [f for f in glob.glob(f"{tmp_path}/scratch/exports-*/*.csv") if os.path.getsize(f) > 0]


def test_exports_of_a_season_or_two_at_once(spark, tmp_path, tables, monkeypatch):
    seen, take_in = [], drops.ingest

    def watched(lake, folder, seasons, **more):
        seen.append(len({os.path.dirname(f) for f in exports(tmp_path)}))
        assert all(f"_{s}Season" in f for f in glob.glob(f"{folder}/*.csv") for s in seasons)
        take_in(lake, folder, seasons, **more)

    monkeypatch.setattr(drops, "ingest", watched)
    lake = drops.cleaned_lake(spark, tables, "silver_players_debts")
    assert len(seen) == 7 and max(seen) <= drops.SEASONS_AT_ONCE and not exports(tmp_path)
    bronze = lake.ingested("bronze_players_debts")
    assert bronze.count() == 98 and bronze.select("_season").distinct().count() == 7
    assert lake.scan("silver", "silver_players_debts").count() == 49
    assert not lake.has("bronze_registrations") and not lake.has("bronze_team_lists")


def test_both_snapshots_come_from_one_scan(spark, tables):
    debts = drops.debt_rows(spark, tables)
    stale = {"TotalPaymentAmount": "concat(OutstandingAmount, InvoiceRef)", "OutstandingAmount": "TeamName"}
    both = drops.with_snapshots(debts, stale)
    assert both._jdf.queryExecution().optimizedPlan().collectLeaves().size() == 3  # orders, customers, nations
    assert both.columns == [*debts.columns, "_stamp"]
    want = [(*r, f"{r['_season']}0901120000") for r in debts.collect()]
    for r in debts.collect():
        earlier = {**r.asDict(), "TotalPaymentAmount": r["OutstandingAmount"] + r["InvoiceRef"], "OutstandingAmount": r["TeamName"]}
        want.append((*earlier.values(), f"{r['_season']}0301120000"))
    assert sorted(map(tuple, both.collect()), key=str) == sorted(want, key=str) and len(want) == 98


def test_teams_need_no_lines(spark, tmp_path, tables):
    lake = drops.cleaned_lake(spark, tables, "silver_team_details", "silver_team_lists")
    assert lake.scan("silver", "silver_team_details").count() == 3 and lake.scan("silver", "silver_team_lists").count() == 6
    assert not lake.has("bronze_players_debts") and not exports(tmp_path)


def test_more_lines_make_more_large_files(spark, tmp_path, monkeypatch):
    """No task writes all lines: a large file holds a bounded number of them, and an order stays in one file."""
    folder = str(tmp_path / "tables")
    lines = [
        (o, o % 5, n, 1, n, 10.0, 0.0, 0.0, "A", "F", dt.datetime(1995, 1, 1)) for o in range(200) for n in range(1, 4)
    ]
    frames = {
        "lineitem": (
            lines,
            "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity int, l_extendedprice double, l_discount double, l_tax double, "
            "l_returnflag string, l_linestatus string, l_shipdate timestamp",
        ),
        "orders": ([(i, i % 4, dt.datetime(1995 + i % 7, 3, 1), "1-URGENT") for i in range(200)], "o_orderkey long, o_custkey long, o_orderdate timestamp, o_orderpriority string"),
        "customer": ([(i, f"C{i}") for i in range(4)], "c_custkey long, c_name string"),
        "part": ([(i, f"part {i}", "TIN") for i in range(5)], "p_partkey long, p_name string, p_type string"),
    }
    for name, (rows, schema) in frames.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{folder}/{name}.parquet")
    monkeypatch.setattr(ingest, "LINES_A_FILE", 100)
    files = glob.glob(f"{ingest.large_export(spark, folder)}/*.csv")
    assert 4 <= len(files) <= 6
    rows = ingest.large_export_rows(spark, folder).collect()
    assert len(rows) == 600 and all(r["in_order"] for r in rows)
    assert all(r["lines"] == 3 for r in ingest.large_export_groups(spark, folder).collect())
    filled = ingest.large_export_fill(spark, folder).groupBy("reference").count().collect()
    assert len(filled) == 200 and {r["count"] for r in filled} == {3}


@pytest.fixture
def lines(spark, tables):
    """Lines and parts in the folder of ``tables``."""
    rows = [(o, o % 5 + n, 1, n, n, 10.0 * n, 0.0, 0.0, "A", "F", dt.datetime(1995, 1, 1)) for o in range(1, 50) for n in range(1, 4)]
    frames = {
        "lineitem": (
            rows,
            "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity int, l_extendedprice double, l_discount double, l_tax double, "
            "l_returnflag string, l_linestatus string, l_shipdate timestamp",
        ),
        "part": ([(i, f"part {i}", f"B{i}", "TIN", i) for i in range(9)], "p_partkey long, p_name string, p_brand string, p_type string, p_size int"),
        "orders": (
            [(i, i % 4 + 1, dt.datetime(1995 + i % 7, 3, 1 + i % 28), 10.25 * i, "1-URGENT", "O") for i in range(1, 50)],
            "o_orderkey long, o_custkey long, o_orderdate timestamp, o_totalprice double, o_orderpriority string, o_orderstatus string",
        ),
    }
    for name, (rows, schema) in frames.items():
        spark.createDataFrame(rows, schema).write.mode("overwrite").parquet(f"{tables}/{name}.parquet")
    return tables


def test_many_lines_are_taken_in_by_slices_of_orders(spark, tmp_path, lines, monkeypatch):
    """Never a whole season on disk; the same invoices and the last file still has the largest orders."""
    monkeypatch.setattr(drops, "LINES_A_SLICE", 60)
    monkeypatch.setattr(drops, "SEASONS", (2020, 2021))
    seen, take_in = [], drops.ingest

    def watched(lake, folder, seasons, **more):
        seen.append(len([f for f in glob.glob(f"{folder}/*.csv") if os.path.getsize(f) > 0]))
        take_in(lake, folder, seasons, **more)

    monkeypatch.setattr(drops, "ingest", watched)
    lake = drops.cleaned_lake(spark, lines, "silver_invoices")
    assert len(seen) == 6 and all(seen) and not exports(tmp_path)
    bronze = lake.ingested("bronze_registration_invoices")
    found = bronze.where("Reference is not null").selectExpr("_source_file AS f", "_season AS s", "CAST(Reference AS int) AS r").collect()
    assert len(found) == 28 and {r["r"] for r in found} == {i for i in range(1, 50) if i % 7 < 2}
    for stamp in ("0301120000", "0901120000"):
        for season in (2020, 2021):
            keys = [r["r"] for r in sorted((r for r in found if r["s"] == season and stamp in r["f"]), key=lambda r: (r["f"], r["r"]))]
            assert len(keys) == 7 and keys == sorted(keys)
    stored = lake.scan("silver", "silver_invoices")
    assert stored.count() == 14 and {r["Season"] for r in stored.collect()} == {2020, 2021}
    for label in ("ranked-lines", "filled"):
        folders = glob.glob(f"{tmp_path}/scratch/{label}-*")
        assert folders and not any(os.path.getsize(f) for d in folders for f in glob.glob(f"{d}/**/*.parquet", recursive=True))


def test_lines_are_ranked_once_for_all_tables(spark, lines, monkeypatch):
    made, stored = [], drops.stored_lines
    monkeypatch.setattr(drops, "SEASONS", (2020,))
    monkeypatch.setattr(drops, "stored_lines", lambda *of: made.append(stored(*of)) or made[-1])
    lake = drops.cleaned_lake(spark, lines, "silver_invoices", "silver_players")
    assert len(made) == 1
    assert lake.scan("silver", "silver_invoices").count() == 7 and lake.scan("silver", "silver_players").count() == 21
    assert not any(os.path.getsize(f) for f in glob.glob(f"{made[0].folder}/**/*.parquet", recursive=True))
