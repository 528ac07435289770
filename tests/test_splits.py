"""Large exports with line feeds in cells: read in splits, the same rows in the same order as read whole."""

import random
from dataclasses import replace

import pytest

from snapfold.sources import FILE_ORDER, UTF_8, WINDOWS_1252, Dialect, read_snapshots, splits

CONF = {"spark.sql.files.maxPartitionBytes": 97, "spark.sql.files.openCostInBytes": 1}


@pytest.fixture(autouse=True)
def small_splits(spark, monkeypatch):
    """Text is read in splits of 97 bytes; nothing else is."""
    stored = splits.stored_chunks

    def in_small_splits(*arguments):
        before = {k: spark.conf.get(k) for k in CONF}
        try:
            for key, value in CONF.items():
                spark.conf.set(key, value)
            return stored(*arguments)
        finally:
            for key, value in before.items():
                spark.conf.set(key, value)

    monkeypatch.setattr(splits, "stored_chunks", in_small_splits)


def both(spark, path, dialect):
    """Cells in file order, read whole and in splits, and the number of splits that gave rows."""
    whole = read_snapshots(spark, path, replace(dialect, split_over=1 << 40))
    order = ["_source_file", *FILE_ORDER]
    cells = [c for c in whole.columns if c not in (*FILE_ORDER, "_ingest_ts")]
    expected = [tuple(r) for r in whole.orderBy(*order).select(*cells).collect()]
    cut = read_snapshots(spark, path, replace(dialect, split_over=0))
    assert cut.dtypes == whole.dtypes
    got = cut.orderBy(*order).select(*cells, "_block_start").collect()
    return expected, [tuple(r)[:-1] for r in got], len({(r["_source_file"], r["_block_start"]) for r in got})


def cell(rng):
    kind = rng.random()
    if kind < 0.35:
        return "".join(rng.choice("abcé 7") for _ in range(rng.randint(0, 9)))
    inner = "".join(rng.choice(("a", "é", ",", "\n", '""', " ", "\r", "xyz" * 9, "\n\n")) for _ in range(rng.randint(0, 14)))
    return rng.choice(("", " ")) + f'"{inner}"' + rng.choice(("", "  "))


@pytest.mark.parametrize("seed", range(4))
def test_random_exports(spark, tmp_path, seed):
    rng = random.Random(seed)
    dialect = (WINDOWS_1252, UTF_8)[seed % 2]
    for name in ("a b.csv", "c[1].csv"):
        lines = ["id,x y,z"]
        for i in range(120):
            cells = [str(i), *(cell(rng) for _ in range(rng.choice((2, 2, 2, 2, 1, 3))))]
            lines.append(",".join(cells))
            if rng.random() < 0.05:
                lines.append("")
        text = "\n".join(lines) + ("\n" if seed < 3 else "")
        (tmp_path / name).write_bytes(text.encode("cp1252" if dialect.is_windows_1252 else "utf-8"))
    expected, found, tasks = both(spark, f"{tmp_path}/*.csv", dialect)
    assert found == expected and len(found) == 240 and tasks > 20


def test_a_cell_longer_than_many_splits(spark, tmp_path):
    long = "\n".join(f'line {i}, ""quoted""' for i in range(200))
    (tmp_path / "a.csv").write_text(f'id,t\n1,"{long}"\n2,b\n3,"{long}"\n4,"open\nto the end')
    expected, found, tasks = both(spark, f"{tmp_path}/a.csv", UTF_8)
    assert found == expected and [r[0] for r in found] == ["1", "2", "3", "4"] and found[0][1] == long.replace('""', '"')


def test_rows_ending_in_both_characters(spark, tmp_path):
    body = "".join(f'{i},"a\r\nb {i}",é\r\n' for i in range(60))
    (tmp_path / "a.csv").write_bytes(f"id,t,u\r\n{body}".encode())
    expected, found, tasks = both(spark, f"{tmp_path}/a.csv", UTF_8)
    assert found == expected and found[3][:3] == ("3", "a\nb 3", "é") and tasks > 5


@pytest.mark.parametrize(
    "line", ['7,5" pipe,x', '7,pipe 5",x', '7,say "hi" twice,x', '7,"a"b,x', '7, 5 " x,y']
)
def test_stray_quotes_are_read_whole(spark, tmp_path, line):
    body = "".join(f'{i},"a\nb, {i}",c\n' for i in range(40))
    (tmp_path / "a.csv").write_text(f"id,t,u\n{body}{line}\n{body}")
    (tmp_path / "b.csv").write_text(f"id,t,u\n{body}")
    expected, found, tasks = both(spark, f"{tmp_path}/*.csv", UTF_8)
    assert found == expected and tasks > 4
    expected, found, tasks = both(spark, f"{tmp_path}/a.csv", UTF_8)
    assert found == expected and tasks == 1


def test_dialects_that_cannot_be_cut():
    assert WINDOWS_1252.splits and UTF_8.splits
    for dialect in (Dialect("UTF-16"), Dialect(escape="\\"), Dialect(multi_line=False), Dialect(delimiter="||")):
        assert not dialect.splits


def test_files_without_rows(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,t\n")
    (tmp_path / "b.csv").write_text("id,t\n\n\n")
    (tmp_path / "c.csv").write_text('id,t\n1,"x\ny"\n')
    expected, found, _ = both(spark, f"{tmp_path}/*.csv", UTF_8)
    assert found == expected and len(found) == 1


def test_chunks_are_bounded_by_bytes(spark, tmp_path, monkeypatch):
    """Many long lines make many chunks, so that no task holds them all; the rows stay what they are."""
    monkeypatch.setattr(splits, "CHUNK_BYTES", 500)
    monkeypatch.setitem(CONF, "spark.sql.files.maxPartitionBytes", 1 << 20)
    body = "".join(f'{i},"{"word " * 20}\n{"x" * 150}, ""{i}""",é\n' for i in range(60))
    (tmp_path / "a.csv").write_text(f'id,t,u\n{body}60,"{"y" * 1500}",z\n')
    chunks = splits.stored_chunks(spark, [str(tmp_path / "a.csv")], ",", '"', True)
    sizes = [r[0] for r in chunks.selectExpr("octet_length(bytes)").collect()]
    assert len(sizes) > 30 and sorted(sizes)[-2] <= 500 and sum(sizes) == (tmp_path / "a.csv").stat().st_size
    expected, found, _ = both(spark, f"{tmp_path}/a.csv", UTF_8)
    assert found == expected and len(found) == 61
