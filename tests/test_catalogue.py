"""Every registered query at the smallest scale, against its SQL answer in DuckDB."""

import os
import subprocess
import sys

import duckdb
import pytest

import __spark_entry__ as entry
from catalogue.base import ANSWERS, QUERIES
from tests.conftest import plan

DATA = entry.SMOKE_DIR
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"

pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="driver tables are not here")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES.split():
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{DATA}/{name}.parquet')")
    return connection


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, duck, name):
    result = entry.queries()[name](spark, DATA)
    columns = sorted(result.columns)
    got = sorted((tuple(r[c] for c in columns) for r in result.collect()), key=repr)
    answer = duck.execute(entry.oracle_sql()[name])
    names = [d[0] for d in answer.description]
    assert sorted(names) == columns
    want = sorted((tuple(r[names.index(c)] for c in columns) for r in answer.fetchall()), key=repr)
    assert got == want and got

    physical = plan(result)
    for unwanted in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "LocalLimit"):
        assert unwanted not in physical

def test_every_query_has_an_answer():
    assert set(QUERIES) == set(ANSWERS)
    assert set(QUERIES) <= set(entry.queries()) and set(ANSWERS) <= set(entry.oracle_sql())


def test_entry(spark):
    result = entry.entry(spark)
    assert result.columns[0] == "season" and result.count() == 7


def test_entry_without_an_optional_library():
    """A library that only the training-data operators use may be missing; everything else is still there."""
    code = "import sys; sys.modules['ahocorasick'] = None; import __spark_entry__ as e; from catalogue.base import QUERIES; assert set(e.queries()) == set(QUERIES)"
    subprocess.run([sys.executable, "-c", code], check=True, cwd=os.path.dirname(entry.__file__))
