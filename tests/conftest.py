import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from snapfold.session import local_session  # noqa: E402
from snapfold.sources import Lake  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    shared = tmp_path_factory.mktemp("shared")
    session = local_session(
        8,
        4,
        **{"spark.checkpoint.dir": str(shared), "spark.sql.warehouse.dir": str(shared / "warehouse")},
    )
    yield session
    session.stop()


@pytest.fixture
def lake(spark, tmp_path):
    return Lake(spark, str(tmp_path / "lake"))


def rows(df):
    """Rows as a sorted list of tuples."""
    return sorted((tuple(r) for r in df.collect()), key=repr)


def one_column(df):
    return [r[0] for r in df.collect()]


def plan(df):
    """The physical plan before anything has run."""
    return df.select("*")._jdf.queryExecution().executedPlan().toString()
