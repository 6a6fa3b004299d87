"""Every registered query against its SQL, on the smallest tables."""

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
from checks.queries import QUERIES
from tools.check_oracle import normal

SF_DIR = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not SF_DIR.exists(), reason="needs the given tables")


@pytest.fixture(scope="module")
def database():
    con = duckdb.connect()
    for path in SF_DIR.glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


def test_every_query_has_sql():
    assert set(QUERIES) <= set(entry.queries())
    assert set(QUERIES) <= set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_its_sql(spark, database, name):
    got = entry.queries()[name](spark, str(SF_DIR)).toPandas()
    want = database.execute(entry.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    left, right = normal(got), normal(want)
    assert len(left) == len(right)
    for column in left.columns:
        assert left[column].equals(right[column]), column


def test_flagship(spark):
    frame = entry.entry(spark)
    assert frame.columns == ["Year", "Yr_Index", "SEM", "lower_sem", "upper_sem", "Red", "Yellow", "Green"]
    assert frame.count() == 7
