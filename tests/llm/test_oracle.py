"""The SQL of this package against its queries, on the smallest tables."""

from pathlib import Path

import duckdb
import pytest

from llm.oracle import ORACLE
from llm.queries import QUERIES
from tools.check_oracle import normal

SF_DIR = Path("/root/testdata/sf0.001")


@pytest.mark.skipif(not SF_DIR.exists(), reason="needs the given tables")
@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_its_sql(spark, name):
    database = duckdb.connect()
    for path in SF_DIR.glob("*.parquet"):
        database.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    left, right = normal(QUERIES[name](spark, str(SF_DIR)).toPandas()), normal(database.execute(ORACLE[name]).df())
    assert len(left) == len(right) and list(left.columns) == list(right.columns)
    for column in left.columns:
        assert left[column].equals(right[column]), column
