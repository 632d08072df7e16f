"""Registered queries of the package against their SQL, on the smallest tables."""

from pathlib import Path

import duckdb
import pytest

from corpuscle.llm import oracles, queries

TABLES = Path("/root/testdata/sf0.001")
SQL = oracles.oracle_sql()
QUERIES = queries.queries()

pytestmark = pytest.mark.skipif(not TABLES.exists(), reason="test tables are not here")


def _sorted_rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(repr(row[i]) for i in order) for row in rows)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query(spark, name):
    db = duckdb.connect()
    for path in TABLES.glob("*.parquet"):
        db.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    df = QUERIES[name](spark, str(TABLES))
    got = _sorted_rows(df.columns, df.collect())
    result = db.execute(SQL[name])
    names = [column[0] for column in result.description]
    assert sorted(names) == sorted(df.columns)
    assert got == _sorted_rows(names, result.fetchall())
