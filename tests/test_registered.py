"""Every registered query against its SQL, on the smallest tables."""

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry_points

TABLES = Path("/root/testdata/sf0.001")
# The training-data operators have tests of their own.
QUERIES = {k: v for k, v in entry_points.queries().items() if not (k == "pipeline" or k[:2] == "op" and k[2].isdigit())}
SQL = {k: v for k, v in entry_points.oracle_sql().items() if k in QUERIES}

pytestmark = pytest.mark.skipif(not TABLES.exists(), reason="test tables are not here")


def _sorted_rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(repr(row[i]) for i in order) for row in rows)


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for path in TABLES.glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


def test_all_sql_belongs_to_a_query():
    assert set(SQL) <= set(QUERIES)
    assert set(QUERIES) - set(SQL) == {"hashed_embed", "fcm_fit", "k_sweep", "text_query_flow"}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, db, name):
    df = QUERIES[name](spark, str(TABLES))
    got = _sorted_rows(df.columns, df.collect())
    if name not in SQL:
        assert got
        return
    result = db.execute(SQL[name])
    names = [column[0] for column in result.description]
    assert sorted(names) == sorted(df.columns)
    assert got == _sorted_rows(names, result.fetchall())


def test_entry(spark):
    assert entry_points.entry(spark).count() > 0
