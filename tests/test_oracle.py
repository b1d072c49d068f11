"""Every query against its SQL twin, on the smallest tables."""

from pathlib import Path

import duckdb
import pytest

from plantpulse.queries import all_queries

FOLDER = "/root/testdata/sf0.001"
QUERIES = all_queries()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for file in Path(FOLDER).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    return connection


def plain(rows, columns, names):
    where = [names.index(c) for c in columns]
    return sorted(str([r[i] for i in where]) for r in rows)


@pytest.mark.parametrize("key", [k for k, q in QUERIES.items() if q.sql])
def test_same_rows(spark, duck, key):
    df = QUERIES[key](spark, FOLDER)
    columns = sorted(df.columns)
    got = plain([tuple(r) for r in df.collect()], columns, df.columns)
    result = duck.execute(QUERIES[key].sql)
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    assert got == plain(result.fetchall(), columns, names)


def test_every_query_has_a_twin():
    assert all(q.sql for q in QUERIES.values())
