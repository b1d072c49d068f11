"""Registration, and the queries that SQL can express against their twins."""

import duckdb
import pyarrow.dataset as ds
import pytest

from plantpulse.llm.queries import oracle_sql, queries

from .helpers import FOLDER


def test_each_operator_has_one_query():
    assert sorted(int(k[2:].split("_")[0]) for k in queries()) == list(range(1, 14))
    assert set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("key", list(oracle_sql()))
def test_same_rows_as_sql(spark, key):
    con = duckdb.connect()
    for name in ("documents", "embeddings", "conversations", "benchmark"):
        con.register(name, ds.dataset(f"{FOLDER}/{name}.parquet").to_table())
    want = con.execute(oracle_sql()[key])
    names = [d[0] for d in want.description]
    got = queries()[key](spark, FOLDER)
    assert sorted(got.columns) == sorted(names)
    assert sorted(map(tuple, got.select(*names).collect())) == sorted(want.fetchall())


def test_entry_offers_them():
    import __spark_entry__ as entry

    assert set(queries()) | {"pipeline"} <= set(entry.queries())
