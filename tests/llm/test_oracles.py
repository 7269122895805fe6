"""Text queries against their SQL."""

import duckdb
import pytest

from orbitframe.llm import queries

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{FOLDER}/documents.parquet'")
    want = con.execute(queries.ORACLES[name])
    names = [c[0] for c in want.description]
    got = queries.QUERIES[name](spark, FOLDER)
    assert sorted(got.columns) == sorted(names)
    assert sorted(map(repr, (tuple(r) for r in got.select(*names).collect()))) == sorted(map(repr, want.fetchall()))
