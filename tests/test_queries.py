"""Every query of the registry against its oracle at the smallest scale."""

import glob
import os

import duckdb
import pytest

from orbitframe.plans import registry

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in glob.glob(f"{FOLDER}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


def plain(value):
    if value is None:
        return None
    if isinstance(value, bool) or type(value).__name__ == "bool_":
        return bool(value)
    return float(value) if isinstance(value, (int, float)) or hasattr(value, "as_integer_ratio") else value


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_query_equals_oracle(spark, duck, name):
    got = registry.QUERIES[name](spark, FOLDER)
    want = duck.execute(registry.ORACLES[name])
    columns = sorted(got.columns)
    names = [c[0] for c in want.description]
    assert columns == sorted(names)
    at = [names.index(c) for c in columns]
    rows = sorted(repr(tuple(plain(v) for v in r)) for r in got.select(*columns).collect())
    assert rows == sorted(repr(tuple(plain(r[i]) for i in at)) for r in want.fetchall())


def test_queries_without_oracle_run(spark):
    assert set(registry.QUERIES) - set(registry.ORACLES) == {"nn_forward_tiny"}
    assert registry.QUERIES["nn_forward_tiny"](spark, FOLDER).count() % 128 == 0
