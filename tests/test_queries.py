"""Every query with SQL against DuckDB over the same tables."""

import glob
import os

import duckdb
import pytest

from lagweave import registry

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for p in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM '{p}'")
    return con


def norm(v):
    if v is None or v != v:
        return "null"
    if isinstance(v, float):
        return repr(round(v, 9) + 0.0)
    return str([norm(x) for x in v]) if isinstance(v, list | tuple) else str(v)


@pytest.mark.parametrize("name", sorted(registry.SQL))
def test_same_as_sql(spark, duck, name):
    got = registry.QUERIES[name](spark, SF)
    rel = duck.execute(registry.SQL[name])
    names = [d[0] for d in rel.description]
    assert sorted(names) == sorted(got.columns)
    want = sorted(tuple(norm(dict(zip(names, r, strict=True))[c]) for c in sorted(names)) for r in rel.fetchall())
    assert sorted(tuple(norm(r[c]) for c in sorted(names)) for r in got.collect()) == want


def test_entry_and_lists_agree():
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
