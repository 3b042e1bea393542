"""The driver contract: entry() smoke, and every registered query against
its DuckDB oracle on the smallest fixture (row count, columns, values)."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as E
from conftest import SF_SMALL
from shoplens.plans import catalog

# the text operators, where present, have tests of their own
QUERIES = {n: q for n, q in E.queries().items() if n in catalog.QUERIES}
ORACLES = {n: q for n, q in E.oracle_sql().items() if n in catalog.QUERIES}
ROWS_ONLY: set[str] = set()


def _norm(v):
    if isinstance(v, float):
        return "NaN" if math.isnan(v) else f"{round(v, 6):.6f}"
    return "NULL" if v is None else str(v)


def _canon(cols, data):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted("|".join(_norm(r[i]) for i in order) for r in data)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def test_entry_smoke(spark):
    df = E.entry(spark)
    out = df.collect()
    assert df.columns == ["hour", "yesterday", "today"]
    assert len(out) == 24


def test_every_query_has_an_oracle_or_is_declared_rows_only():
    assert set(QUERIES) == set(ORACLES) | ROWS_ONLY


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    if not os.path.exists(SF_SMALL):
        pytest.skip("fixture folder missing")
    df = QUERIES[name](spark, SF_SMALL)
    got = [tuple(r) for r in df.collect()]
    if name in ROWS_ONLY:
        assert got
        return
    res = duck.execute(ORACLES[name])
    ocols = [d[0] for d in res.description]
    want = res.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(got) == len(want)
    assert _canon(df.columns, got) == _canon(ocols, want)
