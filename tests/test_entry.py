"""Driver contract: entry() runs; every registered query matches its DuckDB oracle at sf0.001."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as E
from rollmatch.plans.catalog import QUERIES
from tests.conftest import SF_SMALL

TABLES = "region nation customer supplier part orders lineitem".split()


def _norm(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return (0, "")
    if isinstance(v, float):
        return (1, repr(round(v, 9)))
    return (1, repr(v))


def _canon(cols, recs):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(_norm(r[i]) for i in order) for r in recs)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def test_entry_runs_on_smallest_scale(spark):
    df = E.entry(spark)
    assert df.columns == ["AUN", "school_code_mismatch_count", "sfa_name", "schl_type"]
    assert df.count() > 0


def test_every_query_has_oracle_sql():
    assert set(QUERIES) <= set(E.queries())
    assert set(QUERIES) <= set(E.oracle_sql())
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.skipif(not os.path.isdir(SF_SMALL), reason="test data not present")
@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    sdf = E.queries()[name](spark, SF_SMALL)
    s_rows = [tuple(r) for r in sdf.collect()]
    res = duck.execute(E.oracle_sql()[name])
    d_cols = [d[0] for d in res.description]
    d_rows = res.fetchall()
    assert sorted(sdf.columns) == sorted(d_cols)
    assert len(s_rows) == len(d_rows)
    assert _canon(sdf.columns, s_rows) == _canon(d_cols, d_rows)
