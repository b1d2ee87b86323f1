"""Text queries against their DuckDB SQL."""

import duckdb
import pytest

from rollmatch.llm.catalog import QUERIES
from rollmatch.llm.catalog_sql import ORACLE_SQL
from tests.conftest import SF_SMALL


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for name_ in ("documents", "conversations"):
        con.execute(f"CREATE VIEW {name_} AS SELECT * FROM read_parquet('{SF_SMALL}/{name_}.parquet')")
    result = con.execute(ORACLE_SQL[name])
    columns = [d[0] for d in result.description]
    out = QUERIES[name](spark, SF_SMALL)
    assert sorted(columns) == sorted(out.columns)
    assert sorted(result.fetchall()) == sorted(tuple(r) for r in out.select(columns).collect())
