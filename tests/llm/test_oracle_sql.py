"""The queries that have SQL, against DuckDB on the smallest tables."""

import duckdb
import pytest

from tessera.llm.queries import ORACLE_SQL, QUERIES
from tests.conftest import SMOKE_DIR
from tools.oracle_check import compare, type_mismatches


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMOKE_DIR}/{t}.parquet')")
    df = QUERIES[name](spark, SMOKE_DIR)
    rows = [tuple(r) for r in df.collect()]
    rel = con.sql(ORACLE_SQL[name])
    assert not type_mismatches(df.schema, rel.columns, rel.types)
    cur = con.execute(ORACLE_SQL[name])
    assert compare(rows, df.columns, cur.fetchall(), [d[0] for d in cur.description]) is None
