"""Every registered query against its SQL equivalent in DuckDB."""

import duckdb
import pytest

from tessera.plans.registry import load_all
from tessera.sources.tables import TABLES
from tools.oracle_check import compare, promises_order, type_mismatches

from .conftest import SMOKE_DIR

QUERIES = load_all()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMOKE_DIR}/{t}.parquet')")
    yield con
    con.close()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, duck, name):
    q = QUERIES[name]
    df = q.fn(spark, SMOKE_DIR)
    rows = [tuple(r) for r in df.collect()]
    assert len(df.columns) == len(set(df.columns))
    if q.sql is None:
        return
    rel = duck.sql(q.sql)
    assert not type_mismatches(df.schema, rel.columns, rel.types)
    cur = duck.execute(q.sql)
    err = compare(rows, df.columns, cur.fetchall(), [d[0] for d in cur.description], promises_order(q.sql))
    assert err is None, err


def test_entry_contract(spark):
    import __spark_entry__ as entry

    df = entry.entry(spark)
    assert df.count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
