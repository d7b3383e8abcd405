"""Every registered query at sf0.001 against its DuckDB oracle."""
import duckdb
import pytest

import __spark_entry__ as E
from corpusflow.plans.registry import QUERIES, load_all
from corpusflow.sources.tables import TABLES
from tests.conftest import SF001

load_all()
NAMES = sorted(QUERIES)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    return c


def _rows(pdf):
    from tools.check_oracle import rows
    return rows(pdf)


def test_entry(spark):
    df = E.entry(spark)
    assert df.count() > 0 and "doc_id" in df.columns


def test_oracles_cover_queries():
    missing = set(NAMES) - set(E.oracle_sql())
    assert not missing


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    got = E.queries()[name](spark, SF001).toPandas()
    sql = E.oracle_sql().get(name)
    if sql is None:
        assert len(got) > 0
        return
    want = con.sql(sql).df()
    assert _rows(got) == _rows(want)
