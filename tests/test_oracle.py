"""Every registered query against its DuckDB oracle on the smallest tables,
plus a row-count run of the queries without an oracle."""

import duckdb
import pytest

import __spark_entry__ as E
from tessera.catalog import all_oracles, all_queries
from tools.check_oracle import TABLES, rows

QUERIES = all_queries()
ORACLE = all_oracles()


@pytest.fixture(scope="module")
def con(tiny):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{tiny}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, tiny, con, name):
    got = QUERIES[name](spark, tiny).toPandas()
    want = con.execute(ORACLE[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert len(got) == len(want)
    assert rows(got, 9) == rows(want, 9)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_query_without_oracle_runs(spark, tiny, name):
    df = QUERIES[name](spark, tiny)
    assert df.count() >= 0


def test_every_oracle_has_a_query():
    assert set(ORACLE) <= set(QUERIES)
    assert set(QUERIES) <= set(E.queries()) and set(ORACLE) <= set(E.oracle_sql())


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert set(df.columns) == {"pickup_hour", "trip_count", "is_peak"}
    assert df.filter("is_peak").count() == 1
