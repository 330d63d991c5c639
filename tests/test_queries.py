"""Every registered query against its DuckDB oracle (sf 0.001), plus the entry smoke check."""

import duckdb
import pytest

import __spark_entry__ as E
from codesift.plans.table_queries import ORACLE_SQL, QUERIES
from codesift.sources.corpus import TABLES
from conftest import SF_SMALL
from tools.check_oracles import digest


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def test_entry(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns == ["repo_id", "language", "n_files", "loc", "tokens", "chars"]


def test_every_library_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE_SQL)


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF_SMALL)
    rows = [tuple(r) for r in df.collect()]
    cur = duck.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in cur.description]
    orows = cur.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    h1, l1 = digest(df.columns, rows)
    h2, l2 = digest(ocols, orows)
    assert len(rows) == len(orows)
    assert h1 == h2, (sorted(set(l1) - set(l2))[:2], sorted(set(l2) - set(l1))[:2])
