"""The queries against their DuckDB twins and the contracts of their columns."""

import duckdb
import pytest

from codesift.llm.queries import ORACLE_SQL, QUERIES
from conftest import SF_SMALL
from tools.check_oracles import digest


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_oracle(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "labels", "conversations", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    df = QUERIES[name](spark, SF_SMALL)
    rows = [tuple(r) for r in df.collect()]
    cur = con.execute(ORACLE_SQL[name])
    columns = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(columns)
    assert digest(df.columns, rows)[0] == digest(columns, cur.fetchall())[0]


def test_every_operator_has_a_query():
    assert [f"op{i}" for i in range(1, 1 + len(QUERIES))] == sorted((n.split("_")[0] for n in QUERIES), key=lambda n: int(n[2:]))
