"""Queries that SQL can express, against DuckDB."""

import duckdb
import pytest

from cityweave.llm.queries import QUERIES
from cityweave.llm.sql import ORACLE_SQL

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    found = con.execute(ORACLE_SQL[name])
    columns = sorted(d[0] for d in found.description)
    want = sorted(tuple(dict(zip((d[0] for d in found.description), r, strict=True))[c] for c in columns) for r in found.fetchall())
    got = QUERIES[name](spark, SF)
    assert sorted(got.columns) == columns
    assert sorted(tuple(r[c] for c in columns) for r in got.collect()) == want
