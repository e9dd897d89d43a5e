"""Every catalog query against its DuckDB oracle on the smallest scale factor."""

import datetime as dt
import math
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as entry_mod
from cityweave.plans.oracle import ORACLE_SQL
from tests.conftest import SF_SMALL


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else f"{v:.6f}"
    if isinstance(v, dt.datetime):
        return v.isoformat(sep=" ")
    if isinstance(v, dt.date):
        return v.isoformat()
    return v


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in ("nation", "events", "orders"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    yield c
    c.close()


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_oracle(spark, con, name):
    df = entry_mod.queries()[name](spark, SF_SMALL)
    res = con.execute(entry_mod.oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(ocols)
    cols = sorted(ocols)
    s_rows = Counter(tuple(_norm(r[c]) for c in cols) for r in df.collect())
    o_idx = {c: i for i, c in enumerate(ocols)}
    o_rows = Counter(tuple(_norm(r[o_idx[c]]) for c in cols) for r in res.fetchall())
    assert s_rows == o_rows


def test_entry_smoke(spark):
    df = entry_mod.entry(spark)
    assert df.count() > 0
    assert "zone_id" in df.columns
