"""Driver contract and every registered query against its DuckDB oracle (sf0.001)."""

from __future__ import annotations

import duckdb
import pytest

import __spark_entry__ as ent
from conftest import SMOKE_DIR
from unitmart.sources.tables import TABLES


def test_entry_runs(spark):
    df = ent.entry(spark)
    assert df.count() > 0
    assert df.columns == ["bu_id", "business_group", "deal_count", "pipeline_value_usd",
                          "won_revenue_usd", "avg_deal_value_usd"]


def test_every_core_query_has_an_oracle():
    assert set(ent.REGISTRY) <= set(ent.oracle_sql()) <= set(ent.queries())


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{SMOKE_DIR}/{t}.parquet')")
    return con


def _norm(v):
    return ("%r" % v) if isinstance(v, float) else str(v)


@pytest.mark.parametrize("name", sorted(ent.oracle_sql()))
def test_query_matches_oracle(spark, duck, name):
    df = ent.queries()[name](spark, SMOKE_DIR)
    assert not df.isStreaming and len(set(df.columns)) == len(df.columns)
    assert not any(t.startswith("decimal") for _, t in df.dtypes)  # money leaves as double
    rel = duck.sql(ent.oracle_sql()[name])
    assert sorted(df.columns) == sorted(rel.columns)
    order = sorted(df.columns)
    got = sorted(tuple(_norm(r[c]) for c in order) for r in df.collect())
    idx = [rel.columns.index(c) for c in order]
    want = sorted(tuple(_norm(r[i]) for i in idx) for r in rel.fetchall())
    assert got == want
