"""Driver contract: entry() smoke, and every query vs its DuckDB oracle at sf0.001."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from stationlens.plans import catalog
from scripts.oracle_check import TABLES, rows_of, type_mismatches

from conftest import SF_SMALL


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert "prix_euros" in df.columns


def test_oracle_keys_subset_of_queries():
    qs, sq = entry.queries(), entry.oracle_sql()
    assert set(sq) <= set(qs)
    assert len(qs) >= 45


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        p = f"{SF_SMALL}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"create view {t} as select * from read_parquet('{p}')")
    return con


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_matches_oracle(spark, duck, name):
    df = entry.queries()[name](spark, SF_SMALL)
    sc, sr = rows_of(df.columns, [tuple(r) for r in df.collect()])
    res = duck.execute(entry.oracle_sql()[name])
    dc, dr = rows_of([d[0] for d in res.description], res.fetchall())
    assert sc == dc
    assert len(sr) == len(dr)
    assert sr == dr
    rel = duck.sql(f"SELECT * FROM ({entry.oracle_sql()[name]}) LIMIT 0")
    assert type_mismatches(df.schema, rel.columns, rel.types) == {}


ALLOWED_NESTED_LOOP = {"dq_freshness", "dq_suite"}  # cross join of two one-row aggregates (JOI9)


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_plan_has_no_python_udf_or_cartesian(spark, name):
    df = entry.queries()[name](spark, SF_SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for bad in ("PythonUDF", "BatchEvalPython", "ArrowEvalPython", "CartesianProduct"):
        assert bad not in plan, (name, bad)
    if name not in ALLOWED_NESTED_LOOP:
        assert "BroadcastNestedLoopJoin" not in plan, name
