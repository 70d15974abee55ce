"""Every registered query equals its SQL oracle (DuckDB) on the smallest data set."""

import math
import os

import duckdb
import pytest

from ordermill.plans.registry import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"
TABLES = ("orders", "customer", "events")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{os.path.join(SF, t)}.parquet')")
    return c


def _norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        return repr(round(v, 6)) if not math.isnan(v) else "NaN"
    return str(v)


def _rows(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted("|".join(_norm(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    assert name in ORACLE, "every registered query has an oracle"
    df = QUERIES[name](spark, SF)
    got = _rows([tuple(r) for r in df.collect()], df.columns)
    rel = con.sql(ORACLE[name])
    want = _rows(rel.fetchall(), rel.columns)
    assert sorted(df.columns) == sorted(rel.columns)
    assert got == want
