"""The driver contract in __spark_entry__.py."""

import __spark_entry__ as E
from ordermill.plans.registry import QUERIES

from tests.test_plans import RUNS


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(E.oracle_sql()) <= set(E.queries())
    assert len(QUERIES) >= 50


def test_entry_runs_on_the_smallest_data(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["report_date", "total_orders", "total_amount_cents", "paid_orders", "shipped_orders",
                          "pending_orders", "cancelled_orders", "paid_amount_cents"]
    assert E.entry(spark).schema == df.schema


def test_query_columns_are_unique_and_named(spark):
    assert set(QUERIES) <= set(E.queries())
    for name, q in QUERIES.items():
        if name in RUNS:
            continue                                   # these run jobs when called; covered by test_oracle
        cols = q(spark, "/root/testdata/sf0.001").columns
        assert len(cols) == len(set(cols)), name
        assert all("(" not in c for c in cols), (name, cols)   # every computed column is aliased
