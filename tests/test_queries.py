"""Every query of the library against its SQL counterpart; add-ons have their own tests."""

import pytest
from compare import differences

import __spark_entry__ as entry_points
from txnlake.plans import oracle, queries

QUERIES = queries.queries()
ORACLE = oracle.oracle_sql()


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry_points.queries())
    assert set(ORACLE) <= set(entry_points.oracle_sql()) <= set(entry_points.queries())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, sf_dir, name):
    assert differences(QUERIES[name](spark, sf_dir), ORACLE[name], sf_dir) == []


def test_entry(spark):
    result = entry_points.entry(spark)
    assert "fraud_rate_pct" in result.columns
    assert result.count() > 0
