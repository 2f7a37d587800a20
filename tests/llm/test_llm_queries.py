import pytest
from helpers import sql_differences

from txnlake.llm.oracle import oracle_sql
from txnlake.llm.queries import queries


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_equals_sql(spark, sf_dir, name):
    df = queries()[name](spark, sf_dir)
    assert sql_differences(df, oracle_sql()[name], sf_dir) == ([], [])


def test_one_query_for_each_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in queries()) == list(range(1, 14))
