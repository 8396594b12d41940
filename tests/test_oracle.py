import pytest

import __spark_entry__ as contract
from oracle import connect, duck_rows, kinds, spark_rows


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(contract.oracle_sql()))
def test_query_agrees_with_sql(spark, con, sf_dir, name):
    df = contract.queries()[name](spark, sf_dir)
    sql = contract.oracle_sql()[name]
    assert spark_rows(df) == duck_rows(con, sql)
    ours, theirs = kinds(df, con, sql)
    assert ours == theirs


def test_entry_has_rows(spark):
    assert contract.entry(spark).limit(1).count() == 1
