"""Every registered query that has SQL, side by side with it."""
import pytest

import __spark_entry__
from comparing import connect, differences

ORACLE = __spark_entry__.oracle_sql()
QUERIES = __spark_entry__.queries()


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


def test_every_sql_has_a_query():
    assert set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_same_result(spark, con, sf_dir, name):
    assert differences(spark, con, QUERIES[name], ORACLE[name], sf_dir) == []


def test_entry(spark):
    df = __spark_entry__.entry(spark)
    assert df.count() == 94 and df.columns[0] == "customer_id" and df.columns[-1] == "churned"
