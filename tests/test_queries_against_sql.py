"""Every query that has SQL gives the same rows as the SQL."""

import pytest

from check_queries import compare, duck
from lopside.queries import QUERIES, SQL


@pytest.fixture(scope="module")
def con(small):
    return duck(small)


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_rows(name, spark, small, con):
    got = QUERIES[name](spark, small).toPandas()
    assert compare(got, con.execute(SQL[name]).fetchdf()) is None


def test_entry_runs(spark):
    import __spark_entry__ as driver
    assert driver.entry(spark).count() == 1
    assert set(driver.oracle_sql()) <= set(driver.queries())
