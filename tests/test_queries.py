import os

import pytest

import __spark_entry__ as E
from tests.oracle import connect, difference

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(E.queries()))
def test_query(spark, con, name):
    df = E.queries()[name](spark, SF)
    sql = E.oracle_sql().get(name)
    if sql is None:
        assert df.collect()
        return
    assert difference(df, con, sql) is None


def test_entry(spark):
    assert set(r.sdelta_operacion for r in E.entry(spark).collect()) == {"I", "U", "D"}
