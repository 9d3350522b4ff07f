import pytest
from oracle import compare, connect

import __spark_entry__ as contract

SF_DIR = contract.SMOKE_DIR


@pytest.fixture(scope="module")
def db():
    return connect(SF_DIR)


#: Queries that SQL cannot express; tests/llm checks them against brute force.
WITHOUT_SQL = {"pipeline"} | {name for name in contract.queries() if name.startswith("op")}


def test_every_query_has_sql():
    assert set(contract.queries()) - WITHOUT_SQL == set(contract.oracle_sql()) - WITHOUT_SQL


def test_entry(spark):
    df = contract.entry(spark)
    assert df.count() > 0 and "SMA_200_close" in df.columns


@pytest.mark.parametrize("name", sorted(contract.oracle_sql()))
def test_query_equals_its_sql(spark, db, name):
    assert compare(spark, db, SF_DIR, name) is None
