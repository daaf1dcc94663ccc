import pytest

import __spark_entry__ as entry
from tests.sqlcheck import assert_same, connect

CORE = [k for m in entry._MODULES if not m.__name__.startswith("brightledger.llm") for k in m.QUERIES]


@pytest.fixture(scope="module")
def con(folder):
    return connect(folder)


@pytest.mark.parametrize("name", CORE)
def test_query(spark, folder, con, name):
    df = entry.queries()[name](spark, folder)
    sql = entry.oracle_sql().get(name)
    if sql is None:
        assert len(set(df.columns)) == len(df.columns)
        df.collect()
    else:
        assert_same(df, con, sql)


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["key_name", "key_value"] and df.count() > 0


def test_sql_only_for_queries():
    assert set(entry.oracle_sql()) <= set(entry.queries())
