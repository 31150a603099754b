"""Every registered query against DuckDB on the same tables."""

import __spark_entry__ as entry_point
import pytest
from compare import connect, difference

QUERIES, ORACLES = entry_point.queries(), entry_point.oracle_sql()


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(name, spark, sf_dir, con):
    df = QUERIES[name](spark, sf_dir)
    if name in ORACLES:
        assert difference(df, con, ORACLES[name]) is None
    else:
        assert df.count() > 0
    assert len(set(df.columns)) == len(df.columns)


def test_entry(spark):
    df = entry_point.entry(spark)
    assert df.count() > 0
    assert df.columns == ["c_custkey", "c_mktsegment", "order_count", "total_price", "latest_order"]


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)
