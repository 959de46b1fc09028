"""Every registered query against its SQL, at the smallest scale."""

import pytest

import __spark_entry__ as entry
from oracle import compare, connect

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query(spark, con, name):
    query, sql = entry.queries()[name], entry.oracle_sql().get(name)
    if sql is None:
        assert query(spark, SF).count() > 0
    else:
        assert compare(spark, con, name, query, sql, SF) == []


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == [
        "split", "year", "month", "papers", "total_tokens", "blocks", "counted_blocks", "short_tails",
    ]
