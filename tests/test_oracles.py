"""Every registered query against its SQL on the smallest tables."""

import pytest
from conftest import SF_DIR

from check import compare
from oracle.catalog import oracle_sql
from txnlake.catalog import queries

QUERIES, ORACLES = queries(), oracle_sql()


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_oracle(spark, name):
    ok, note = compare(QUERIES[name](spark, SF_DIR), SF_DIR, ORACLES[name])
    assert ok, note


def test_entry_gives_the_daily_summary(spark):
    import __spark_entry__

    df = __spark_entry__.entry(spark)
    assert df.columns[:4] == ["txn_date", "status", "channel", "currency"]
    assert df.count() > 0
