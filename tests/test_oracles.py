"""Every query with an oracle gives the rows of its SQL, on the smallest tables."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from compare import compare, connect

ORACLES = oracle_sql()


@pytest.fixture(scope="module")
def db(sf):
    return connect(sf)


def test_every_oracle_has_its_query():
    assert set(ORACLES) <= set(queries())


def test_entry(spark):
    assert entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(queries()))
def test_query(spark, sf, db, name):
    df = queries()[name](spark, sf)
    if name not in ORACLES:
        assert df.columns and df.count() >= 0
        return
    assert compare(df, db, ORACLES[name]) is None
