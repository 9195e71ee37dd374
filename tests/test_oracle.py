"""Every registered query equals its SQL; see also ``python -m checks.compare``."""

import pytest

import __spark_entry__ as entry
from checks.compare import connect, differences

# Queries on texts have tests of their own, as some have no SQL.
QUERIES = {name: query for name, (query, _) in entry.registry().items()}
ORACLE = entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    from tests.conftest import SF_DIR

    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf, con, name):
    df = QUERIES[name](spark, sf)
    if name in ORACLE:
        assert differences(df, con, ORACLE[name]) is None
    else:
        assert df.columns


def test_every_query_has_sql():
    assert set(QUERIES) <= set(ORACLE)


def test_entry(spark):
    assert entry.entry(spark).count() > 0
