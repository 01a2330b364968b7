"""Every registered query with an oracle: Spark result == DuckDB result on the sf0.001 tables."""

import pytest

from oracle import compare, duck
from quarry.plans.registry import QUERIES, SQL

EXACT = sorted(SQL)


@pytest.fixture(scope="module")
def con(small_dir):
    return duck(small_dir)


@pytest.mark.parametrize("name", EXACT)
def test_query_matches_sql(spark, small_dir, con, name):
    ok, msg = compare(QUERIES[name](spark, small_dir), con, SQL[name])
    assert ok, f"{name}: {msg}"


def test_every_query_is_registered_in_entry():
    import __spark_entry__ as entry

    assert set(QUERIES) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())
