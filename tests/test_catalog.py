"""Every registered query: a stable schema, and the rows of its SQL."""

import pytest

from tests.conftest import SF
from spanguard.plans.catalog import ORACLE_SQL, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_its_sql(name, same):
    same(QUERIES[name], ORACLE_SQL[name])


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE_SQL)))
def test_query_without_sql_runs(name, spark):
    df = QUERIES[name](spark, SF)
    assert df.count() >= 0 and df.schema == QUERIES[name](spark, SF).schema


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() == 200
    assert set(e.oracle_sql()) <= set(e.queries())
