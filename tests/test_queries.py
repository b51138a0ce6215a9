"""Every registered query of the engine against its SQL on the smallest tables."""

import pytest
from compare import duck, same
from conftest import SF

from permaway import catalog


@pytest.mark.parametrize("name", sorted(catalog.SQL))
def test_query_equals_sql(spark, name):
    same(catalog.QUERIES[name](spark, SF).toPandas(), duck(catalog.SQL[name], SF))


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - set(catalog.SQL)))
def test_query_without_sql_gives_rows(spark, name):
    df = catalog.QUERIES[name](spark, SF)
    assert df.columns and df.count() >= 0


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())
