"""Every registered query against its SQL, on the smallest tables."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from check import differences
from reviewloom.plans.queries import QUERIES


def test_every_query_has_sql():
    assert set(QUERIES) <= set(queries()) and set(QUERIES) <= set(oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, duck, folder, name):
    got = queries()[name](spark, folder).toPandas()
    assert differences(got, duck.sql(oracle_sql()[name]).df()) == ""


def test_entry_has_rows(spark):
    df = entry(spark)
    assert df.columns == ["restaurant_name", "food", "service", "ambiance"]
    assert df.count() > 0
