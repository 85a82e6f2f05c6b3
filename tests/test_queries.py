"""Every query against its SQL twin on the smallest tables."""

import pytest
from compare import connect, rows_of, rows_of_sql

from dialoom.plans import catalog

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query_equals_its_twin(spark, db, name):
    cols, rows = rows_of(catalog.QUERIES[name](spark, SF))
    want_cols, want = rows_of_sql(db, catalog.ORACLE_SQL[name])
    assert cols == want_cols
    assert rows == want


def test_every_query_has_a_twin():
    assert set(catalog.QUERIES) == set(catalog.ORACLE_SQL)


def test_entry_module(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())
