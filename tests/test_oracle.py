"""Every registered query against its SQL twin on the smallest tables."""

import pytest

import __spark_entry__ as E
from support import assert_same, duck

SF = "/root/testdata/sf0.001"
SQL = E.oracle_sql()


def test_every_query_has_a_twin():
    import lowtide.catalog.cohorts as cohorts
    import lowtide.catalog.crosswalks as crosswalks
    import lowtide.catalog.measures as measures
    import lowtide.catalog.reports as reports
    import lowtide.catalog.tables as tables

    for module in (tables, crosswalks, cohorts, measures, reports):
        assert set(module.QUERIES) <= set(SQL)


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_as_sql(spark, name):
    assert_same(E.queries()[name](spark, SF), duck(SF), SQL[name])


def test_entry(spark):
    assert E.entry(spark).count() > 0
