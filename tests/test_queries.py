"""Every registered query beside its SQL on the smallest tables."""

import pytest

import __spark_entry__ as entry_points
from verification.compare import difference
from verification.oracle import ORACLE_SQL
from verification.queries import QUERIES

SF_DIR = entry_points.SMALLEST


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE_SQL)
    assert set(QUERIES) <= set(entry_points.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, name):
    assert difference(spark, SF_DIR, QUERIES[name], ORACLE_SQL[name]) is None


def test_entry(spark):
    assert entry_points.entry(spark).limit(1).count() == 1
