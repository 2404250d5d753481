"""Every registered query against its SQL on the smallest tables."""

import pytest

import __spark_entry__ as entry
from tools.check import compare

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query_matches_sql(spark, name):
    ok, message, _ = compare(spark, FOLDER, name, entry.queries()[name], entry.oracle_sql().get(name))
    assert ok is not False, message


def test_every_sql_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_has_rows(spark):
    assert entry.entry(spark).limit(1).count() == 1
