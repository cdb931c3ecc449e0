"""Every registered query against its SQL, on the smallest tables."""

import pytest
from check_queries import compare, connect

import __spark_entry__ as entry
from quayside import examples

SF_DIR = "/root/testdata/sf0.001"


def test_every_query_has_its_sql():
    assert set(examples.QUERIES) == set(examples.ORACLES)
    assert set(examples.QUERIES) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(examples.QUERIES))
def test_query_equals_sql(spark, name):
    assert compare(spark, connect(SF_DIR), name, SF_DIR) is None


def test_entry_gives_rows(spark):
    assert entry.entry(spark).count() > 0
