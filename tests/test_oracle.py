"""Every registered query against its SQL twin on the smallest tables."""

import compare
import pytest

import __spark_entry__ as spark_entry
from parcelflow.plans import catalog, oracle

SF_DIR = "/root/testdata/sf0.001"

# Results that can be empty on small tables.
MAY_BE_EMPTY = set()


@pytest.fixture(scope="module")
def db():
    return compare.connect(SF_DIR)


def test_every_query_has_a_twin():
    assert set(catalog.all_queries()) == set(oracle.all_sql())
    assert set(catalog.all_queries()) <= set(spark_entry.queries())


@pytest.mark.parametrize("name", sorted(catalog.all_queries()))
def test_query(spark, db, name):
    assert compare.check(spark, db, name, SF_DIR) > 0 or name in MAY_BE_EMPTY


def test_entry(spark):
    assert spark_entry.entry(spark).columns == ["package_id", "subpackage_id", "items_quantity"]
