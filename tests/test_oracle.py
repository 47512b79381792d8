"""Every registered query against its SQL over the whole small tables."""

import os

import pytest

from tidemark.queries import catalog

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    from compare import duck

    return duck(SF)


@pytest.mark.parametrize("name", list(catalog.QUERIES))
def test_query(spark, con, name):
    from compare import compare

    ok, message, _ = compare(spark, con, name, SF)
    assert ok, message
    assert "TYPES" not in message, message


def test_entry(spark):
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries())
    assert e.entry(spark).count() > 0
