"""Every registered query against its SQL twin."""

import importlib

import pytest
from compare import connect, differences

from estrato.workload import oracles, runnable

FOLDER = "/root/testdata/sf0.01"
entry_point = importlib.import_module("__spark_entry__")
ORACLES = oracles()
QUERIES = runnable()


@pytest.fixture(scope="module")
def duck():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    found = QUERIES[name](spark, FOLDER).toArrow()
    if name in ORACLES:
        assert differences(found, duck.sql(ORACLES[name]).to_arrow_table()) == []
    assert found.num_rows > 0


def test_oracles_belong_to_queries():
    """Every query of the library itself has one; those of optional parts have their own tests."""
    assert set(ORACLES) == set(QUERIES)
    assert set(QUERIES) <= set(entry_point.queries()) and set(ORACLES) <= set(entry_point.oracle_sql())


def test_entry(spark):
    assert entry_point.entry(spark).columns[:5] == ["modelo", "fabricante", "origen_pais", "mes", "anio"]
