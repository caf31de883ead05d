"""Every query with SQL against DuckDB on the smallest tables, where those exist."""

import os

import pytest

import __spark_entry__ as entry
from oracle import compare, connect

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no tables")


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


def _own() -> dict[str, str]:
    return {k: v for m in entry._modules() if ".llm" not in m.__name__ for k, v in m.ORACLES.items()} if os.path.isdir(FOLDER) else {}


@pytest.mark.parametrize("name", sorted(_own()))
def test_same_as_sql(spark, con, name):
    assert compare(spark, con, FOLDER, name, entry.queries()[name], entry.oracle_sql()[name]) == ""


def test_entry(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", ["p2_found", "p6_found", "p7_found", "p2_products", "p7_flagged", "p6_places_per_country"])
def test_curation_queries_run(spark, name):
    assert entry.queries()[name](spark, FOLDER).count() > 0
