"""Every registered query against its SQL twin, on the smallest tables."""

import pytest
import __spark_entry__ as entry
from tools.compare import compare, duck


# No snapshot reaches the row cap on tables this small.
EMPTY_ON_SMALL_TABLES = {"capped_sources"}


@pytest.fixture(scope="module")
def con(sf_dir):
    return duck(sf_dir)


@pytest.mark.parametrize("name", list(entry.queries()))
def test_query_equals_sql(spark, con, sf_dir, name):
    problem, n_rows, _, _ = compare(spark, con, sf_dir, name, entry.queries()[name], entry.oracle_sql().get(name))
    assert problem is None, problem
    assert n_rows > 0 or name in EMPTY_ON_SMALL_TABLES


def test_entry(spark):
    assert entry.entry(spark).columns == ["query_id", "catalog_id", "score", "rank"]
