"""Every registered query against its SQL, and the others for their shape."""

import __spark_entry__ as entry
import pytest
from compare import SF_DIR, compare, duck_tables

QUERIES, ORACLES = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return duck_tables(SF_DIR)


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equal_to_sql(spark, duck, name):
    result = compare(spark, duck, QUERIES[name], ORACLES[name], SF_DIR)
    assert result["problems"] == []
    assert result["rows"] > 0


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_rows_only(spark, name):
    rows = QUERIES[name](spark, SF_DIR)
    assert rows.count() > 0


def test_entry(spark):
    assert entry.entry(spark).columns[-1] == "centroid_id"
