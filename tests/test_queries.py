"""Every registered query against its SQL, on the smallest tables."""

import duckdb
import pytest

from quayside.plans import QUERIES
from tests.oracle import TESTDATA, compare, duck

SF = f"{TESTDATA}/sf0.001"


@pytest.fixture(scope="module")
def con():
    con = duck(SF)
    yield con
    con.close()


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, name):
    assert compare(spark, con, QUERIES[name], SF) is None


def test_entry_contract(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(QUERIES) <= set(entry.queries())
