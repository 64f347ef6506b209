"""Queries beside their DuckDB SQL, on the smallest tables."""

import duckdb
import pytest

from quayside.llm.queries import ORACLES, QUERIES
from tests.oracle import TESTDATA, duck, table_of

SF = f"{TESTDATA}/sf0.001"


@pytest.mark.parametrize("name", [n for n, sql in ORACLES.items() if sql])
def test_query(spark, name):
    df = QUERIES[name](spark, SF)
    con = duck(SF)
    cur = con.execute(ORACLES[name])
    assert table_of(df.columns, [tuple(r) for r in df.collect()]) == table_of([d[0] for d in cur.description], cur.fetchall())
