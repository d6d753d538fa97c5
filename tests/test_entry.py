"""The driver contract: a flagship frame, queries and the SQL for them."""

from __future__ import annotations

import __spark_entry__ as entry
from seriesloom.catalog import QUERIES


def test_contract(spark):
    assert entry.entry(spark).count() > 0
    queries, oracle = entry.queries(), entry.oracle_sql()
    assert set(oracle) <= set(queries)
    queries = {q for q in queries if q in QUERIES}
    assert set(queries) <= set(oracle)
