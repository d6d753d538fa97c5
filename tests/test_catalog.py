"""Every registered query with an SQL equivalent gives the same columns, types and rows."""

from __future__ import annotations

import math

import pytest

from seriesloom.catalog import ORACLE, QUERIES

KINDS = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "timestamp_ntz": "TIMESTAMP",
    "boolean": "BOOLEAN",
}


def _cell(x):
    if x is None:
        return "null"
    if isinstance(x, float):
        return "nan" if math.isnan(x) else repr(x + 0.0)
    return x.isoformat() if hasattr(x, "isoformat") else repr(x)


def _rows(rows):
    return sorted(tuple(_cell(x) for x in r) for r in rows)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_sql(name, spark, sf, duck):
    df = QUERIES[name](spark, sf)
    cols = sorted(df.columns)
    expected = duck.sql(ORACLE[name])
    assert cols == sorted(expected.columns)
    kinds = {f.name: KINDS[f.dataType.simpleString()] for f in df.schema.fields}
    assert kinds == {c: str(t) for c, t in zip(expected.columns, expected.types)}
    got = _rows(df.select(*[f"`{c}`" for c in cols]).collect())
    want = _rows(duck.sql(f"select {', '.join(f'"{c}"' for c in cols)} from ({ORACLE[name]})").fetchall())
    assert got == want
