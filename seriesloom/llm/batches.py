"""Running a function over Arrow batches beside the columns a table already has."""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterable, Iterator, Mapping
from types import ModuleType
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

#: Words are what lies between ASCII white space: bytes.split() and this set agree.
SPACES = b"\x09\x0a\x0b\x0c\x0d\x20"


def texts(column: pa.Array) -> list[bytes]:
    """UTF-8 of every text; null counts as empty."""
    return [b"" if x is None else x for x in column.cast(pa.binary()).to_pylist()]


def with_computed(
    df: DataFrame,
    columns: Mapping[str, str],
    make: Callable[[], Callable[[pa.RecordBatch], Mapping[str, Any]]],
) -> DataFrame:
    """Append ``columns`` (name to SQL type), computed batch by batch from the input's columns.

    ``make`` is called once per task and returns the function of a batch; what it sets up (tables, caches)
    lives as long as the task. Input columns named like an output column, in any case, are replaced.
    """
    taken = {c.lower() for c in columns}
    kept = [f for f in df.schema.fields if f.name.lower() not in taken]
    added = T.StructType.fromDDL(", ".join(f"`{c}` {t}" for c, t in columns.items()))
    schema = T.StructType(kept + added.fields)
    names = [f.name for f in kept]
    arrow = to_arrow_schema(added)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compute = make()
        # a batch of Spark's size held as Python values, and once more on its way back, fills a worker
        for batch in (whole.slice(at, 2000) for whole in batches for at in range(0, whole.num_rows, 2000)):
            new = compute(batch)
            arrays = [batch.column(n) for n in names]
            for f in arrow:
                value = new[f.name]
                arrays.append(value.cast(f.type) if isinstance(value, pa.Array) else pa.array(value, f.type))
            yield pa.RecordBatch.from_arrays(arrays, names + arrow.names)

    return df.mapInArrow(run, schema)


def free_name(columns: Iterable[str], name: str) -> str:
    """``name`` with as many underscores before it as keep it apart from all columns."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def per_process(key: Any, build: Callable[[], Any]) -> Any:
    """What ``build`` returns, kept under ``key`` as long as the Python process lives.

    Functions are shipped by value, so a module of this package has no state that outlasts a task.
    """
    held = sys.modules.setdefault("_seriesloom_worker", ModuleType("_seriesloom_worker")).__dict__
    if key not in held:
        held[key] = build()
    return held[key]


def portions(rows: list[bytes], most: int = 2 << 20) -> Iterator[list[bytes]]:
    """Consecutive rows of about ``most`` bytes at a time; a longer row comes alone."""
    part, size = [], 0
    for row in rows:
        if part and size + len(row) > most:
            yield part
            part, size = [], 0
        part.append(row)
        size += len(row)
    if part:
        yield part
