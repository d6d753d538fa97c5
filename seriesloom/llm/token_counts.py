"""Token counts of fields and sections from one encoding of the whole document."""

from __future__ import annotations

import base64
from collections.abc import Iterator, Sequence
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from .batches import per_process, texts

#: Fixed value: the pattern that splits text before the merges of the rank file.
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
COLUMNS = {
    "field": "string",
    "section": "int",
    "start": "long",
    "n_chars": "long",
    "n_tokens": "long",
    "n_shared": "long",
    "doc_tokens": "long",
}
RULES = ("most", "first", "last")


def allocate(ends: np.ndarray, bounds: np.ndarray, rule: str = "most") -> tuple[np.ndarray, np.ndarray]:
    """Tokens of each section, and how many of them reach into another section.

    ``ends`` are the tokens' ends and ``bounds`` the sections' ends in bytes, both rising; each list covers the
    whole document without gaps, so the overlap join is two binary searches. A token that crosses a boundary
    goes to the section that holds ``most`` of its bytes (the earlier one if equal), its ``first`` or its
    ``last`` byte. Empty sections have no tokens.
    """
    n = len(bounds)
    starts = np.concatenate([[0], ends])[:-1]
    owner = np.searchsorted(bounds, starts, "right")
    other = np.searchsorted(bounds, ends - 1, "right")
    across = np.flatnonzero(owner != other)
    if rule == "last":
        owner[across] = other[across]
    elif rule == "most":
        for t in across:
            inner = bounds[owner[t] : other[t]]
            share = np.diff(np.concatenate([[starts[t]], inner, [ends[t]]]))
            owner[t] += int(share.argmax())
    return np.bincount(owner, minlength=n), np.bincount(owner[across], minlength=n)


def token_counts(
    docs: DataFrame,
    path: str,
    key: str = "doc_id",
    fields: Sequence[str] = ("text",),
    separator: str = "\n",
    rule: str = "most",
) -> DataFrame:
    """A row for each section of each document with the tokens that belong to it.

    The document is its ``fields`` joined by ``separator``, encoded once as a whole, so counts of a document's
    sections add up to ``doc_tokens``, which encoding the sections one by one would not. A section is a line
    of a field with the line end, and the separator belongs to the field before it. ``start`` and ``n_chars``
    are code points in the document; ``n_shared`` tokens of the section reach into a neighbour (see
    ``allocate`` for ``rule``). ``path`` is a rank file on the driver.

    A null field is empty; an empty field is one section, without tokens if it is the last. Null keys and
    repeated rows are counted like others; no rows give no rows; further columns are left out.
    """
    if rule not in RULES:
        raise ValueError(f"rule is one of {', '.join(RULES)}")
    with open(path, "rb") as f:
        content = docs.sparkSession.sparkContext.broadcast(f.read())
    schema = T.StructType([docs.schema[key], *T.StructType.fromDDL(", ".join(f"{c} {t}" for c, t in COLUMNS.items())).fields])
    arrow = to_arrow_schema(schema)
    gap = separator.encode()

    def build() -> tuple[Any, np.ndarray]:
        import tiktoken

        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, content.value.splitlines())}
        sizes = np.zeros(max(ranks.values()) + 1, np.int64)
        for token, rank in ranks.items():
            sizes[rank] = len(token)
        return tiktoken.Encoding("ranks", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={}), sizes

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding, sizes = per_process(("ranks", path), build)
        for batch in batches:
            rows: list[tuple] = []
            held = 0
            for k, *values in zip(batch.column(key).to_pylist(), *(texts(batch.column(c)) for c in fields)):
                parts = [v + gap for v in values[:-1]] + values[-1:]
                lines = [line for v in parts for line in _lines(v)]
                counts = [len(_lines(v)) for v in parts]
                whole = b"".join(parts)
                bounds = np.cumsum(np.fromiter(map(len, lines), np.int64, len(lines)))
                ids = encoding.encode_to_numpy(whole.decode(), disallowed_special=())
                own, shared = allocate(np.cumsum(sizes[ids]), bounds, rule)
                # code points: bytes that begin one, counted up to each bound
                leads = np.cumsum((np.frombuffer(whole, np.uint8) & 0xC0) != 0x80)
                chars = np.concatenate([[0], np.concatenate([[0], leads])[bounds]])
                place = [(f, i) for f, n in zip(fields, counts) for i in range(n)]
                rows += [
                    (k, f, i, s, e - s, n, x, len(ids))
                    for (f, i), s, e, n, x in zip(place, chars[:-1].tolist(), chars[1:].tolist(), own.tolist(), shared.tolist())
                ]
                held += len(whole)
                if len(rows) >= 50_000 or held >= 16 << 20:
                    yield _batch(rows, arrow)
                    rows, held = [], 0
            if rows:
                yield _batch(rows, arrow)

    return docs.select(key, *fields).mapInArrow(run, schema)


def _lines(data: bytes) -> list[bytes]:
    """Lines with their ends; one empty line for no data. Only the line feed ends a line."""
    parts = data.split(b"\n")
    lines = [p + b"\n" for p in parts[:-1]]
    return lines + parts[-1:] if parts[-1] or not lines else lines


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
