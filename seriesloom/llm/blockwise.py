"""Sequences whose distinct elements are looked up by a shuffle: explode, join by element, reassemble by place.

A corpus has far more occurrences than elements, and a few elements hold most occurrences. So occurrences are
grouped before any shuffle: the rows of one Arrow batch form a block, which names each of its distinct elements
once and keeps, for every occurrence in order, the number of its element. Joins meet one row for each element of
a block, however often it occurs there; an element that a third of all rows hold is one row a block.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Any, NamedTuple
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from .storing import stored_by


class Exploded(NamedTuple):
    """One batch of rows: the columns to keep, where each row's elements end, and all elements in order, as an
    array of elements or as one of their numbers in a dictionary."""

    rows: pa.RecordBatch
    ends: np.ndarray
    elements: pa.Array


def _bytes(batch: pa.RecordBatch) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_batch(batch)
    return sink.getvalue().to_pybytes()


def _table(data: bytes) -> pa.Table:
    return pa.ipc.open_stream(data).read_all()


def _places(places: np.ndarray) -> pa.RecordBatch:
    """Places as four planes of bytes, of which the upper ones are nearly all zero."""
    return pa.record_batch({"place": places.astype("<u4").view("u1").reshape(-1, 4).T.ravel()})


def _placed(planes: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(planes.reshape(4, -1).T).view("<u4").ravel().astype(np.int64)


def cut(batch: pa.RecordBatch, sizes: np.ndarray, most: int = 16 << 20) -> Iterator[pa.RecordBatch]:
    """Consecutive slices of a batch of about ``most`` bytes by the given size of each row; a larger row comes
    alone."""
    start, held = 0, 0
    for i, size in enumerate(sizes.tolist()):
        if i > start and held + size > most:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += size
    if start < batch.num_rows:
        yield batch.slice(start)


def text_sizes(column: pa.Array) -> np.ndarray:
    """UTF-8 bytes of every text; null has none."""
    sizes = pc.binary_length(column.cast(pa.large_binary()))
    return pc.fill_null(sizes, 0).to_numpy(zero_copy_only=False).astype(np.int64)


def explode(
    df: DataFrame,
    make: Callable[[], Callable[[pa.RecordBatch], Iterator[Exploded]]],
    element: str,
    size: Column,
    bucket_bytes: int = 32 << 20,
) -> DataFrame:
    """A stored table with a row for each block: ``block``, ``rows``, ``ends`` and ``places`` (packed),
    ``elements``, its distinct elements as an array of SQL type ``element``, the most frequent first, and
    ``counts``, how often each occurs.

    ``make`` is called once per task and returns the function that turns a batch into blocks. The table is
    bucketed by block, so that it need not move when it is reassembled; ``size``, the bytes of a row, gives the
    number of buckets, at most Spark's limit of 100,000.
    """
    total = df.agg(F.sum(size)).first()[0] or 0
    buckets = min(100_000, max(8, -(-total // bucket_bytes)))
    schema = f"block long, rows binary, ends binary, places binary, counts array<int>, elements array<{element}>"
    arrow = to_arrow_schema(T.StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split, number = make(), TaskContext.get().partitionId() << 32
        for batch in batches:
            for part in split(batch) if batch.num_rows else ():
                coded = part.elements
                if not isinstance(coded, pa.DictionaryArray):
                    coded = coded.dictionary_encode()
                n = len(coded.dictionary)
                counts = np.bincount(coded.indices.to_numpy(zero_copy_only=False), minlength=n).astype(np.int32)
                order = np.argsort(-counts, kind="stable")
                number_of = np.empty(n, np.int32)
                number_of[order] = np.arange(n)
                places = number_of[coded.indices.to_numpy(zero_copy_only=False)]
                row = [number], [_bytes(part.rows)], [part.ends.astype("<i8").tobytes()], [_bytes(_places(places))]
                lists = pa.array(counts[order]), coded.dictionary.take(pa.array(order))
                arrays = [pa.array(x, f.type) for x, f in zip(row, arrow)]
                arrays += [pa.ListArray.from_arrays(pa.array([0, n], pa.int32()), x) for x in lists]
                yield pa.RecordBatch.from_arrays([x.cast(f.type) for x, f in zip(arrays, arrow)], schema=arrow)
                number += 1

    return stored_by(df.mapInArrow(run, schema), "block", buckets)


def elements(blocks: DataFrame, name: str = "element") -> DataFrame:
    """``block``, ``place`` and the element: one row for each distinct element of a block."""
    return blocks.select("block", F.posexplode("elements").alias("place", name))


def occurrences(blocks: DataFrame, name: str = "element") -> DataFrame:
    """``element`` and ``n``, how often it occurs in all blocks."""
    pairs = F.explode(F.arrays_zip(F.col("elements").alias("e"), F.col("counts").alias("n")))
    found = blocks.select(pairs.alias("x")).select(F.col("x.e").alias(name), F.col("x.n").cast("long").alias("n"))
    return found.groupBy(name).agg(F.sum("n").alias("n"))


def by_element(
    blocks: DataFrame, make: Callable[[], Callable[[pa.Array], pa.Array]], value: str, most: int = 1 << 20
) -> DataFrame:
    """What a function makes of each element, packed for ``reassemble`` as the column ``value``.

    Elements (binary) are shuffled by hash into groups of about ``most`` rows, one row for each distinct element of
    a block. ``make`` returns a function from the distinct elements of a group to their values, so each distinct
    element is met once in the whole table. Elements and values move packed, by block and group.
    """
    total = blocks.agg(F.sum(F.size("elements"))).first()[0] or 0
    groups = max(8, -(-total // most))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                own = batch.column("elements")[i].values
                if not len(own):
                    continue
                group = np.fromiter((crc32(w) % groups for w in own.to_pylist()), np.int32, len(own))
                order = np.argsort(group, kind="stable").astype(np.int32)
                rows = pa.record_batch({"place": order, "element": own.take(pa.array(order))})
                starts = np.flatnonzero(np.diff(group[order], prepend=-1)).tolist()
                parts = [_bytes(rows.slice(a, b - a)) for a, b in zip(starts, [*starts[1:], len(order)])]
                yield pa.record_batch(
                    {
                        "group": pa.array(group[order][starts], pa.int32()),
                        "block": pa.array([batch.column("block")[i].as_py()] * len(parts), pa.int64()),
                        "part": pa.array(parts, pa.binary()),
                    }
                )

    def find(held: pa.Table) -> pa.Table:
        parts = [_table(x) for x in held["part"].to_pylist()]
        coded = pa.concat_tables(parts)["element"].combine_chunks().dictionary_encode()
        values, out, at = make()(coded.dictionary), [], 0
        for part in parts:
            own = values.take(coded.indices.slice(at, len(part)))
            at += len(part)
            out.append(_bytes(pa.record_batch({"place": part["place"].combine_chunks(), value: own})))
        return pa.table({"block": held["block"], "part": pa.array(out, pa.binary())})

    dealt = blocks.select("block", "elements").mapInArrow(deal, "group int, block long, part binary")
    return dealt.groupBy("group").applyInArrow(find, "block long, part binary")


def packed(found: DataFrame) -> DataFrame:
    """Rows of (block, place, values...) as few packed rows a block, so that the shuffle moves them compressed."""
    names = [c for c in found.columns if c != "block"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            block = batch.column("block").to_numpy()
            if not len(block):
                continue
            starts = np.flatnonzero(np.concatenate([[True], block[1:] != block[:-1]])).tolist()
            inner = batch.select(names)
            parts = [_bytes(inner.slice(a, b - a)) for a, b in zip(starts, [*starts[1:], len(block)])]
            yield pa.record_batch({"block": block[starts], "part": pa.array(parts, pa.binary())})

    return found.sortWithinPartitions("block").mapInArrow(run, "block long, part binary")


def reassemble(
    blocks: DataFrame,
    found: DataFrame,
    schema: T.StructType,
    make: Callable[[], Callable[[Exploded, pa.Table, np.ndarray], dict[str, Any]]],
) -> DataFrame:
    """The kept rows of every block with columns computed from what was found for its elements.

    ``found`` (of ``packed`` or ``by_element``) has for each element of each block its place and values. The function that
    ``make`` returns gets the block, the table of values in the order of places, and for each occurrence in
    order the row of that table; it returns the columns of ``schema`` that the kept rows do not have. A block is
    one group, bounded by the size of the batch it came from.
    """
    names = [f.name for f in schema.fields]
    arrow = to_arrow_schema(schema)

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows:
            return arrow.empty_table()
        rows = _table(left["rows"][0].as_py()).combine_chunks()
        ends = np.frombuffer(left["ends"][0].as_py(), "<i8")
        places = _placed(_table(left["places"][0].as_py())["place"].to_numpy())
        parts = [_table(x) for x in right["part"].to_pylist()]
        values = pa.concat_tables(parts).sort_by("place").combine_chunks() if parts else pa.table({"place": []})
        kept = rows.to_batches()[0] if rows.num_rows else pa.RecordBatch.from_pylist([], rows.schema)
        new = make()(Exploded(kept, ends, pa.nulls(0)), values, places)
        # names of kept columns may repeat those computed only if the caller dropped them before
        whole = {n: new[n] if n in new else rows[n] for n in names}
        return pa.Table.from_arrays(
            [x.cast(f.type) if isinstance(x, pa.ChunkedArray | pa.Array) else pa.array(x, f.type) for x, f in zip(whole.values(), arrow)],
            schema=arrow,
        )

    content = blocks.select("block", "rows", "ends", "places").groupBy("block")
    return content.cogroup(found.groupBy("block")).applyInArrow(run, schema)
