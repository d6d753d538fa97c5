"""Groups of texts by the exact Jaccard similarity of their word shingles, with prefix candidates."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping
from fractions import Fraction
from typing import Any

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .batches import texts, with_computed
from .components import components
from .storing import sent_whole, stored


def shingle_set(data: bytes, size: int = 5) -> np.ndarray:
    """Sorted distinct XXH64 of the shingles of ``size`` words; A-Z are lower-cased, words are what lies between
    ASCII white space, a shorter text is one shingle, a text without words has none."""
    words = data.lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    last = max(1, len(words) - size + 1)
    digest = xxhash.xxh64_intdigest
    found = [digest(joined[s:e]) for s, e in zip(starts[:last].tolist(), ends[len(words) - last :].tolist())]
    return np.unique(np.array(found, np.uint64))


def _common(docs: DataFrame, text: str, size: int, sample_bytes: int = 32 << 20) -> np.ndarray:
    """Shingles that many texts of a sample hold. They only decide the order in which prefixes are taken."""
    total = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    share = min(1.0, sample_bytes / max(total, 1))
    drawn = docs.select(text).sample(share, seed=7) if share < 1 else docs.select(text)

    def hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingle_set(x, size) for x in texts(batch.column(text))]
            yield pa.RecordBatch.from_pydict({"h": np.concatenate(sets).view(np.int64) if sets else np.zeros(0, np.int64)})

    counts = drawn.mapInArrow(hashes, "h long").groupBy("h").agg(F.count(F.lit(1)).alias("n"))
    rows = counts.where(F.col("n") >= max(3, round(64 * share))).select("h").toArrow()
    return np.sort(rows.column("h").to_numpy().view(np.uint64))


def _prefixes(nodes: DataFrame, text: str, size: int, similarity: Fraction, common: np.ndarray) -> DataFrame:
    """``h``, ``node``, ``n``, ``times``: of each node the shingles of which one at least is shared by any set that
    is similar enough. Rare shingles come first, then by hash, in one order for all."""
    shared = nodes.sparkSession.sparkContext.broadcast(common)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common = shared.value
        for batch in batches:
            for start in range(0, batch.num_rows, 500):
                part = batch.slice(start, 500)
                kept, sizes = [], []
                for x in texts(part.column(text)):
                    own = shingle_set(x, size)
                    least = -(-similarity.numerator * len(own) // similarity.denominator)
                    if len(common):
                        at = np.minimum(np.searchsorted(common, own), len(common) - 1)
                        often = common[at] == own
                        own = np.concatenate([own[~often], own[often]])
                    kept.append(own[: len(own) - least + 1])
                    sizes.append(len(own))
                times = [len(x) for x in kept]
                if sum(times):
                    columns = [part.column(c).to_numpy() for c in ("node", "times")]
                    yield pa.RecordBatch.from_pydict(
                        {
                            "h": np.concatenate(kept).view(np.int64),
                            "node": np.repeat(columns[0], times),
                            "n": np.repeat(np.array(sizes, np.int32), times),
                            "times": np.repeat(columns[1], times),
                        }
                    )

    return nodes.select("node", "times", text).mapInArrow(run, "h long, node long, n int, times long")


def _whole_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Tables of rows in order of ``h`` in which no group of equal ``h`` is cut."""
    left: pa.Table | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        table = table if left is None else pa.concat_tables([left, table]).combine_chunks()
        h = table.column("h").to_numpy()
        cut = int(np.searchsorted(h, h[-1]))
        if cut:
            yield table.slice(0, cut)
        left = table.slice(cut)
    if left is not None and len(left):
        yield left


def _by_key(rows: DataFrame, make: Callable[[pa.Table], Iterator[pa.RecordBatch]], schema: str, *order: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _whole_groups(batches):
            yield from make(table)

    return rows.repartition("h").sortWithinPartitions("h", *order).mapInArrow(run, schema)


def sketch(own: np.ndarray) -> bytes:
    """How many shingles of a set fall into each of about n / 2 buckets of their hashes, one byte a bucket; empty
    if a bucket does not fit into a byte."""
    size = 1 << min(15, max(5, int(len(own) // 2).bit_length()))
    counts = np.bincount((own & np.uint64(size - 1)).astype(np.int64), minlength=size)
    return b"" if counts.max(initial=0) > 255 else counts.astype(np.uint8).tobytes()


def most_common(a: bytes, b: bytes) -> int | None:
    """No two sets with these sketches share more shingles than this; None where that is not known.

    Equal shingles fall into equal buckets, and into equal ones of every smaller power of two.
    """
    if not a or not b:
        return None
    x, y = (np.frombuffer(s, np.uint8).astype(np.int64) for s in (a, b))
    size = min(len(x), len(y))
    x, y = (v.reshape(-1, size).sum(axis=0) for v in (x, y))
    return int(np.minimum(x, y).sum())


def _sketches(nodes: DataFrame, text: str, size: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = (shingle_set(x, size) for x in texts(batch.column(text)))
            rows = [(len(x), sketch(x)) for x in sets]
            yield pa.RecordBatch.from_pydict(
                {"node": batch.column("node"), "n": pa.array([r[0] for r in rows], pa.int64()), "sketch": pa.array([r[1] for r in rows], pa.binary())}
            )

    return nodes.select("node", text).mapInArrow(run, "node long, n long, sketch binary")


def _possible(pairs: DataFrame, sketches: DataFrame, similarity: Fraction) -> DataFrame:
    """The pairs whose sketches leave room for the similarity. Sketches are a tenth of the texts, and of pairs that
    only share a passage few stay."""
    one, two = (sketches.select(F.col("node").alias(c), F.col("n").alias(f"{c}_n"), F.col("sketch").alias(f"{c}_sketch")) for c in "ab")
    joined = pairs.join(one, "a").join(two, "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("a_n", "b_n", "a_sketch", "b_sketch")]
            room = []
            for n, m, x, y in zip(*columns):
                both = most_common(x, y)
                room.append(both is None or both * similarity.denominator >= similarity.numerator * (n + m - both))
            keep = pa.array(room, pa.bool_())
            yield pa.RecordBatch.from_pydict({c: batch.column(c).filter(keep) for c in "ab"})

    return joined.select("a", "b", "a_n", "b_n", "a_sketch", "b_sketch").mapInArrow(run, "a long, b long")


def _verified(pairs: DataFrame, docs: DataFrame, sketches: DataFrame, key: str, text: str, size: int, similarity: Fraction) -> DataFrame:
    """The pairs whose shingle sets are similar enough. Texts move only for pairs that their sketches leave open."""
    pairs = stored(_possible(pairs, sketches, similarity))
    ends = stored(pairs.select(F.explode(F.array("a", "b")).alias(key)).distinct())
    written = stored(docs.select(key, text).join(sent_whole(ends), key, "left_semi"))
    one, two = (written.select(F.col(key).alias(c), F.col(text).alias(f"{c}_text")) for c in "ab")
    joined = pairs.join(one, "a").join(two, "b").sortWithinPartitions("a")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, mine = None, np.zeros(0, np.uint64)
        for batch in batches:
            a, b = batch.column("a").to_pylist(), batch.column("b").to_pylist()
            near = []
            for node, x, y in zip(a, texts(batch.column("a_text")), texts(batch.column("b_text"))):
                if node != last:
                    last, mine = node, shingle_set(x, size)
                other = shingle_set(y, size)
                both = len(np.intersect1d(mine, other, assume_unique=True))
                near.append(both * similarity.denominator >= similarity.numerator * (len(mine) + len(other) - both))
            keep = pa.array(near, pa.bool_())
            yield pa.RecordBatch.from_pydict({"a": pa.array(a, pa.int64()).filter(keep), "b": pa.array(b, pa.int64()).filter(keep)})

    return joined.select("a", "b", "a_text", "b_text").mapInArrow(run, "a long, b long")


def similar_groups(docs: DataFrame, key: str, text: str = "text", size: int = 5, similarity: str = "0.8") -> DataFrame:
    """``key`` (unique longs, not null) and ``component_id``: the smallest key reachable over texts whose sets of
    ``size``-word shingles have a Jaccard similarity of at least ``similarity``.

    Equal sets are one node, texts without words among them. Two similar sets share one of their first
    n - ceil(similarity n) + 1 shingles in any order common to all, so no similar pair is missed; shingles that
    are frequent in a sample come last in that order, which only saves work. First the sets that meet under a
    shingle are compared with the one of them that has most copies, then those with each other that are still
    in different components. A sketch of each set bounds what two can share; pairs that this leaves open are
    verified by the exact similarity of the shingles' 64-bit hashes, and only their texts are moved.
    """
    ratio = Fraction(similarity)

    def make() -> Callable[[pa.RecordBatch], Mapping[str, Any]]:
        return lambda batch: {"set": [xxhash.xxh3_128_digest(shingle_set(x, size).tobytes()) for x in texts(batch.column(text))]}

    found = stored(with_computed(docs.select(key, text), {"set": "binary"}, make).select(F.col(key).alias("row"), "set"))
    sets = stored(found.groupBy("set").agg(F.min("row").alias("node"), F.count(F.lit(1)).alias("times")))
    nodes = docs.select(F.col(key).alias("node"), text).join(sent_whole(sets.select("node", "times")), "node")

    def shared(table: pa.Table) -> Iterator[pa.RecordBatch]:
        h = table.column("h").to_numpy()
        alone = np.ones(len(h), bool)
        same = h[1:] == h[:-1]
        alone[1:] &= ~same
        alone[:-1] &= ~same
        if not alone.all():
            yield from table.filter(pa.array(~alone)).combine_chunks().to_batches()

    common = _common(docs, text, size)
    met = stored(_by_key(_prefixes(nodes, text, size, ratio, common), shared, "h long, node long, n int, times long"))
    needed = stored(met.select("node").distinct())
    texts_of = docs.select(F.col(key).alias("node"), text).join(sent_whole(needed), "node", "left_semi")
    sketches = stored(_sketches(texts_of, text, size))

    def fits(n: np.ndarray, m: np.ndarray) -> np.ndarray:
        return np.minimum(n, m).astype(np.int64) * ratio.denominator >= np.maximum(n, m).astype(np.int64) * ratio.numerator

    def emitted(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
        pairs = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)], axis=1), axis=0)
        return pa.RecordBatch.from_pydict({"a": pairs[:, 0], "b": pairs[:, 1]})

    def stars(table: pa.Table) -> Iterator[pa.RecordBatch]:
        h, node, n = (table.column(c).to_numpy() for c in ("h", "node", "n"))
        first = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]]))
        hub = np.repeat(first, np.diff(np.append(first, len(h))))
        near = (hub != np.arange(len(h))) & fits(n, n[hub])
        if near.any():
            yield emitted(node[hub[near]], node[near])

    def others(table: pa.Table) -> Iterator[pa.RecordBatch]:
        h, node, n, part = (table.column(c).to_numpy() for c in ("h", "node", "n", "component"))
        step, a, b, held = 1, [], [], 0
        at = np.flatnonzero(h[1:] == h[:-1])
        while len(at):
            # sizes grow within a key: who does not fit the next does not fit those after it
            at = at[fits(n[at], n[at + step])]
            differ = at[part[at] != part[at + step]]
            a.append(node[differ])
            b.append(node[differ + step])
            held += len(differ)
            if held > 1 << 20:
                yield emitted(np.concatenate(a), np.concatenate(b))
                a, b, held = [], [], 0
            step += 1
            at = at[at + step < len(h)]
            at = at[h[at] == h[at + step]]
        if held:
            yield emitted(np.concatenate(a), np.concatenate(b))

    hubs = _by_key(met.withColumn("rest", -F.col("times")), stars, "a long, b long", "rest", "node").distinct()
    links = stored(_verified(hubs, docs, sketches, key, text, size, ratio))
    parts = stored(components(links))
    placed = met.join(sent_whole(parts), "node", "left").withColumn("component", F.coalesce("component", "node"))
    mixed = placed.groupBy("h").agg(F.min("component").alias("x"), F.max("component").alias("y")).where("x < y").select("h")
    apart = placed.join(mixed, "h", "left_semi").select("h", "node", "n", "component")
    pairs = _by_key(apart, others, "a long, b long", "n", "node").distinct()
    links = stored(links.union(_verified(pairs, docs, sketches, key, text, size, ratio)))
    parts = components(links)
    names = sets.join(parts, "node", "left").select("set", F.coalesce("component", "node").alias("component_id"))
    return found.join(names, "set").select(F.col("row").alias(key), "component_id")
