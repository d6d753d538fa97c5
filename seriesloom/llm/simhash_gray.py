"""SimHash near-duplicates with a hierarchical index over fingerprints in Gray order."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping
from itertools import combinations
from typing import Any

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .storing import stored as staged
from .batches import texts, with_computed
from .components import components
from .unions import smallest_labels

BITS = 64


def fingerprints(
    docs: DataFrame, text: str = "text", size: int = 4, seed: int = 42, out: str = "fingerprint_bits"
) -> DataFrame:
    """The input with the 64-bit SimHash of each text as a signed long.

    A-Z are lower-cased, words are what lies between ASCII white space, shingles are ``size`` words joined by a
    space, repeats included; a shorter text is one shingle. A bit is set if it is set in over half of the
    shingles' XXH64. Null, empty and blank texts get zero.
    """

    def make() -> Callable[[pa.RecordBatch], Mapping[str, Any]]:
        digest = xxhash.xxh64_intdigest

        def hashes(data: bytes) -> list[int]:
            words = data.lower().split()
            if not words:
                return []
            joined = b" ".join(words)
            ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
            starts = np.concatenate([[0], ends[:-1] + 1])
            last = max(1, len(words) - size + 1)
            ends = ends[len(words) - last :]
            return [digest(joined[s:e], seed) for s, e in zip(starts[:last].tolist(), ends.tolist())]

        def majority(found: list[int]) -> int:
            if not found:
                return 0
            h = np.array(found, np.uint64)
            ones = np.zeros(BITS, np.int64)
            for i in range(0, len(h), 1 << 16):
                bits = np.unpackbits(h[i : i + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
                ones += bits.sum(axis=0, dtype=np.int64)
            return int(np.packbits(2 * ones > len(h), bitorder="little").view(np.int64)[0])

        return lambda batch: {out: [majority(hashes(x)) for x in texts(batch.column(text))]}

    return with_computed(docs, {out: "long"}, make)


def _mask(bits: range) -> int:
    m = sum(1 << b for b in bits)
    return m - (1 << BITS) if m >> (BITS - 1) else m


def _blocks(n: int) -> list[range]:
    cuts = [BITS * i // n for i in range(n + 1)]
    return [range(cuts[i], cuts[i + 1]) for i in range(n)]


def upper_masks(distinct: int, distance: int, node_size: int) -> list[int]:
    """Masks of the upper nodes: bits that fingerprints within ``distance`` share under at least one of them.

    With the bits in b blocks, at most ``distance`` blocks differ, so some b - ``distance`` blocks are equal.
    More blocks make smaller nodes and more copies; the fewest are taken that bring the mean node to
    ``node_size``.
    """
    for n in range(distance + 1, 2 * distance + 3):
        blocks = _blocks(n)
        shared = BITS * (n - distance) // n
        if distinct >> shared <= node_size:
            break
    return [sum(_mask(b) for b in chosen) for chosen in combinations(blocks, n - distance)]


def gray_rank(x: np.ndarray) -> np.ndarray:
    """Place of each 64-bit code in the reflected Gray sequence."""
    x = x.astype(np.uint64)
    for s in (1, 2, 4, 8, 16, 32):
        x = x ^ (x >> np.uint64(s))
    return x


def _patterns(codes: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each run: the bits all its codes agree on, and their values."""
    all_of, any_of = np.bitwise_and.reduceat(codes, starts), np.bitwise_or.reduceat(codes, starts)
    return ~(all_of ^ any_of), all_of


def linked_labels(codes: np.ndarray, distance: int, leaf: int = 64, fan: int = 16) -> np.ndarray:
    """Smallest row reachable from each code over links of at most ``distance`` differing bits.

    Codes are put in Gray order and cut into leaves of ``leaf``; ``fan`` nodes make a node of the next level. A
    node keeps the bits its codes share. Pairs of nodes go down from the root: differences on shared bits only
    add up on the way, so a pair of nodes with more than ``distance`` of them is dropped with all below it.
    """
    order = np.argsort(gray_rank(codes), kind="stable")
    code, n = codes[order], len(codes)
    levels = [np.arange(0, n, leaf)]
    while len(levels[-1]) > fan:
        levels.append(levels[-1][::fan])
    left = right = None
    for depth, starts in reversed(list(enumerate(levels))):
        mask, value = _patterns(code, starts)
        k = len(starts)
        if left is None:
            left, right = np.triu_indices(k)
        else:
            step = np.arange(fan)
            grid = np.broadcast_to(step[:, None], (fan, fan)).ravel(), np.broadcast_to(step, (fan, fan)).ravel()
            left, right = (
                (left[:, None] * fan + grid[0]).ravel(),
                (right[:, None] * fan + grid[1]).ravel(),
            )
            fits = (left <= right) & (right < k)
            left, right = left[fits], right[fits]
        near = np.bitwise_count((value[left] ^ value[right]) & mask[left] & mask[right]) <= distance
        left, right = left[near], right[near]
    labels = np.arange(n)
    step = np.arange(leaf)
    for i in range(0, len(left), 256):
        a = np.broadcast_to((left[i : i + 256, None] * leaf + step)[:, :, None], (len(left[i : i + 256]), leaf, leaf))
        b = np.broadcast_to((right[i : i + 256, None] * leaf + step)[:, None, :], a.shape)
        fits = (a < b) & (b < n)
        a, b = a[fits], b[fits]
        near = np.bitwise_count(code[a] ^ code[b]) <= distance
        labels = smallest_labels(n, a[near], b[near], labels)
    lowest = np.full(n, n)
    np.minimum.at(lowest, labels, order)
    out = np.empty(n, np.int64)
    out[order] = lowest[labels]
    return out


def fingerprint_links(codes: DataFrame, distance: int = 4, node_size: int = 4096, tile: int = 8192) -> DataFrame:
    """Links ``a`` - ``b`` between distinct ``code`` values, as many as their components need at most.

    An upper node holds the codes that agree on the bits of one mask. Nodes of over ``tile`` codes are cut into
    runs of Gray order; pairs of runs that differ in more than ``distance`` of the bits each of them shares are
    dropped, and each pair left is one group. Every group is indexed and searched by ``linked_labels``.
    """
    masks = upper_masks(codes.count(), distance, node_size)
    under = [
        F.struct(F.lit(i).alias("mask"), F.col("code").bitwiseAND(F.lit(m)).alias("bits")) for i, m in enumerate(masks)
    ]
    nodes = codes.select("code", F.explode(F.array(*under)).alias("n")).select("n.mask", "n.bits", "code")
    sizes = nodes.groupBy("mask", "bits").agg(F.count(F.lit(1)).alias("size"))
    large = staged(sizes.where(F.col("size") > tile))
    if large.isEmpty():
        members = nodes.select("mask", "bits", F.lit(0).alias("left"), F.lit(0).alias("right"), "code")
    else:
        members = _with_runs(nodes, large, distance, tile)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        columns = ("mask", "bits", "left", "right")

        def links(held: pa.Table) -> pa.RecordBatch:
            code = held.column("code").to_numpy().view(np.uint64)
            keys = [held.column(c).to_numpy() for c in columns]
            new = np.zeros(len(code), bool)
            new[0] = True
            for k in keys:
                new[1:] |= k[1:] != k[:-1]
            starts = np.append(np.flatnonzero(new), len(code))
            labels = np.arange(len(code))
            sizes = np.diff(starts)
            # single leaves need no tree: the rows of all of them are compared with the next, the one after it ...
            short, group = sizes <= 64, np.repeat(np.arange(len(sizes)), sizes)
            inside = short[group]
            step = 1
            while step < len(code):
                i = np.flatnonzero(inside[:-step] & (group[:-step] == group[step:]))
                if not len(i):
                    break
                near = np.bitwise_count(code[i] ^ code[i + step]) <= distance
                labels = smallest_labels(len(code), i[near], i[near] + step, labels)
                step += 1
            for g in np.flatnonzero(~short):
                s, e = starts[g], starts[g + 1]
                labels[s:e] = linked_labels(code[s:e], distance) + s
            moved = labels != np.arange(len(code))
            signed = code.view(np.int64)
            return pa.RecordBatch.from_pydict({"a": signed[moved], "b": signed[labels[moved]]})

        left: pa.Table | None = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            table = table if left is None else pa.concat_tables([left, table])
            # the last group may go on in the next batch
            last = np.ones(len(table), bool)
            for c in columns:
                values = table.column(c).to_numpy()
                last &= values == values[-1]
            cut = int(np.flatnonzero(~last)[-1]) + 1 if not last.all() else 0
            if cut:
                yield links(table.slice(0, cut))
            left = table.slice(cut)
        if left is not None and len(left):
            yield links(left)

    dealt = members.repartition("mask", "bits", "left", "right").sortWithinPartitions("mask", "bits", "left", "right")
    return dealt.mapInArrow(search, "a long, b long")


def _with_runs(nodes: DataFrame, large: DataFrame, distance: int, tile: int) -> DataFrame:
    """Members of groups: small nodes whole, large ones as pairs of runs that may hold links."""
    kept = nodes.join(large, ["mask", "bits"], "left_anti").select(
        "mask", "bits", F.lit(0).alias("left"), F.lit(0).alias("right"), "code"
    )
    rank = F.col("code")
    for s in (1, 2, 4, 8, 16, 32):
        rank = rank.bitwiseXOR(F.shiftrightunsigned(rank, s))
    ranked = nodes.join(large, ["mask", "bits"]).withColumn("rank", rank)
    # runs by equal steps of the Gray rank's quantiles: a mergeable sketch, no sort of a node in one task
    widest = int(np.ceil(2 * (large.agg(F.max("size")).first()[0]) / tile))
    cuts = ranked.groupBy("mask", "bits").agg(
        F.percentile_approx("rank", [i / widest for i in range(1, widest)] or [0.5], 100 * widest).alias("cuts")
    )
    runs = ranked.join(cuts, ["mask", "bits"]).withColumn(
        "run", F.size(F.filter("cuts", lambda c: c < F.col("rank")))
    )
    runs = staged(runs.select("mask", "bits", "run", "code"))
    shape = runs.groupBy("mask", "bits", "run").agg(F.bit_and("code").alias("all"), F.bit_or("code").alias("any"))
    shape = staged(
        shape.select(
            "mask", "bits", "run", F.bitwise_not(F.col("all").bitwiseXOR(F.col("any"))).alias("agree"), F.col("all").alias("value")
        )
    )
    one, two = shape.alias("l"), shape.alias("r")
    pairs = one.join(
        two,
        (F.col("l.mask") == F.col("r.mask"))
        & (F.col("l.bits") == F.col("r.bits"))
        & (F.col("l.run") <= F.col("r.run"))
        & (
            F.bit_count(
                F.col("l.value")
                .bitwiseXOR(F.col("r.value"))
                .bitwiseAND(F.col("l.agree"))
                .bitwiseAND(F.col("r.agree"))
            )
            <= distance
        ),
    ).select("l.mask", "l.bits", F.col("l.run").alias("left"), F.col("r.run").alias("right"))
    ends = pairs.select("*", F.explode(F.array_distinct(F.array("left", "right"))).alias("run"))
    split = ends.join(runs, ["mask", "bits", "run"]).select("mask", "bits", "left", "right", "code")
    return kept.unionByName(split)


def simhash_groups(
    docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = 4, distance: int = 4
) -> DataFrame:
    """``key``, ``fingerprint`` (16 hex digits) and ``component_id``: the smallest key reachable over links of
    fingerprints that differ in at most ``distance`` bits.

    Equal fingerprints are one node, found by a grouped minimum, so copies make no links. Texts without words
    share fingerprint zero and link like any other. Rows with a null key take part and have their group's
    smallest key (null if there is none); repeated rows stay; no rows give no rows; other columns are left out.
    """
    found = staged(fingerprints(docs.select(key, text), text, size).select(key, F.col("fingerprint_bits").alias("code")))
    codes = staged(found.groupBy("code").agg(F.min(key).alias("lowest")))
    parts = components(fingerprint_links(codes.select("code"), distance)).withColumnRenamed("node", "code")
    placed = codes.join(parts, "code", "left").withColumn("component", F.coalesce("component", "code"))
    lowest = placed.groupBy("component").agg(F.min("lowest").alias("component_id"))
    names = placed.join(lowest, "component").select("code", "component_id")
    return found.join(names, "code").select(key, F.lpad(F.lower(F.hex("code")), 16, "0").alias("fingerprint"), "component_id")
