"""Near-duplicate embeddings by products of int8 tiles with error bounds."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .storing import stored as staged
from .components import components
from .unions import smallest_labels

_SLACK = 1e-9  # covers the rounding of double products


def quantised(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Int8 codes of unit vectors, the step of each, and the length of what rounding took away."""
    step = np.abs(x).max(axis=1) / 127
    codes = np.rint(x / step[:, None]).astype(np.int8)
    return codes, step, np.linalg.norm(x - codes * step[:, None], axis=1)


def tile_links(x: np.ndarray, y: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Rows of ``x`` and ``y`` (unit vectors) with a cosine of at least ``threshold``.

    With x = x' + e and y = y' + f, where x' and y' are the codes times their steps, x.y differs from x'.y' by
    e.y + x'.f, so by at most |e| + (1 + |e|)|f|. Pairs under the threshold by more than that are no links;
    those over it by more are links; only the pairs between are multiplied in double precision. Codes are
    multiplied as whole numbers in single precision, which is exact up to 2^24 / 127^2 dimensions a block.
    """
    a, sa, ea = quantised(x)
    b, sb, eb = quantised(y)
    whole = np.zeros((len(x), len(y)), np.float32 if x.shape[1] <= 1024 else np.float64)
    for i in range(0, x.shape[1], 1024):
        whole += a[:, i : i + 1024].astype(np.float32) @ b[:, i : i + 1024].astype(np.float32).T
    # per row: the product that a column's worst error could lift to the threshold
    worst = ea + (1 + ea) * eb.max() + _SLACK
    least = (threshold - worst) / sa / sb.max()
    i, j = np.nonzero(whole >= np.where(least > 0, least * (1 - 1e-6), (threshold - worst) / sa / sb.min())[:, None])
    near = whole[i, j] * sa[i] * sb[j]
    error = ea[i] + (1 + ea[i]) * eb[j] + _SLACK
    possible = near + error >= threshold
    i, j, near, error = i[possible], j[possible], near[possible], error[possible]
    linked = near - error >= threshold
    for k in np.array_split(np.flatnonzero(~linked), max(1, len(i) * x.shape[1] >> 22)):
        linked[k] = np.einsum("nd,nd->n", x[i[k]], y[j[k]]) >= threshold
    return i[linked], j[linked]


def _unit(column: pa.Array) -> np.ndarray:
    x = np.asarray(column.flatten().to_numpy(zero_copy_only=False), np.float64).reshape(len(column), -1)
    x = x / np.abs(x).max(axis=1, keepdims=True)  # lengths neither overflow nor vanish
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def choose_pivots(x: np.ndarray, threshold: float, most: int) -> np.ndarray:
    """Rows of ``x`` (unit vectors) as cell centres: the row least like those chosen, until every row is like
    one of them or there are ``most``."""
    chosen = [0]
    best = x @ x[0]
    while len(chosen) < most:
        worst = int(best.argmin())
        if best[worst] >= threshold:
            break
        chosen.append(worst)
        best = np.maximum(best, x @ x[worst])
    return x[chosen]


def embedding_links(
    vectors: DataFrame,
    key: str = "vec_id",
    embedding: str = "embedding",
    threshold: float = 0.9,
    most_pivots: int = 256,
    sample: int = 4096,
    tile: int = 8192,
) -> DataFrame:
    """``key``, ``n_links``, ``component_id`` and ``kept`` for every row.

    Rows link if the cosine of their vectors is at least ``threshold``. Vectors that are null, empty or zero,
    or hold a null or non-finite number, link with nothing; vectors of different dimensions do not link.
    Rows with the same numbers are one vector with a count, so groups of copies make no pairs.

    Vectors lie in the cell of the nearest pivot; pivots come from a sample of at most ``sample`` vectors and
    decide only where work is done. A vector x with pivot p visits the cell of pivot c unless
    x.(p - c) > |p - c| sqrt(2 - 2 threshold), which proves that nothing in c's cell links with x. Each cell is
    cut into tiles of about ``tile`` vectors, visitors too; each pair of a visitor tile and a home tile is one
    group, and sends a count a vector and one link a linked vector, not its pairs. There are two pivots a tile,
    ``most_pivots`` at most. Where the vectors have no clusters every vector visits every cell, and the work is
    that of all pairs of tiles.

    Null keys take part; ``component_id`` is the smallest key reachable, itself included (null if none), and
    ``kept`` tells whether the row carries it. Repeated rows stay. No rows give no rows; further columns are
    left out.
    """
    v = F.col(embedding)
    sound = F.coalesce(
        (F.size(v) > 0)
        & F.forall(v, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf")))
        & F.exists(v, lambda e: e != 0),
        F.lit(False),
    )
    named = vectors.select(F.col(key), F.when(sound, v).alias("vector"))
    # zero has one sign, so that equal vectors have equal bytes
    named = named.withColumn("vector", F.transform("vector", lambda e: F.when(e == 0, F.abs(e)).otherwise(e)))
    distinct = named.where("vector is not null").groupBy("vector").agg(F.min(key).alias("lowest"), F.count(F.lit(1)).alias("copies"))
    nodes = staged(distinct.withColumn("node", F.monotonically_increasing_id()).withColumn("size", F.size("vector")))

    found = None
    for (size,) in nodes.select("size").distinct().orderBy("size").collect():  # dimensions, of which there are few
        own = nodes.where(F.col("size") == size)
        part = _links_of_size(own, size, threshold, most_pivots, sample, tile)
        found = part if found is None else found.unionByName(part)
    if found is None:
        return named.select(
            key, F.lit(0).cast("long").alias("n_links"), F.col(key).alias("component_id"), F.col(key).eqNullSafe(F.col(key)).alias("kept")
        )
    found = staged(found)
    counts = found.where("n > 0").groupBy(F.col("a").alias("node")).agg(F.sum("n").alias("others"))
    parts = components(found.where("b is not null").select("a", "b"))
    placed = (
        nodes.select("node", "lowest", "copies", "vector")
        .join(counts, "node", "left")
        .join(parts, "node", "left")
        .withColumn("component", F.coalesce("component", "node"))
    )
    lowest = placed.groupBy("component").agg(F.min("lowest").alias("component_id"))
    # the count of a vector has its own copies, of which a row is one
    placed = placed.join(lowest, "component").select("vector", (F.coalesce("others", "copies") - 1).alias("n_links"), "component_id")
    out = named.join(placed, "vector", "left")
    component = F.when(F.col("vector").isNull(), F.col(key)).otherwise(F.col("component_id"))
    return out.select(
        key,
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.col(key).eqNullSafe(component).alias("kept"),
    )


def _links_of_size(own: DataFrame, size: int, threshold: float, most: int, sample: int, tile: int) -> DataFrame:
    spark = own.sparkSession
    n = own.count()
    drawn = own.select("vector")
    if n > sample:  # every so many-th vector by hash
        chosen = F.pmod(F.xxhash64("vector"), F.lit(-(-n // sample))) == 0
        drawn = drawn.where(chosen).limit(2 * sample).unionByName(drawn.limit(1))
    pivots = choose_pivots(_unit(drawn.toArrow().column("vector").combine_chunks()), threshold, min(most, 2 * -(-n // tile)))
    shared = spark.sparkContext.broadcast(pivots)  # at most ``most`` vectors
    reach = float(np.sqrt(max(0.0, 2 - 2 * threshold))) + 1e-9

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = shared.value
        gap = np.sqrt(np.maximum(0, 2 - 2 * p @ p.T))
        for batch in batches:
            if not batch.num_rows:
                continue
            near = _unit(batch.column("vector")) @ p.T
            home = near.argmax(axis=1)
            rows = np.arange(len(home))
            visits = near[rows, home][:, None] - near <= gap[home] * reach + 1e-9
            visits[rows, home] = True
            i, cell = np.nonzero(visits)
            yield pa.RecordBatch.from_arrays(
                [batch.column("node").take(pa.array(i)), pa.array(cell, pa.int32()), pa.array(cell == home[i])],
                ["node", "cell", "home"],
            )

    seats = staged(own.select("node", "vector").mapInArrow(place, "node long, cell int, home boolean"))
    sizes = seats.groupBy("cell").agg(
        F.ceil(F.sum(F.col("home").cast("long")) / tile).alias("homes"), F.ceil(F.count(F.lit(1)) / tile).alias("guests")
    )
    # a row for each pivot at most
    seats = seats.join(F.broadcast(sizes.where("homes > 0")), "cell")
    split = F.xxhash64("node")

    def each(count: str) -> Column:
        return F.explode(F.sequence(F.lit(0).cast("long"), F.col(count) - 1))

    guest, host = F.pmod(split, "guests").alias("guest"), F.pmod(split, "homes").alias("host")
    guests = seats.select("cell", "node", F.lit(False).alias("home"), guest, each("homes").alias("host"))
    hosts = seats.where("home").select("cell", "node", F.lit(True).alias("home"), each("guests").alias("guest"), host)
    members = guests.unionByName(hosts).join(own.select("node", "vector", "copies"), "node")

    def search(group: pa.Table) -> pa.Table:
        home = group.column("home").to_numpy()
        node, copies = group.column("node").to_numpy(), group.column("copies").to_numpy()
        x = _unit(group.column("vector").combine_chunks())
        h, g = np.flatnonzero(home), np.flatnonzero(~home)
        labels = np.arange(len(node))
        counts = np.zeros(len(node), np.int64)
        for s in range(0, len(g), 256):
            block = g[s : s + 256]
            if not len(h):
                break
            i, j = tile_links(x[block], x[h], threshold)
            i, j = block[i], h[j]
            counts += np.bincount(i, copies[j], len(node)).astype(np.int64)
            labels = smallest_labels(len(node), i, j, labels)
        moved = labels != np.arange(len(node))
        sends = moved | (counts > 0)
        return pa.table(
            {
                "a": node[sends],
                "b": pa.array(node[labels[sends]], mask=~moved[sends]),
                "n": counts[sends],
            }
        )

    keys = ["cell", "guest", "host"]
    return members.groupBy(*keys).applyInArrow(search, "a long, b long, n long")
