"""Isolation forest: trees are grown on small hash samples, one group per tree, and scored everywhere."""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.quantiles import exact_quantiles
from ..sources.staging import staged

_NODE = "tree int, node int, feature int, split double, left int, right int, size int"
_BITS = 1 << 30


def _path(n: np.ndarray) -> np.ndarray:
    """Mean depth of an unsuccessful search among n points."""
    n = np.asarray(n, dtype=float)
    big = np.maximum(n, 3.0)
    long = 2.0 * (np.log(big - 1.0) + np.euler_gamma) - 2.0 * (big - 1.0) / big
    return np.where(n <= 1, 0.0, np.where(n == 2, 1.0, long))


def _grow(x: np.ndarray, rng: np.random.Generator, limit: int) -> list[tuple]:
    """Nodes of one tree: random feature, random split, until alone or ``limit`` deep."""
    nodes: list[list] = []
    todo = [(np.arange(len(x)), 0, -1, 0)]
    while todo:
        rows, depth, parent, side = todo.pop()
        me = len(nodes)
        nodes.append([me, -1, 0.0, -1, -1, len(rows)])
        if parent >= 0:
            nodes[parent][side] = me
        lo, hi = x[rows].min(axis=0), x[rows].max(axis=0)
        open_cols = np.flatnonzero(hi > lo)
        if depth >= limit or len(rows) < 2 or not len(open_cols):
            continue
        f = int(rng.choice(open_cols))
        cut = float(rng.uniform(lo[f], hi[f]))
        low = x[rows, f] <= cut
        if low.all() or not low.any():
            continue
        nodes[me][1], nodes[me][2] = f, cut
        todo.append((rows[~low], depth + 1, me, 4))
        todo.append((rows[low], depth + 1, me, 3))
    return [tuple(n) for n in nodes]


@dataclass(frozen=True)
class Forest:
    """Node arrays of all trees; at most n_trees * (2 * sample - 1) nodes, whatever the table size."""

    cols: tuple[str, ...]
    trees: tuple[np.ndarray, ...]
    sample: int


def _rate(trees: Sequence[np.ndarray], sample: int, x: np.ndarray) -> np.ndarray:
    """Anomaly score of each row of ``x``: all rows walk down one tree after the other."""
    total = np.zeros(len(x))
    at = np.arange(len(x))
    for t in trees:
        node = np.zeros(len(x), dtype=int)
        depth = np.zeros(len(x))
        while True:
            f = t["feature"][node]
            inner = f >= 0
            if not inner.any():
                break
            go = x[at, np.maximum(f, 0)] <= t["split"][node]
            node = np.where(inner, np.where(go, t["left"][node], t["right"][node]), node)
            depth += inner
        total += depth + _path(t["size"][node])
    return np.exp2(-total / len(trees) / max(float(_path(np.array(sample))), 1e-12))


# Tasks get the helpers above together with the function that calls them, so that the workers do not
# need this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def fit_forest(
    df: DataFrame,
    cols: Sequence[str],
    ids: Sequence[str],
    n_trees: int = 100,
    sample: int = 256,
    seed: int = 42,
) -> Forest:
    """Grow the trees. ``ids`` identify a row; they decide by hash which trees see it."""
    cols = list(cols)
    filled = df.select(*ids, *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in cols])
    n = filled.count()
    size = min(sample, n)

    id_cols = [F.col(c) for c in ids]
    rank = F.xxhash64(F.lit(seed), F.col("tree"), *id_cols)
    # each tree is offered half as many rows again as it needs, chosen by hash; small tables are offered whole
    share = min(1.0, 1.5 * size / max(n, 1))

    def offered_to(tree: Column) -> Column:
        return F.pmod(F.xxhash64(F.lit(seed + 1), tree, *id_cols), F.lit(_BITS)) < int(_BITS * share)

    trees_of = F.filter(F.sequence(F.lit(0), F.lit(n_trees - 1)), offered_to)
    offered = filled.withColumn("tree", F.explode(trees_of))
    place = Window.partitionBy("tree").orderBy(rank, *ids)
    per_tree = (
        offered.withColumn("_rn", F.row_number().over(place)).where(F.col("_rn") <= size).select("tree", "_rn", *cols)
    )
    limit = int(np.ceil(np.log2(max(size, 2))))

    def grow(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("_rn")
        tree = int(group["tree"].iloc[0])
        nodes = _grow(group[cols].to_numpy(float), np.random.default_rng((seed, tree)), limit)
        return pd.DataFrame(
            [(tree, *n) for n in nodes], columns=["tree", "node", "feature", "split", "left", "right", "size"]
        )

    nodes = per_tree.groupBy("tree").applyInPandas(grow, _NODE).toPandas().sort_values(["tree", "node"])
    trees = tuple(
        g[["feature", "split", "left", "right", "size"]].to_records(index=False) for _, g in nodes.groupby("tree")
    )
    return Forest(tuple(cols), trees, size)


def score_forest(df: DataFrame, forest: Forest, out: str = "anomaly_score") -> DataFrame:
    """Anomaly score in (0, 1] per row, in Arrow batches."""
    shipped = df.sparkSession.sparkContext.broadcast((forest.trees, forest.sample))

    @F.pandas_udf("double")
    def rate(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        trees, sample = shipped.value
        for series in batches:
            x = np.column_stack([s.to_numpy(float) for s in series])
            yield pd.Series(_rate(trees, sample, x))

    inputs = [F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in forest.cols]
    return df.withColumn(out, rate(*inputs))


def isolation_forest(
    df: DataFrame,
    cols: Sequence[str],
    ids: Sequence[str],
    n_trees: int = 100,
    sample: int = 256,
    contamination: float = 0.05,
    seed: int = 42,
    flag: str = "is_anomalous",
    stage: Callable[[DataFrame], DataFrame] = staged,
) -> DataFrame:
    """-1 for the ``contamination`` share of rows with the highest anomaly score, 1 for the others.

    The cut-off needs the scores of all rows before the first flag can be given, so the scored frame goes
    through ``stage`` (a written table by default) and is not scored again.
    """
    scored = stage(score_forest(df, fit_forest(df, cols, ids, n_trees, sample, seed)))
    (cut,) = exact_quantiles(scored, ["anomaly_score"], [1 - contamination])["anomaly_score"]
    return scored.withColumn(flag, F.when(F.col("anomaly_score") > F.lit(cut), -1).otherwise(1))
