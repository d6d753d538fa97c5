"""Exact Shapley values of tree ensembles along the paths of their trees, in batches of rows."""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .forecast import HorizonModel

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # workers need no installed package


@dataclass(frozen=True)
class Tree:
    """A regression tree as arrays, one entry a node: the feature it splits (-1 in a leaf), rows with a value up to
    ``split`` go to ``left``; ``cover`` is how many training rows reached the node."""

    feature: np.ndarray
    split: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    cover: np.ndarray


def read_trees(model: HorizonModel) -> tuple[list[Tree], list[float]]:
    """The trees of a boosted model and their weights. Splits of the models here are all numeric."""
    trees = []
    for tree in model.model._java_obj.trees():
        nodes: list[list[float]] = []

        def add(node: Any, nodes: list[list[float]] = nodes) -> int:
            at = len(nodes)
            nodes.append([-1, 0.0, -1, -1, node.prediction(), node.impurityStats().count()])
            if node.subtreeDepth():
                split = node.split()
                nodes[at][:2] = split.featureIndex(), split.threshold()
                nodes[at][2] = add(node.leftChild(), nodes)
                nodes[at][3] = add(node.rightChild(), nodes)
            return at

        add(tree.rootNode())
        columns = list(zip(*nodes))
        feature, left, right = (np.array(columns[i], np.int64) for i in (0, 2, 3))
        trees.append(Tree(feature, np.array(columns[1]), left, right, np.array(columns[4]), np.array(columns[5], float)))
    return trees, [float(w) for w in model.model.treeWeights]


def paths(tree: Tree) -> Iterator[tuple[float, list[tuple[int, float, float, float]]]]:
    """For every leaf its value and its path: each feature once, with the bounds that all its splits on the way
    leave (above ``low``, up to ``high``) and the share of the training rows that follow them."""
    todo: list[tuple[int, dict[int, tuple[float, float, float]]]] = [(0, {})]
    while todo:
        node, held = todo.pop()
        f = int(tree.feature[node])
        if f < 0:
            yield float(tree.value[node]), [(k, *v) for k, v in held.items()]
            continue
        low, high, share = held.get(f, (-np.inf, np.inf, 1.0))
        for child, bounds in (
            (int(tree.left[node]), (low, min(high, tree.split[node]))),
            (int(tree.right[node]), (max(low, tree.split[node]), high)),
        ):
            todo.append((child, {**held, f: (*bounds, share * tree.cover[child] / tree.cover[node])}))


def _extend(weights: np.ndarray, share: float, follows: np.ndarray) -> np.ndarray:
    """Weights of the subsets of a path by size, with one feature more: rows that go its way count it as present,
    absent features go both ways by their share."""
    size = weights.shape[0]
    out = np.zeros((size + 1, weights.shape[1]))
    i = np.arange(size)[:, None]
    out[1:] += follows * weights * (i + 1) / (size + 1)
    out[:-1] += share * weights * (size - i) / (size + 1)
    return out


def _unwound(weights: np.ndarray, share: float, follows: np.ndarray) -> np.ndarray:
    """The sum of the weights without one feature of the path, undoing its extension."""
    size = weights.shape[0]
    total, rest = np.zeros(weights.shape[1]), weights[-1].copy()
    for j in range(size - 2, -1, -1):
        present = rest * size / (j + 1)
        absent = weights[j] * size / (share * (size - 1 - j))
        total += np.where(follows, present, absent)
        rest = np.where(follows, weights[j] - present * share * (size - 1 - j) / size, rest)
    return total


def shapley(trees: Sequence[Tree], tree_weights: Sequence[float], x: np.ndarray) -> tuple[float, np.ndarray]:
    """The mean prediction over the training rows, and for each row (of ``x``) and feature what its value adds.

    Exact for the game in which absent features follow both branches in proportion to the training rows: base
    plus the values of a row is its prediction. Time grows with leaves and the square of their depth, where an
    enumeration of subsets doubles with every feature.
    """
    base, out = 0.0, np.zeros(x.shape)
    for tree, weight in zip(trees, tree_weights):
        for value, path in paths(tree):
            value *= weight
            base += value * float(np.prod([share for *_, share in path]))
            follows = [(x[:, f] > low) & (x[:, f] <= high) for f, low, high, _ in path]
            subsets = np.ones((1, len(x)))
            for (*_, share), goes in zip(path, follows):
                subsets = _extend(subsets, share, goes)
            for (f, _, _, share), goes in zip(path, follows):
                out[:, f] += _unwound(subsets, share, goes) * (goes - share) * value
    return base, out


def _vectors(features: Sequence[str], columns: Sequence[str]) -> Column:
    """Feature values in the order of the model; a missing one counts as 0, as in training."""
    have = set(columns)
    return F.array(*[F.coalesce(F.col(c).cast("double"), F.lit(0.0)) if c in have else F.lit(0.0) for c in features])


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def tree_attribution(df: DataFrame, model: HorizonModel, keep: Sequence[str] = ()) -> DataFrame:
    """``keep``, ``base`` and ``effects`` (one number a feature, in the order of the model) for every row.

    The trees are sent once with the task; rows need no shuffle. base + sum of effects is the model's prediction.
    """
    trees, weights = read_trees(model)
    width, kept = len(model.features), list(keep)
    rows = df.select(*kept, _vectors(model.features, df.columns).alias("_x"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column("_x"), width)
            base, found = shapley(trees, weights, x)
            ends = pa.array(np.arange(len(x) + 1, dtype=np.int32) * width)
            arrays = [batch.column(c) for c in kept]
            arrays += [pa.array(np.full(len(x), base)), pa.ListArray.from_arrays(ends, pa.array(found.ravel()))]
            yield pa.RecordBatch.from_arrays(arrays, [*kept, "base", "effects"])

    schema = T.StructType(df.select(*kept).schema.fields)
    return rows.mapInArrow(run, schema.add("base", T.DoubleType()).add("effects", T.ArrayType(T.DoubleType())))


def attribution_summary(df: DataFrame, model: HorizonModel, target: str) -> DataFrame:
    """``feature``, ``n``, ``mean_abs_effect``, ``mean_effect`` and ``direction`` over all rows with a known target.

    ``direction`` is the correlation of a feature's value with its effect: positive if greater values raise the
    prediction; NULL where either is constant. Every batch sends one row of sums a feature.
    """
    trees, weights = read_trees(model)
    names = list(model.features)
    rows = df.where(F.col(target).isNotNull()).select(_vectors(names, df.columns).alias("_x"))
    sums = ("absolute", "effect", "square", "x", "xx", "product")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column("_x"), len(names))
            found = shapley(trees, weights, x)[1]
            parts = (np.abs(found), found, found**2, x, x**2, x * found)
            totals = {s: p.sum(axis=0) for s, p in zip(sums, parts)}
            yield pa.record_batch({"feature": pa.array(names), "n": np.full(len(names), len(x)), **totals})

    partial = rows.mapInArrow(run, "feature string, n long, " + ", ".join(f"{s} double" for s in sums))
    whole = partial.groupBy("feature").agg(F.sum("n").alias("n"), *[F.sum(s).alias(s) for s in sums])
    n, e, x = F.col("n"), F.col("effect"), F.col("x")
    spread = (n * F.col("square") - e * e) * (n * F.col("xx") - x * x)
    related = F.when(spread > 0, (n * F.col("product") - x * e) / F.sqrt(spread))
    return whole.select("feature", "n", (F.col("absolute") / n).alias("mean_abs_effect"), (e / n).alias("mean_effect"), related.alias("direction"))
