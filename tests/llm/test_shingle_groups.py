"""Groups by shingle similarity against all pairs, and planted edited copies through the pipeline's stage."""

from __future__ import annotations

import random
from pathlib import Path

import corpus_pipeline
import numpy as np
from pyspark.sql import functions as F
from seriesloom.llm.shingle_groups import most_common, shingle_set, similar_groups, sketch


def _want(rows):
    sets = {k: set(shingle_set((t or "").encode()).tolist()) for k, t in rows}
    label = {k: k for k in sets}

    def root(k):
        while label[k] != k:
            k = label[k]
        return k

    for a in sets:
        for b in sets:
            both = len(sets[a] & sets[b])
            if a < b and (sets[a] == sets[b] or 10 * both >= 8 * (len(sets[a]) + len(sets[b]) - both)):
                x, y = sorted((root(a), root(b)))
                label[y] = x
    return {k: root(k) for k in sets}


def _edited(rng, words, n):
    words = list(words)
    for _ in range(n):
        words[rng.randrange(len(words))] = "".join(rng.choices("abcdefgh", k=7))
    return words


def test_against_all_pairs(spark):
    rng = random.Random(4)
    texts = [None, "", " \n ", "a b", "A  b", "a b c d e", "a b c d e f"]
    passage = ["".join(rng.choices("abcdefgh", k=6)) for _ in range(40)]
    for _ in range(12):
        base = ["".join(rng.choices("abcdefgh", k=6)) for _ in range(rng.randrange(8, 150))]
        base += passage if rng.random() < 0.5 else []
        texts += [" ".join(_edited(rng, base, rng.randrange(5))) for _ in range(6)]
    rows = list(enumerate(texts))
    found = similar_groups(spark.createDataFrame(rows, "id long, text string").repartition(3), "id").collect()
    assert {r.id: r.component_id for r in found} == _want(rows) and len(found) == len(rows)
    assert similar_groups(spark.createDataFrame([], "id long, text string"), "id").count() == 0


def test_edited_copies_leave(spark, sf):
    docs = spark.read.parquet(f"{Path(sf).parent}/sf0.01/documents.parquet")
    pairs = [(582, 875), (709, 944), (1, 255), (643, 770)]
    some = docs.where(F.col("doc_id").isin([i for p in pairs for i in p]))
    left = sorted(r.doc_id for r in corpus_pipeline.simhash_near_dedup(spark, some, "").collect())
    assert left == sorted(min(p) for p in pairs)
    rng = random.Random(6)
    base = ["".join(rng.choices("abcdefgh", k=6)) for _ in range(200)]
    rows = [(0, " ".join(base)), *((i, " ".join(_edited(rng, base, 4))) for i in range(1, 9))]
    planted = spark.createDataFrame(rows, "doc_id long, text string")
    assert [r.doc_id for r in corpus_pipeline.simhash_near_dedup(spark, planted, "").collect()] == [0]


def test_sketches_never_understate():
    rng = np.random.default_rng(9)
    for _ in range(400):
        pool = rng.integers(0, 1 << 63, 4000, dtype=np.uint64)
        a = np.unique(rng.choice(pool, int(rng.integers(0, 900))))
        b = np.unique(rng.choice(pool, int(rng.integers(0, 3000)))) if rng.random() < 0.5 else np.unique(np.append(a[3:], pool[:5]))
        both = most_common(sketch(a), sketch(b))
        assert both is not None and both >= len(np.intersect1d(a, b))
    assert most_common(sketch(np.full(300, 7, np.uint64)), sketch(pool)) is None
