"""Every stage on its own input, and the whole run."""

from __future__ import annotations

import random

import corpus_pipeline
from seriesloom.llm.line_dedup import line_dedup
from pyspark.sql import functions as F
from seriesloom.llm.quality_bands import fit_limits, quality_bands
from test_packing import _check
from test_shingle_groups import _want


def test_stages(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    names, stages = zip(*corpus_pipeline.STAGES)
    assert names == ("quality rules", "line dedup", "simhash near-dedup", "packing")
    one = corpus_pipeline.staged(stages[0](spark, docs, sf))
    assert one.columns == docs.columns
    good = spark.read.parquet(f"{sf}/labels.parquet").where("quality = 1")
    kept = {r.doc_id for r in quality_bands(docs, limits=fit_limits(docs, good)).where("kept").collect()}
    assert {r.doc_id for r in one.collect()} == kept

    two = corpus_pipeline.staged(stages[1](spark, one, sf))
    assert two.columns == docs.columns
    cut = {r.doc_id: (r.text, r.n_removed) for r in line_dedup(one).collect()}
    want = {k: t for k, (t, n) in cut.items() if not n or t.split()}
    assert {r.doc_id: r.text for r in two.collect()} == want
    assert all(r.n_chars == len(r.text) for r in two.collect() if cut[r.doc_id][1])

    three = corpus_pipeline.staged(stages[2](spark, two, sf))
    assert three.columns == docs.columns
    first = set(_want([(r.doc_id, r.text) for r in two.collect()]).values())
    assert sorted(r.doc_id for r in three.collect()) == sorted(first)

    _check(three.collect(), stages[3](spark, three, sf).collect())
    tokens = sum(r.length for r in corpus_pipeline.run(spark, sf).collect())
    assert tokens == sum(r.length for r in stages[3](spark, three, sf).collect())


def test_clean_documents_stay(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    good = docs.join(labels.where("quality = 1"), "doc_id").where("size(split(text, ' ')) >= 15")
    left = corpus_pipeline.quality_rules(spark, good.select(*docs.columns), sf).count()
    assert left >= 0.99 * good.count()


def test_odd_rows(spark, odd):
    docs = odd
    for _, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.staged(stage(spark, docs, ""))
    assert docs.count() > 0


def test_one_row_of_each_group_stays(spark):
    rng = random.Random(3)
    one, two, three = (" ".join("".join(rng.choices("abcdefgh", k=6)) for _ in range(60)) for _ in range(3))
    rows = [(None, one), (4, two), (4, two), (None, two), (7, three), (4, three), (None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    left = [(r.doc_id, r.text) for r in corpus_pipeline.simhash_near_dedup(spark, docs, "").collect()]
    assert sorted(left, key=str) == sorted([(None, one), (4, two), (4, three), (None, None)], key=str)


def test_other_columns_come_back_as_they_are(spark, sf):
    names = "ratio kept n_words odd_share n_lines n_removed _key _gone _hash _lines _row row rest key hash class order Text_".split()
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    wide = docs.select("*", *[F.concat(F.lit(f"{c} of "), "doc_id").alias(c) for c in names])
    for _, stage in corpus_pipeline.STAGES[:-1]:
        wide = corpus_pipeline.staged(stage(spark, wide, sf))
        assert wide.columns == [*docs.columns, *names]
        assert not wide.where(" or ".join(f"`{c}` <> concat('{c} of ', doc_id)" for c in names)).count()
    assert wide.count() == corpus_pipeline.STAGES[-1][1](spark, wide, sf).select("doc_id").distinct().count()


def test_simhash_links_and_shingle_links_lead_on_to_each_other(spark):
    rng = random.Random(4)
    one, two, three = (" ".join("".join(rng.choices("bcdefgh", k=6)) for _ in range(30)) for _ in range(3))
    # 1 and 2 have the fingerprint of the repeated word, 2 and 4 the same set of shingles
    rows = [(1, "a " * 100 + one), (2, "a " * 100 + two), (3, three), (4, "a " * 10 + two)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(r.doc_id for r in corpus_pipeline.simhash_near_dedup(spark, docs, "").collect()) == [1, 3]
