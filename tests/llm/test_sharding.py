from __future__ import annotations

from collections import Counter

from pyspark.sql import functions as F

from seriesloom.llm.sharding import shuffled_shards, write_shards
from seriesloom.sources.staging import stage_folder


def _lawful(rows, n):
    slots = {}
    for r in rows:
        slots.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    counts = [len(slots.get(i, [])) for i in range(n)]
    assert set(slots) <= set(range(n)) and max(counts) - min(counts) <= 1


def test_every_row_once(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    got = shuffled_shards(docs, bucket_bytes=20_000).collect()
    _lawful(got, 16)
    assert sorted((r.doc_id, r.text) for r in got) == sorted((r.doc_id, r.text) for r in docs.collect())
    again = shuffled_shards(docs, bucket_bytes=20_000).collect()
    assert sorted(got) == sorted(again)
    other = {r.doc_id: (r.shard, r.slot) for r in shuffled_shards(docs, bucket_bytes=20_000, seed=7).collect()}
    assert sum(other[r.doc_id] == (r.shard, r.slot) for r in got) < len(got) / 10


def test_places_are_spread(spark):
    df = spark.range(4000).select(F.col("id").alias("doc_id"), F.lit("x").alias("text"))
    got = shuffled_shards(df, n_shards=4, bucket_bytes=500).collect()
    _lawful(got, 4)
    quarter = Counter((r.shard, 4 * r.doc_id // 4000) for r in got)
    assert all(180 < quarter[s, q] < 320 for s in range(4) for q in range(4))


def test_repeated_and_null_keys(spark):
    rows = [(5, "same text")] * 700 + [(None, "null key")] * 300 + [(i, None) for i in range(100)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = shuffled_shards(df, n_shards=3, bucket_bytes=400).collect()
    _lawful(got, 3)
    assert Counter((r.doc_id, r.text) for r in got) == Counter(rows)


def test_odd_rows(odd, none):
    got = shuffled_shards(odd)
    _lawful(got.collect(), 16)
    assert got.count() == odd.count() and shuffled_shards(none).count() == 0
    assert [c.lower() for c in got.columns].count("shard") == 1


def test_written_shards(spark):
    df = spark.range(500).select(F.col("id").alias("doc_id"), F.col("id").cast("string").alias("text"))
    path = f"{stage_folder(spark)}/shards-{df.count()}"
    write_shards(shuffled_shards(df, 4), path, tasks=6)
    back = spark.read.parquet(path).collect()
    _lawful(back, 4)
    assert sorted(r.doc_id for r in back) == list(range(500))
