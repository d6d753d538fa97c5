"""Two-pass external shuffle of a table into shards, with Spark's own functions only."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .storing import sent_whole, stored


def shuffled_shards(
    df: DataFrame,
    n_shards: int = 16,
    key: str = "doc_id",
    text: str = "text",
    bucket_bytes: int = 8 << 20,
    seed: int = 42,
) -> DataFrame:
    """The input with ``shard`` (0 to ``n_shards`` - 1) and ``slot`` (gapless from 0 in each shard).

    Pass one scatters rows by a seeded hash of ``key`` into buckets of about ``bucket_bytes`` of text. Pass two
    holds one bucket at a time, shuffles it with Fisher-Yates (Spark's ``shuffle``) and deals the rows out in
    bucket order: the row at place p goes to slot p / n of shard p mod n, so row counts differ by at most one.

    A key that repeats, or is null, would fill one bucket; buckets over four times the size are scattered
    further by row number, so no key bounds the size of a task. Rows of a bucket are sorted by hash before the
    shuffle, so the same input files give the same order when a task is repeated. No rows give no rows; null
    texts count one byte; equal rows keep places of their own; columns ``shard`` and ``slot`` are replaced.
    """
    size = (F.coalesce(F.octet_length(F.col(text)), F.lit(0)) + 1).cast("long")
    hashed = F.xxhash64(F.lit(seed), F.col(key))
    total = df.agg(F.sum(size)).first()[0] or 0
    buckets = max(1, math.ceil(total / bucket_bytes))
    bucket = F.pmod(hashed, F.lit(buckets))

    heavy = df.groupBy(bucket.alias("bucket")).agg(F.sum(size).alias("size")).where(F.col("size") > 4 * bucket_bytes)
    parts = heavy.select("bucket", F.ceil(F.col("size") / bucket_bytes).alias("parts"))

    kept = [F.col(f"`{c}`") for c in df.columns if c.lower() not in ("shard", "slot")]
    rows = df.select(
        F.struct(*kept).alias("row"),
        bucket.alias("bucket"),
        F.xxhash64(F.lit(seed + 1), F.col(key)).alias("order"),
        F.monotonically_increasing_id().alias("number"),
    )
    if not parts.isEmpty():
        part = F.pmod(F.xxhash64("number"), F.coalesce("parts", F.lit(1)))
        rows = rows.join(parts, "bucket", "left").withColumn("bucket", F.col("bucket") + buckets * part)
    held = stored(
        rows.repartition(buckets, "bucket")
        .sortWithinPartitions("bucket", "order")
        .groupBy("bucket")
        .agg(F.collect_list("row").alias("rows"))
        .select("bucket", F.size("rows").alias("n"), F.shuffle("rows", seed).alias("rows"))
    )
    # a row for each bucket, which are bytes / bucket_bytes
    first = F.sum("n").over(Window.orderBy("bucket")) - F.col("n")
    places = sent_whole(held.select("bucket", first.alias("first")))
    place = F.col("first") + F.col("i")
    shard = F.pmod(place, F.lit(n_shards))
    return (
        held.join(places, "bucket")
        .select("first", F.posexplode("rows").alias("i", "row"))
        .select("row.*", shard.cast("int").alias("shard"), ((place - shard) / n_shards).cast("long").alias("slot"))
    )


def write_shards(sharded: DataFrame, path: str, tasks: int | None = None) -> None:
    """One folder a shard, its files in slot order; a shard may be written by several tasks."""
    tasks = tasks or int(sharded.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = sharded.repartitionByRange(tasks, "shard", "slot").sortWithinPartitions("shard", "slot")
    placed.write.mode("overwrite").partitionBy("shard").parquet(path)
