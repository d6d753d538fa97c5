"""From raw documents to packed training sequences, in stages that read and write documents."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from seriesloom.llm.batches import free_name
from seriesloom.llm.components import components
from seriesloom.llm.line_dedup import line_dedup
from seriesloom.llm.packing import pack
from seriesloom.llm.quality_bands import Limits, fit_limits, quality_bands
from seriesloom.llm.shingle_groups import similar_groups
from seriesloom.llm.queries import WORDS
from seriesloom.llm.simhash_gray import simhash_groups
from seriesloom.sources.staging import staged


def labelled_good(spark: SparkSession, sf_dir: str) -> DataFrame | None:
    """Ids that are labelled as good, if there is a table of labels."""
    try:
        return spark.read.parquet(f"{sf_dir}/labels.parquet").where("quality = 1").select("doc_id")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep, as they are; limits are fitted to those labelled as good, if any."""
    good = labelled_good(spark, sf_dir)
    limits = Limits() if good is None else fit_limits(docs, good)
    rest = [c for c in docs.columns if c != "text"]  # the text moves once
    rows = docs.select("text", F.struct(F.lit(0).alias("_"), *[F.col(f"`{c}`") for c in rest]).alias("rest"))
    kept = quality_bands(rows, limits=limits).where("kept")
    return kept.select(*[F.col("rest")[c].alias(c) if c in rest else F.col(c) for c in docs.columns])


def first_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that an earlier document has; those left without a word go. ``n_chars``, if a
    number, follows the text; other columns stay as they are."""
    rest = [c for c in docs.columns if c not in ("doc_id", "text")]
    rows = docs.select("doc_id", "text", F.struct(F.lit(0).alias("_"), *[F.col(f"`{c}`") for c in rest]).alias("rest"))
    words_left = F.col("text").rlike(r"[^\x20\x09-\x0D]")
    cut = line_dedup(rows).where((F.col("n_removed") == 0) | words_left)

    def column(c: str) -> Column:
        if c not in rest:
            return F.col(c)
        own = F.col("rest")[c]
        kind = docs.schema[c].dataType
        if c == "n_chars" and isinstance(kind, NumericType):
            own = F.when(F.col("n_removed") > 0, F.char_length("text").cast(kind)).otherwise(own)
        return own.alias(c)

    return cut.select(*[column(c) for c in docs.columns])


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of every group of near-duplicates: that with the smallest id, nulls last, then by text and row.

    Two texts are near-duplicates if their SimHash fingerprints differ in at most 4 bits (op4), or if their
    five-word shingles have a Jaccard similarity of 0.8 or more: such texts differ in about 10 of 64 bits and in up
    to 18 or 20, a distance at which the Gray index of op4 has nothing left to prune, so these links come from exact
    prefixes of the shingles. Links of both kinds lead on to each other.

    Rows are told apart by a number of their own, so unique rows without an id stay, and of rows that repeat an
    id with near-duplicate texts one stays.
    """
    row = free_name(docs.columns, "_row")
    rows = staged(docs.withColumn(row, F.monotonically_increasing_id()))
    order = F.struct(F.col("doc_id").isNull(), "doc_id", F.xxhash64("text"), row)
    texts = rows.select(row, "text")
    by_bits = simhash_groups(texts, row).select(row, F.col("component_id").alias("a"))
    by_shingles = similar_groups(texts, row).select(row, F.col("component_id").alias("b"))
    both = staged(by_bits.join(by_shingles, row))
    # every group of either kind bears one of its rows; rows tie the two kinds together
    parts = components(both.where("a <> b").select("a", "b").distinct())
    placed = both.join(parts, F.col("node") == F.col("a"), "left").select(row, F.coalesce("component", "a").alias("component_id"))
    first = placed.join(rows.select(row, order.alias("order")), row).groupBy("component_id").agg(F.min("order")[row].alias(row))
    return rows.join(first, row, "left_semi").select(*docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their places in windows of 2048 ids."""
    return pack(docs, WORDS)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality rules", quality_rules),
    ("line dedup", first_lines),
    ("simhash near-dedup", simhash_near_dedup),
    ("packing", packing),
]

#: SQL has neither the compression nor the hashes.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each result but the last is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
