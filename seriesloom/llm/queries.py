"""The operators of this package as registered queries over the given tables."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from ..catalog.base import Query, table
from . import byte_bpe
from .alignment import alignment_scores
from .bpe import encode_decode_digests
from .embedding_pairs import embedding_links
from .html_text import fit, main_text
from .line_dedup import line_dedup
from .packing import pack
from .pitman_yor import lm_scores
from .quality_bands import fit_limits, quality_bands
from .sharding import shuffled_shards
from .simhash_gray import simhash_groups
from .spelling import spelling_forms, vocabulary
from .token_counts import SPLIT, token_counts

#: Where the vocabulary files of public tokenizers are.
TOKENIZERS = os.environ.get("TOKENIZER_DIR", "/opt/tokenizers")
WORDS, BYTES = f"{TOKENIZERS}/word_bpe_49k.json", f"{TOKENIZERS}/byte_bpe_50k.tiktoken"
MULTI = f"{TOKENIZERS}/byte_bpe_multi_50k.tiktoken"
SIDE_A, SIDE_B = f"{TOKENIZERS}/byte_bpe_50k.json", f"{TOKENIZERS}/piece_bpe_32k.model"

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


#: What SQL can express: vectors by pairs in double precision, components as the smallest id within reach.
ORACLE["op1_embedding_near_dedup"] = """
with recursive sound as materialized (
  select vec_id, e from (select vec_id, cast(embedding as double[]) as e from embeddings)
  where len(list_filter(e, lambda x: x is null or not isfinite(x))) = 0 and len(list_filter(e, lambda x: x <> 0)) > 0
), vectors as materialized (
  select vec_id, list_transform(e, lambda x: x / sqrt(list_dot_product(e, e))) as e from sound
), links as materialized (
  select a.vec_id as x, b.vec_id as y from vectors a join vectors b
    on a.vec_id <> b.vec_id and case when len(a.e) = len(b.e) then list_dot_product(a.e, b.e) end >= 0.9
), reach(v, r) as (
  select vec_id, vec_id from embeddings union select r.v, l.y from reach r join links l on r.r = l.x
), lowest as (select v, min(r) as component_id from reach group by v),
degrees as (select x, count(*) as n from links group by x)
select e.vec_id, coalesce(n, 0) as n_links, component_id, e.vec_id = component_id as kept
from embeddings e join lowest on v = e.vec_id left join degrees on x = e.vec_id
"""


def _query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


@_query
def op1_embedding_near_dedup(spark, sf):
    return embedding_links(table(spark, sf, "embeddings"))


@_query
def op2_lm_scoring(spark, sf):
    return lm_scores(table(spark, sf, "documents"))


@_query
def op3_line_dedup(spark, sf):
    return line_dedup(table(spark, sf, "documents").select("doc_id", "text"))


@_query
def op4_simhash_near_dedup(spark, sf):
    return simhash_groups(table(spark, sf, "documents"))


@_query
def op5_html_extraction(spark, sf):
    pages = table(spark, sf, "pages").select("page_id", "url", "html")
    found = main_text(pages, fit(pages))
    return found.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))


@_query
def op6_bpe(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return encode_decode_digests(docs, WORDS).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


@_query
def op7_sharding(spark, sf):
    docs = table(spark, sf, "documents")
    text = F.coalesce("text", F.lit(""))
    return shuffled_shards(docs.select("doc_id", "text")).select(
        "doc_id",
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@_query
def op8_packing(spark, sf):
    docs = table(spark, sf, "documents")
    ids_crc32 = F.crc32("ids").alias("ids_crc32")
    return pack(docs, WORDS).select("doc_id", "start", "length", ids_crc32, "doc_tokens", "sequence_id", "offset")


@_query
def op9_token_counts(spark, sf):
    return token_counts(table(spark, sf, "documents"), BYTES, fields=("source", "lang", "text"))


@_query
def op10_quality_rules(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    limits = fit_limits(docs, table(spark, sf, "labels").where("quality = 1"))
    return quality_bands(docs, limits=limits).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "ratio", "odd_share"
    )


@_query
def op11_cross_tokenizer_alignment(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return alignment_scores(docs, SIDE_A, SIDE_B)


@_query
def op12_spelling_variants(spark, sf):
    words = vocabulary(table(spark, sf, "documents")).where("n >= 3")
    return spelling_forms(words)


@_query
def op13_byte_bpe(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return byte_bpe.encode_decode_digests(docs, MULTI, SPLIT)
