"""Byte-level ids and decoded bytes against tiktoken."""

from __future__ import annotations

import hashlib

import numpy as np
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from seriesloom.llm import byte_bpe
from seriesloom.llm.byte_bpe import Splitter, decode, encode, encode_decode_digests, merge, read_ranks, unlike_characters
from seriesloom.llm.queries import MULTI, QUERIES, SPLIT

RANKS = read_ranks(MULTI)
LIBRARY = tiktoken.Encoding("test", pat_str=SPLIT, mergeable_ranks=RANKS, special_tokens={})
UNLIKE = unlike_characters()
SPLITTER = Splitter(SPLIT, UNLIKE)


def _ids(text):
    return [i for w in SPLITTER(text) for i in merge(w.encode(), RANKS)]


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet=st.characters(exclude_categories=["Cs"])))
def test_any_text(text):
    assert _ids(text) == LIBRARY.encode_ordinary(text)


def test_hard_texts():
    newer = "".join(map(chr, sorted(UNLIKE)))[::97]
    for text in ["a" * 4000, "abab" * 900, "x 's'll  \n\n z", "é" * 300, "<|endoftext|>", "१२ ½ ²", newer, " ".join(newer)]:
        assert _ids(text) == LIBRARY.encode_ordinary(text), text[:40]


def test_long_words_like_short_ones():
    word = ("the quick brown fox " * 9).replace(" ", "").encode()
    assert len(word) > 100 and merge(word, RANKS) == LIBRARY.encode_ordinary(word.decode())


def test_ids_and_bytes_of_rows(odd):
    rows = [r.asDict() for r in odd.collect()]
    encoded = encode(odd, MULTI, SPLIT, out="ids")
    got = encoded.collect()
    assert encoded.columns == [c for c in odd.columns if c not in ("text", "ids")] + ["ids"]
    place = {r["place"]: r["text"] or "" for r in rows}  # repeated keys, but one place a row
    assert {r["place"]: list(r["ids"]) for r in got} == {p: LIBRARY.encode_ordinary(t) for p, t in place.items()}
    assert all(r["kept"] == r["place"] == r["bucket"] for r in got)
    back = decode(encoded, MULTI)
    assert {r["place"]: bytes(r["decoded"]).decode() for r in back.collect()} == place


def test_nothing(none):
    assert encode(none, MULTI, SPLIT).collect() == []
    assert encode_decode_digests(none, MULTI, SPLIT).collect() == []


def test_missing_id_fails(spark):
    import pytest

    with pytest.raises(Exception, match="an id without a token"):
        decode(spark.createDataFrame([([5, 70000],)], "ids array<int>"), MULTI).collect()


def test_query(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in QUERIES["op13_byte_bpe"](spark, sf).collect()}
    for r in docs:
        ids = LIBRARY.encode_ordinary(r.text or "")
        digests = (np.array(ids, "<u4").tobytes(), LIBRARY.decode_bytes(ids))
        assert got[r.doc_id] == (len(ids), *(hashlib.sha256(x).hexdigest() for x in digests))
    assert len(got) == len(docs)


def test_each_distinct_word_is_met_once_and_moves_packed(spark):
    words = [f"w{i:05}" for i in range(5000)]
    docs = spark.createDataFrame([(i, " ".join(words)) for i in range(40)], "doc_id long, text string").repartition(8)
    blocks, found = byte_bpe._looked_up(docs, MULTI, SPLIT, "text")
    assert found.columns == ["block", "part"]
    # rows moved are parts of blocks, not words
    assert found.count() <= 8 * blocks.count()
    got = {tuple(r.ids) for r in encode(docs, MULTI, SPLIT).collect()}
    assert got == {tuple(LIBRARY.encode_ordinary(" ".join(words)))}
