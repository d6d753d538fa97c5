"""Ids and decoded texts against the tokenizers library."""

from __future__ import annotations

import hashlib
import random

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from seriesloom.llm.bpe import Encoder, OffsetTable, Vocabulary, decode, decoding_table, encode, encode_decode_digests
from seriesloom.llm.queries import WORDS

LIBRARY = Tokenizer.from_file(WORDS)
with open(WORDS, encoding="utf-8") as f:
    VOCABULARY = Vocabulary(f.read())
ENCODER = Encoder(VOCABULARY, most=5000)


def _same(text):
    assert ENCODER(text).tolist() == LIBRARY.encode(text, add_special_tokens=False).ids, repr(text)


@settings(max_examples=300, deadline=None)
@given(st.text())
def test_any_text(text):
    _same(text)


def test_hard_texts():
    for text in ["a" * 3000, "abab" * 400, "</w> </w></w>", "<|endoftext|>A<|startoftext|>b", "ΑΣ Σ", "İ J̌", "\x1c a\x85b", "don't 12x²", "क़ ﻿"]:
        _same(text)
    rng = random.Random(6)
    letters = "the ing of an tion er" * 20 + "éßñ" + "".join(map(chr, range(33, 127))) + "日本🙂́̇"
    for _ in range(2000):
        _same("".join(rng.choice(letters) for _ in range(rng.randint(1, 50))))


def test_offset_table():
    table = OffsetTable([b"", b"a", b"", b"bcd", b"e"])
    assert table(np.array([3, 0, 1, 3, 2, 4])) == b"bcdabcde" and table(np.array([], np.int64)) == b""
    ids = np.arange(VOCABULARY.n)
    assert decoding_table(VOCABULARY)(ids)[:-1].decode() == LIBRARY.decode(ids.tolist(), skip_special_tokens=False)


def test_columns(odd, none):
    got = decode(encode(odd, WORDS), WORDS).collect()
    assert len(got) == odd.count() and encode(none, WORDS).count() == 0
    for r in got:
        ids = LIBRARY.encode(r.text or "", add_special_tokens=False).ids
        assert np.frombuffer(bytes(r.ids), "<u4").tolist() == ids
        assert r.decoded == LIBRARY.decode(ids, skip_special_tokens=False)


def test_digests(odd, none):
    assert encode_decode_digests(none, WORDS).count() == 0
    for r in encode_decode_digests(odd, WORDS, block=1000).collect():
        ids = LIBRARY.encode(r.text or "", add_special_tokens=False).ids
        plain = LIBRARY.decode(ids, skip_special_tokens=False)
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(plain.encode()).hexdigest()
