from __future__ import annotations

import random

import numpy as np
from tokenizers import Tokenizer

from seriesloom.llm.packing import cuts, difference, pack, windows
from seriesloom.llm.queries import WORDS

LIBRARY = Tokenizer.from_file(WORDS)


def test_differencing():
    assert sorted(map(sorted, difference([8, 7, 6, 5, 4], 2))) in ([[0, 3], [1, 2, 4]], [[0, 2], [1, 3, 4]])
    rng = random.Random(1)
    for _ in range(200):
        sizes = [rng.randint(1, 500) for _ in range(rng.randint(0, 60))]
        k = rng.randint(1, 12)
        found = difference(sizes, k)
        assert sorted(i for w in found for i in w) == list(range(len(sizes))) and len(found) <= k
        if len(sizes) > 6 * k:
            sums = [sum(sizes[i] for i in w) for w in found]
            assert max(sums) - min(sums) < 60


def test_windows_hold():
    rng = random.Random(2)
    sizes = [rng.randint(1, 512) for _ in range(1500)]
    found = windows(sizes, 2048)
    assert all(sum(sizes[i] for i in w) <= 2048 for w in found)
    assert len(found) <= 1.02 * sum(sizes) / 2048 + 1
    assert len(windows([1500] * 9, 2048)) == 9


def test_cuts():
    for n in (1, 2, 511, 512, 513, 2047, 2048, 2049, 10_000):
        at = 0
        for s, m in cuts(n, 2048, 512):
            assert s == at and 0 < m <= 2048 and (m == 2048 or m <= 512)
            at += m
        assert at == n


def _check(docs, got, capacity=2048):
    texts = {}
    for r in docs:
        texts.setdefault(r.doc_id, []).append(LIBRARY.encode(r.text or "", add_special_tokens=False).ids + [1])
    total = {k: sorted(map(len, v)) for k, v in texts.items()}
    pieces, places = {}, {}
    for r in got:
        ids = np.frombuffer(bytes(r.ids), "<u4").tolist()
        assert len(ids) == r.length > 0
        assert any(x[r.start : r.start + r.length] == ids and len(x) == r.doc_tokens for x in texts[r.doc_id])
        pieces[r.doc_id] = pieces.get(r.doc_id, 0) + r.length
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert pieces == {k: sum(v) for k, v in total.items()}
    for at in places.values():
        end = 0
        for offset, length in sorted(at):
            assert offset == end
            end += length
        assert end <= capacity
    return 1 - sum(pieces.values()) / capacity / max(1, len(places))


def test_given_documents(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    assert _check(docs.collect(), pack(docs, WORDS).collect()) < 0.04
    _check(docs.collect(), pack(docs, WORDS, group=5000, capacity=256, piece=100).collect(), 256)


def test_odd_rows(odd, none):
    _check(odd.collect(), pack(odd, WORDS).collect())
    assert pack(none, WORDS).count() == 0


def test_words_are_those_of_the_library():
    from seriesloom.llm.packing import _Ids

    with open(WORDS, encoding="utf-8") as f:
        encode = _Ids(f.read(), most=2000)
    rng = random.Random(3)
    letters = "the ing of an. tion, er!" * 20 + "éßñÉİΣ'<>|0123" + "日本🙂́̌̇"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 60))) for _ in range(4000)] + ["J̌", "<|endoftext|>.", "İ.", "क़."]
    for i in range(0, len(texts), 500):
        part = texts[i : i + 500]
        for text, ids in zip(part, encode([t.encode() for t in part])):
            assert np.frombuffer(ids, "<u4").tolist() == LIBRARY.encode(text, add_special_tokens=False).ids, repr(text)
