"""Fingerprints and groups against brute force; the index on codes that are near, far and crowded."""

from __future__ import annotations

import re

import numpy as np
import pytest
import xxhash

from seriesloom.llm.components import components
from seriesloom.llm.simhash_gray import fingerprint_links, gray_rank, linked_labels, simhash_groups, upper_masks
from seriesloom.llm.unions import smallest_labels


def _fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def _brute(codes, distance):
    codes = np.asarray(codes, np.uint64)
    a, b = np.nonzero(np.triu(np.bitwise_count(codes[:, None] ^ codes[None, :]) <= distance, 1))
    return smallest_labels(len(codes), a, b)


def _codes(n, seed):
    rng = np.random.default_rng(seed)
    far = rng.integers(0, 1 << 63, n // 2, dtype=np.uint64)
    crowd = np.full(n // 2, 0xDEADBEEFCAFE, np.uint64)
    for _ in range(5):
        crowd ^= np.uint64(1) << rng.integers(0, 64, n // 2, dtype=np.uint64)
    return np.unique(np.concatenate([far, far[: n // 8] ^ np.uint64(0b1011), crowd]))


def test_gray_rank():
    codes = np.arange(64, dtype=np.uint64)
    gray = codes ^ (codes >> np.uint64(1))
    assert (gray_rank(gray) == codes).all()


@pytest.mark.parametrize("n", [2, 60, 300, 3000])
def test_index(n):
    codes = _codes(n, n)
    assert (linked_labels(codes, 4) == _brute(codes, 4)).all()
    assert (linked_labels(codes, 4, leaf=8, fan=4) == _brute(codes, 4)).all()


def test_masks_share_bits():
    rng = np.random.default_rng(3)
    for distinct in (10, 10**8, 10**12):
        masks = np.array(upper_masks(distinct, 4, 4096), np.int64).view(np.uint64)
        for _ in range(200):
            flips = np.uint64(sum(1 << int(b) for b in rng.choice(64, 4, replace=False)))
            assert ((masks & flips) == 0).any()


@pytest.mark.parametrize("tile", [8192, 40])
def test_links_with_and_without_runs(spark, tile):
    codes = _codes(600, 9)
    df = spark.createDataFrame([(int(c),) for c in codes.view(np.int64)], "code long")
    parts = {r.node: r.component for r in components(fingerprint_links(df, 4, tile=tile)).collect()}
    signed = codes.view(np.int64)
    want = {}
    for c, label in zip(signed.tolist(), _brute(codes, 4).tolist()):
        want.setdefault(label, set()).add(c)
    got = {}
    for c in signed.tolist():
        got.setdefault(parts.get(c, c), set()).add(c)
    assert sorted(map(sorted, want.values())) == sorted(map(sorted, got.values()))


def test_groups(odd, none):
    got = simhash_groups(odd).collect()
    assert len(got) == odd.count() and simhash_groups(none).count() == 0
    texts = {}
    for r in odd.collect():
        texts.setdefault(r.doc_id, set()).add(r.text)
    for r in got:
        assert r.fingerprint in {f"{_fingerprint(t):016x}" for t in texts[r.doc_id]}
    by = {}
    for r in got:
        by.setdefault(r.fingerprint, set()).add(r.component_id)
    assert all(len(x) == 1 for x in by.values())
    zero = [r for r in got if r.fingerprint == "0" * 16]
    assert {r.doc_id for r in zero} == {2, 3, 4} and {r.component_id for r in zero} == {2}
    assert {r.component_id for r in got if r.doc_id in (6, 7)} == {6}


def test_given_documents(spark, sf):
    from seriesloom.llm.queries import QUERIES

    got = QUERIES["op4_simhash_near_dedup"](spark, sf).orderBy("doc_id").collect()
    docs = spark.read.parquet(f"{sf}/documents.parquet").orderBy("doc_id").collect()
    codes = [_fingerprint(r.text) for r in docs]
    assert [r.fingerprint for r in got] == [f"{c:016x}" for c in codes]
    labels = _brute(codes, 4)
    assert [r.component_id for r in got] == [docs[i].doc_id for i in labels]
