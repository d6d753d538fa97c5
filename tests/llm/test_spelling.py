"""Near words, forms and roots against all pairs."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import pytest

from seriesloom.llm.queries import QUERIES
from seriesloom.llm.spelling import near_in_shard, near_words, spelling_forms, vocabulary


def _near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def _pairs(words):
    """All near pairs; words that lose one code point alike, or differ in one, share a pattern."""
    pattern: dict[str, list[str]] = {}
    for w in words:
        for p in {w[:i] + "\0" + w[i + 1 :] for i in range(len(w))} | {w[:i] + "\0" + w[i:] for i in range(len(w) + 1)}:
            pattern.setdefault(p, []).append(w)
    return {(a, b) for g in pattern.values() for a in g for b in g if a != b and _near(a, b)}


def _forms(counts):
    near = {w: set() for w in counts}
    for a, b in _pairs(counts):
        near[a].add(b)
    form = {}
    for w, n in counts.items():
        best = min(near[w], key=lambda x: (-counts[x], x), default=None)
        form[w] = best if best is not None and counts[best] >= 2 * n else None
    out = set()
    for w, n in counts.items():
        root = w
        while form[root]:
            root = form[root]
        out.add((w, form[w], root, n, len(near[w]), counts.get(form[w])))
    return out


@pytest.mark.parametrize("letters", ["ab", "abcé", "aÿ🙂"])
@pytest.mark.parametrize("least", [1, 5])
def test_all_pairs_in_a_shard(letters, least):
    rng = random.Random(len(letters) + least)
    words = list({"".join(rng.choices(letters, k=rng.randint(least, 9))) for _ in range(300)})
    assert set(_pairs(words)) == {(a, b) for a in words for b in words if a != b and _near(a, b)}
    got = set()
    for side in (0, 1):
        got |= {(words[i], words[j]) for i, j in zip(*near_in_shard(words, words, side))}
    assert got == _pairs(words)


@pytest.mark.parametrize("shard", [20_000, 40])
def test_hot_halves(spark, shard):
    """With shards of 40 words, halves that a third of the words share are split."""
    rng = random.Random(5)
    words = {"".join(rng.choices("abc", k=rng.randint(5, 8))) for _ in range(300)}
    words |= {"prefix" + "".join(rng.choices("abc", k=5)) for _ in range(200)}
    counts = {w: rng.randint(3, 60) for w in words}
    table = spark.createDataFrame(list(counts.items()), "word string, n long")
    near = near_words(table, shard=shard).collect()
    assert {(r.word, r.near) for r in near} == _pairs(words) and len(near) == len(_pairs(words))
    assert {tuple(r) for r in spelling_forms(table, shard=shard).collect()} == _forms(counts)


def test_long_words_and_nulls(spark):
    long = "ab" * 4000
    rows = [(long, 3), (long + "c", 9), (long[:-1] + "x", 4), (None, 5), ("other", 3)]
    got = {r.word: r for r in spelling_forms(spark.createDataFrame(rows, "word string, n long")).collect()}
    assert set(got) == {long, long + "c", long[:-1] + "x", "other"}
    assert got[long].form == long + "c" and got[long].n_near == 2 and got["other"].n_near == 0
    assert got["other"].form is None and got["other"].root == "other" and got["other"].form_n is None


def test_ties_and_chains(spark):
    counts = {"aaaaa": 1, "aaaab": 2, "aaabb": 4, "aabbb": 8, "aaaac": 2, "zzzzz": 7}
    got = {tuple(r) for r in spelling_forms(spark.createDataFrame(list(counts.items()), "word string, n long")).collect()}
    assert got == _forms(counts)
    assert ("aaaaa", "aaaab", "aabbb", 1, 2, 2) in got


def _counted(rows, least=5):
    counts = Counter()
    for key, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            w = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{'' if key is None else key}:{w}".encode())
            if h % 97 == 0:
                w = w[: h % len(w)] + w[h % len(w) + 1 :]
            if len(w) >= least:
                counts[w] += 1
    return counts


def test_vocabulary(odd, none, spark):
    rows = [(r.doc_id, r.text) for r in odd.select("doc_id", "text").collect()]
    assert {r.word: r.n for r in vocabulary(odd).collect()} == _counted(rows)
    assert vocabulary(none).collect() == [] and spelling_forms(vocabulary(none)).collect() == []
    rows = [(1, "ÀÉÎ Àéîou ÀÉÎOU x×÷yz Straße STRASSE İstanbul")]
    assert {r.word: r.n for r in vocabulary(spark.createDataFrame(rows, "doc_id long, text string")).collect()} == _counted(rows)


def test_query(spark, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    counts = {w: n for w, n in _counted(rows).items() if n >= 3}
    found = QUERIES["op12_spelling_variants"](spark, sf)
    assert found.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert {tuple(r) for r in found.collect()} == _forms(counts)
