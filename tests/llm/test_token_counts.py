from __future__ import annotations

import base64
import random

import numpy as np
import pytest
import tiktoken

from seriesloom.llm.queries import BYTES
from seriesloom.llm.token_counts import SPLIT, allocate, token_counts

with open(BYTES, "rb") as f:
    RANKS = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
LIBRARY = tiktoken.Encoding("own", pat_str=SPLIT, mergeable_ranks=RANKS, special_tokens={})


def _loop(ends, bounds, rule):
    own = [0] * len(bounds)
    start = 0
    for e in ends:
        share = [max(0, min(e, b) - max(start, a)) for a, b in zip([0, *bounds[:-1]], bounds)]
        if rule == "most":
            own[share.index(max(share))] += 1
        else:
            held = [i for i, s in enumerate(share) if s]
            own[held[0 if rule == "first" else -1]] += 1
        start = e
    return own


@pytest.mark.parametrize("rule", ["most", "first", "last"])
def test_allocation(rule):
    rng = random.Random(1)
    for _ in range(300):
        n = rng.randint(1, 60)
        ends = np.array(sorted({*rng.sample(range(1, n + 1), rng.randint(0, n)), n}))
        bounds = np.array(sorted([*rng.choices(range(n + 1), k=rng.randint(0, 8)), n]))
        own, _ = allocate(ends, bounds, rule)
        assert own.tolist() == _loop(ends.tolist(), bounds.tolist(), rule)
    assert allocate(np.array([], np.int64), np.array([0]), rule)[0].tolist() == [0]


def test_crossing_tokens(spark):
    df = spark.createDataFrame([(1, "a\n\n\n\nb", "x")], "doc_id long, text string, field string")
    rows = token_counts(df, BYTES, fields=("text",)).orderBy("section").collect()
    assert sum(r.n_tokens for r in rows) == rows[0].doc_tokens == len(LIBRARY.encode_ordinary("a\n\n\n\nb"))
    assert sum(r.n_shared for r in rows) >= 1


def test_sections(odd, none):
    assert token_counts(none, BYTES).count() == 0
    rows = token_counts(odd.where("doc_id is not null and doc_id <> 5"), BYTES).collect()
    texts = {r.doc_id: r.text or "" for r in odd.collect()}
    found = {}
    for r in rows:
        found.setdefault(r.doc_id, []).append(r)
    assert set(found) == {k for k in texts if k not in (None, 5)}
    for k, own in found.items():
        own.sort(key=lambda r: r.section)
        text = texts[k]
        ids = LIBRARY.encode_ordinary(text)
        assert "".join(text[r.start : r.start + r.n_chars] for r in own) == text
        assert sum(r.n_tokens for r in own) == len(ids) == own[0].doc_tokens
        if len(ids) < 1000:
            bounds = np.cumsum([len(text[r.start : r.start + r.n_chars].encode()) for r in own]).tolist()
            ends = np.cumsum([len(LIBRARY.decode_single_token_bytes(i)) for i in ids]).tolist()
            assert [r.n_tokens for r in own] == (_loop(ends, bounds, "most") if ids else [0])


def test_fields(spark):
    df = spark.createDataFrame([(1, None, "en", "one\ntwo\n"), (None, "src", "", ""), (None, None, None, None)], "doc_id long, source string, lang string, text string")
    rows = token_counts(df, BYTES, fields=("source", "lang", "text")).collect()
    assert [(r.field, r.section, r.n_chars) for r in rows if r.doc_id == 1] == [("source", 0, 1), ("lang", 0, 3), ("text", 0, 4), ("text", 1, 4)]
    assert len([r for r in rows if r.doc_id is None]) == 6
    with pytest.raises(ValueError):
        token_counts(df, BYTES, rule="other")
