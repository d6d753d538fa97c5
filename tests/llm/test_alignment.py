"""Groups, links, counts and digests against plain set operations over both libraries' tokens."""

from __future__ import annotations

import hashlib
from collections import Counter, defaultdict
from itertools import accumulate

import numpy as np
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from seriesloom.llm.alignment import align, alignment_scores, diagonal_groups, group_links
from seriesloom.llm.queries import QUERIES, SIDE_A, SIDE_B


@settings(max_examples=400, deadline=None)
@given(st.sets(st.integers(1, 60), min_size=1), st.sets(st.integers(1, 60)), st.booleans())
def test_groups_end_where_both_end(a, b, same):
    b = (a if same else b) | {max(a)}
    a, b = sorted(a | {max(b)}), sorted(b)
    x, y = diagonal_groups(a, b)
    common = sorted(set(a) & set(b))
    assert [a[i - 1] for i in x] == common == [b[j - 1] for j in y]


def test_wide_groups():
    rng = np.random.default_rng(2)
    a, b = rng.integers(0, 7, 300), rng.integers(0, 5, 260)
    a_ends, b_ends = np.array([1, 201, 300]), np.array([2, 160, 260])  # 1, 31,600 and 9,900 links
    want = Counter()
    for i, j, k, m in ((0, 1, 0, 2), (1, 201, 2, 160), (201, 300, 160, 260)):
        want.update((p << 20 | q) for p in a[i:j].tolist() for q in b[k:m].tolist())
    pairs, links = group_links(a, b, a_ends, b_ends)
    assert dict(zip(pairs.tolist(), links.tolist())) == want


_PLAIN = [*range(33, 127), *range(161, 173), *range(174, 256)]
BYTE = {chr(b): b for b in _PLAIN} | {chr(256 + i): b for i, b in enumerate(x for x in range(256) if x not in _PLAIN)}


def _plain(rows):
    a, b = Tokenizer.from_file(SIDE_A), sentencepiece.SentencePieceProcessor(model_file=SIDE_B)
    a.encode_special_tokens = True
    groups, counts = [], Counter()
    for text in rows:
        whole = (" " + (text or "")).encode()
        ids = a.encode(whole.decode(), add_special_tokens=False).ids, b.encode(text or "")
        pieces = [b.id_to_piece(i) for i in ids[1]]
        parts = (
            [bytes(BYTE[c] for c in a.id_to_token(i)) for i in ids[0]],
            [bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode() for i, p in zip(ids[1], pieces)],
        )
        found = []
        if text and all(b"".join(p) == whole for p in parts):
            ends = [list(accumulate(map(len, p))) for p in parts]
            cuts, j = set(ends[0]) & set(ends[1]), 0
            held: list[list[int]] = [[], []]
            for i, end in zip(ids[0], ends[0]):
                held[0].append(i)
                while end in cuts and (j == 0 or ends[1][j - 1] < end):
                    held[1].append(ids[1][j])
                    j += 1
                if end in cuts:
                    found.append(held)
                    held = [[], []]
        groups.append(found)
        counts.update({(x, y) for g in found for x in g[0] for y in g[1]})
    most = defaultdict(int)
    for (x, _), n in counts.items():
        most[x] = max(most[x], n)
    out = []
    for found in groups:
        links = [(x, y) for g in found for x in g[0] for y in g[1]]
        written = ";".join("|".join(",".join(map(str, side)) for side in g) for g in found)
        sizes = (sum(len(g[s]) for g in found) for s in (0, 1))
        best = sum(counts[x] == most[x[0]] for x in links)
        digest = hashlib.sha256(written.encode()).hexdigest() if found else ""
        out.append((*sizes, len(found), len(links), best, sum(counts[x] for x in links), digest))
    return out


FIGURES = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def test_odd_rows(odd):
    rows = odd.select("place", "text").collect()
    want = dict(zip([r.place for r in rows], _plain([r.text for r in rows])))
    got = alignment_scores(odd, SIDE_A, SIDE_B).select("place", "kept", "bucket", *FIGURES).collect()
    assert {r.place: tuple(r)[3:] for r in got} == want and all(r.place == r.kept == r.bucket for r in got)


def test_texts_that_do_not_come_back(spark, none):
    texts = ["a▁b", "<|endoftext|> <s> x  y\n\n z\t", " lead", "<0x41> ", "ﬁ ½", "日本" * 50 + "🙂" * 300]
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = alignment_scores(table, SIDE_A, SIDE_B).orderBy("doc_id").select(*FIGURES).collect()
    assert [tuple(r) for r in got] == _plain(texts)
    assert tuple(got[0]) == (0, 0, 0, 0, 0, 0, "")
    assert alignment_scores(none, SIDE_A, SIDE_B).collect() == []
    whole = align(table, SIDE_A, SIDE_B).orderBy("doc_id").collect()
    assert [(len(r.ids_a), len(r.ids_b), len(r.ends_a)) for r in whole] == [tuple(r)[:3] for r in got]
    assert all(len(r.ends_a) == len(r.ends_b) and r.text == t for r, t in zip(whole, texts))


def test_query(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    want = dict(zip([r.doc_id for r in docs], _plain([r.text for r in docs])))
    got = QUERIES["op11_cross_tokenizer_alignment"](spark, sf)
    assert got.columns == ["doc_id", *FIGURES]
    assert {r.doc_id: tuple(r)[1:] for r in got.collect()} == want
