"""The edit join against all pairs, and what is left of documents."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from seriesloom.llm.line_dedup import edit_links, line_dedup, within_edits


def _edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def _mutated(rng, s, n):
    s = list(s)
    for _ in range(n):
        i, kind = rng.randrange(len(s) + 1), rng.randrange(3)
        if kind == 0:
            s.insert(i, rng.choice("abcé 🙂"))
        elif s:
            i = min(i, len(s) - 1)
            if kind == 1:
                del s[i]
            else:
                s[i] = rng.choice("abcé 🙂")
    return "".join(s)


def _lines(seed, low, high, n=150):
    rng = random.Random(seed)
    base = ["".join(rng.choice("abcé ") for _ in range(rng.randint(low, high))) for _ in range(n // 8)]
    return sorted({_mutated(rng, rng.choice(base), rng.randrange(4)) for _ in range(n)})


def test_within_edits(spark):
    rng = random.Random(5)
    pairs = [(_mutated(rng, s, 2), s) for s in _lines(1, 0, 12)] + [("", ""), ("", "ab"), ("abc", ""), ("ab", "ba")]
    df = spark.createDataFrame(pairs, "a string, b string")
    codes = [F.encode(c, "UTF-32") for c in "ab"]
    for k in (0, 1, 2, 3):
        got = df.select("a", "b", within_edits(*codes, k).alias("near")).collect()
        assert all(r.near == (_edits(r.a, r.b) <= k) for r in got)
    same = F.when(F.substring("a", 1, 3) == F.substring("b", 1, 3), F.least(F.char_length("a"), F.char_length("b"), F.lit(3))).otherwise(0)
    got = df.select("a", "b", within_edits(*codes, 2, same).alias("near")).collect()
    assert all(r.near == (_edits(r.a, r.b) <= 2) for r in got)


def test_links(spark):
    for seed, low, high, edits in ((2, 6, 12, 2), (3, 9, 30, 2), (4, 5, 9, 1), (5, 12, 20, 3)):
        lines = _lines(seed, low, high)
        df = spark.createDataFrame(list(enumerate(lines)), "id long, line string")
        got = [(r.a, r.b) for r in edit_links(df, edits, 5, chunk=7).collect()]
        long = [i for i, x in enumerate(lines) if len(x) >= 5]
        want = {(i, j) for i in long for j in long if i < j and _edits(lines[i], lines[j]) <= edits}
        assert len(got) == len(set(got)) and set(got) == want


def test_documents(spark, odd, none):
    got = line_dedup(odd)
    assert line_dedup(none).count() == 0 and got.count() == odd.count()
    text = {}
    for r in got.collect():
        text.setdefault(r.doc_id, []).append((r.text, r.n_lines, r.n_removed))
    assert text[2] == [(None, 0, 0)] and text[3] == [("", 1, 0)] and text[4] == [(" \t\n\x0b ", 2, 0)]
    assert text[1][0][2] == 0 and text[5] == [("and more", 2, 1)] * 2
    assert sorted(text[None]) == [("", 1, 1), ("null one", 2, 1)]
    assert text[6][0][2] == 0 and text[7] == [("", 1, 1)] and text[9] == [("a", 1, 0)]


def test_near_lines_and_ties(spark):
    a, b = "a line that is long enough to be compared", "a line that is long enuogh to be compared"
    rows = [(3, f"{b}\nx\n{b}"), (1, f"{a}\ny"), (2, b), (None, f"{'z' * 40}\n{'z' * 40}\n"), (None, "z" * 41)]
    got = {}
    for r in line_dedup(spark.createDataFrame(rows, "doc_id long, text string"), min_chars=20).collect():
        got.setdefault(r.doc_id, []).append(r.text)
    assert got[1] == [f"{a}\ny"] and got[2] == [""] and got[3] == ["x"]
    assert sorted(got[None]) == [f"{'z' * 40}\n", "z" * 41]


def test_given_documents_without_edits(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    got = {r.doc_id: r.text for r in line_dedup(docs, edits=0).collect()}
    seen = set()
    for r in docs.orderBy("doc_id").collect():
        left = []
        for line in r.text.split("\n"):
            if len(line) < 30 or line not in seen:
                left.append(line)
            seen.add(line)
        assert got[r.doc_id] == "\n".join(left)


def test_lines_that_share_most(spark):
    rng = random.Random(8)
    words = ["".join(rng.choices("abcdefgh", k=6)) for _ in range(40)]
    lines = set()
    for _ in range(150):
        own = list(words)
        own[rng.randrange(40)] = "".join(rng.choices("abcdefgh", k=rng.randint(5, 7)))
        line = " ".join(own)
        lines |= {line, _mutated(rng, line, 1)}
    lines = sorted(lines)
    df = spark.createDataFrame(list(enumerate(lines)), "id long, line string")
    got = {(r.a, r.b) for r in edit_links(df, chunk=16).collect()}
    near = lambda a, b: abs(len(a) - len(b)) <= 2 and _edits(a, b) <= 2
    # a mutated line is next to its origin; other pairs are checked on a part
    assert got >= {(i, j) for i in range(60) for j in range(i + 1, 60) if near(lines[i], lines[j])}
    assert all(near(lines[i], lines[j]) for i, j in got)


def test_short_lines(spark):
    rows = [
        (1, "All rights reserved.\nok\n\nfirst text\n" + "c" * 29),
        (2, "All rights reserved.\nok\n\nfirst texts\nsecond\n" + "c" * 30),
        (3, "All right reserved\nno\n\nsecund\nAll rights reserved!"),
    ]
    got = {r.doc_id: (r.text, r.n_removed) for r in line_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    # equal at any length, one edit from 10 code points, none below; blank lines stay
    assert got == {1: (rows[0][1], 0), 2: ("\nsecond", 4), 3: ("All right reserved\nno\n\nsecund", 1)}
