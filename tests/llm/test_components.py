from __future__ import annotations

import random

from seriesloom.llm.components import components


def _brute(links):
    label = {}
    for a, b in links:
        label.setdefault(a, a), label.setdefault(b, b)
    moved = True
    while moved:
        moved = False
        for a, b in links:
            m = min(label[a], label[b])
            if label[a] != m or label[b] != m:
                label[a] = label[b] = m
                moved = True
    return label


def test_chains_stars_and_noise(spark):
    rng = random.Random(4)
    links = [(i, i + 1) for i in range(100, 160)] + [(500, i) for i in range(501, 700)]
    links += [(rng.randrange(1000, 1400), rng.randrange(1000, 1400)) for _ in range(250)]
    rng.shuffle(links)
    links += links[:20] + [(b, a) for a, b in links[:20]]
    want = _brute([x for x in links if x[0] != x[1]])
    df = spark.createDataFrame([*links, (None, 1), (2, None), (7, 7)], "a long, b long")
    assert {r.node: r.component for r in components(df).collect()} == want


def test_no_links(spark):
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
