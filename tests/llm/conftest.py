from __future__ import annotations

import pytest

LONG = " ".join(f"word{i % 977} and{i % 31}" for i in range(60_000))
ROWS = [
    (1, "The first text has ten words, as a text should have.\nA second line that is long enough to count here."),
    (2, None),
    (3, ""),
    (4, " \t\n\x0b "),
    (5, "A second line that is long enough to count here.\nand more"),
    (5, "A second line that is long enough to count here.\nand more"),
    (None, "A second line that is long enough to count here.\nnull one"),
    (None, "The first text has ten words, as a text should have."),
    (6, LONG),
    (7, LONG),
    (8, "ÉÀ ﬁ İ Σας 🙂 ́ <|endoftext|> x"),
    (9, "a"),
]
TEXTS = "doc_id long, text string"


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls, empty, blank and very long texts, repeated rows and keys, and columns named like results."""
    names = ["kept", "Fingerprint", "shard", "slot", "ids", "n_lines", "portion", "place", "bucket", "key", "line", "id"]
    rows = [(*r, *[i] * len(names)) for i, r in enumerate(ROWS)]
    return spark.createDataFrame(rows, f"{TEXTS}, {', '.join(f'`{n}` int' for n in names)}").repartition(3)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], f"{TEXTS}, kept int")
