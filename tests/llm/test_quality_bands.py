"""Counts against plain loops, verdicts on texts of known kind."""

from __future__ import annotations

import math
import random
import re
from pathlib import Path

import numpy as np
import pytest
import zstandard
from pyspark.sql import functions as F

from seriesloom.llm.quality_bands import Limits, fit_limits, quality_bands, repeated_lines, repeated_words


def _loop(words, size=5):
    n = len(words)
    seen = {}
    for i in range(n - size + 1):
        seen.setdefault(tuple(words[i : i + size]), []).append(i)
    return len({j for at in seen.values() if len(at) > 1 for i in at for j in range(i, i + size)})


def test_repeated_words():
    rng = random.Random(1)
    for n in [*range(14), 60, 400]:
        for kinds in (1, 2, 3, 30):
            words = [b"%d" % rng.randrange(kinds) for _ in range(n)]
            assert repeated_words(words) == _loop(words)


def test_repeated_lines():
    assert repeated_lines(b"a\n\na\n \n \nb\na \na") == 2


def test_counts_and_rows(odd, none):
    got = quality_bands(odd).collect()
    assert len(got) == odd.count() and quality_bands(none).count() == 0
    for r in got:
        words = re.findall(r"[^\x20\x09-\x0D]+", r.text or "")
        assert r.n_words == len(words) and r.word_chars == sum(map(len, words))
        assert r.n_symbols == sum(c in "#*$%&|<>" for c in r.text or "")
        assert r.n_repeat_words == _loop(words)
        assert r.base_failed == (len(words) < 10 or 100 * r.n_repeat_words > 20 * len(words))
        assert isinstance(r.kept, bool) and not (r.base_failed and r.kept)
    assert [c for c in quality_bands(odd).columns if c.lower() == "kept"] == ["kept"]


def test_bands(spark):
    rng = random.Random(2)
    syllables = "an the ing er on re ti es or nd st en at ed th ou ea ha to it".split()
    prose = " ".join("".join(rng.choices(syllables, k=rng.randint(1, 4))) for _ in range(900))
    noise = " ".join("".join(chr(rng.randrange(33, 127)) for _ in range(9)) for _ in range(900))
    rising = "\n".join(f"entry {i} of the long list: nothing new" for i in range(300))
    df = spark.createDataFrame([(1, prose), (2, noise), (3, rising), (4, prose + noise)], "doc_id long, text string")
    kept = {r.doc_id: r.kept for r in quality_bands(df).collect()}
    assert kept == {1: True, 2: False, 3: False, 4: False}


def _verdict(data, limits):
    """Base rules, whole text and chunks, each by plain calls."""
    words = data.split()
    if len(words) < 10 or 100 * _loop(words) > 20 * len(words):
        return False
    ratio = len(zstandard.ZstdCompressor(level=3).compress(data)) / len(data)
    bands = [b[1:] for b in limits.bands if b[0] <= len(data)] or [(0, 9e9)]
    low, high = limits.fitted.get(math.floor(2 * math.log2(len(data))), bands[-1])
    size, odd, n = limits.chunk, 0, 0
    at = [*range(0, len(data) - size + 1, size)]
    at += [len(data) - size] if at and len(data) % size else []
    for i in at:
        known = {"dict_data": zstandard.ZstdCompressionDict(limits.dictionary)} if limits.dictionary else {}
        plain, aided = (len(zstandard.ZstdCompressor(level=3, **k).compress(data[i : i + size])) / size for k in ({}, known))
        odd += plain < limits.chunks[0] or aided > limits.chunks[1]
    return low <= ratio <= high and odd <= limits.odd_limit * len(at)


def _labelled(spark, sf, size="sf0.01"):
    folder = Path(sf).parent / size
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    labels = spark.read.parquet(f"{folder}/labels.parquet").dropDuplicates(["doc_id"])
    return docs, labels.withColumn("held_out", F.crc32(F.col("doc_id").cast("string")) % 2 == 0)


def test_verdicts_by_plain_calls(spark, sf, odd):
    docs, labels = _labelled(spark, sf)
    fitted = fit_limits(docs, labels.where("quality = 1"), least=12)
    assert fitted.fitted and fitted.dictionary and fitted.chunk == 512
    for limits in (Limits(), fitted):
        for df in (docs, odd):
            for r in quality_bands(df.select("doc_id", "text"), limits=limits).collect():
                assert r.kept == _verdict((r.text or "").encode(), limits), r.doc_id


def test_fitted_limits_on_held_out_labels(spark, sf):
    docs, labels = _labelled(spark, sf, "sf0.1")  # enough labels for limits with production parameters
    limits = fit_limits(docs, labels.where("quality = 1 and not held_out"))
    rows = quality_bands(docs, limits=limits).where("not base_failed").join(labels.where("held_out"), "doc_id")
    kept = {r.quality: (r.n, r["kept"]) for r in rows.groupBy("quality").agg(F.count("*").alias("n"), F.count_if("kept").alias("kept")).collect()}
    assert kept[1][1] >= 0.99 * kept[1][0]
    assert kept[0][1] <= 0.4 * kept[0][0]  # the base rules alone keep all of these


def test_samples_that_teach_nothing(spark, odd):
    ids = odd.select("doc_id")
    for good in (ids, ids.limit(0), spark.createDataFrame([(None,), (77,)], "doc_id long")):
        limits = fit_limits(odd, good)
        assert not limits.fitted and not limits.dictionary and limits.chunk == 4096
    limits = fit_limits(odd.limit(0), ids)
    assert limits == Limits()


def test_one_text_for_each_key_and_equal_texts_once(spark):
    rng = random.Random(5)
    rows = [(i // 2, " ".join("".join(rng.choices("abcdefgh", k=6)) for _ in range(100))) for i in range(200)]
    docs = spark.createDataFrame(rows + [(500 + i, rows[0][1]) for i in range(300)], "doc_id long, text string")
    assert fit_limits(docs, docs, least=101).fitted == {}
    assert len(fit_limits(docs, docs, least=100).fitted) == 1


def test_limits_come_from_all_labelled_texts(spark):
    rng = random.Random(6)
    words = ["".join(rng.choices("abcdefgh", k=6)) for _ in range(3000)]
    rows = [(i, " ".join(rng.choices(words, k=100))) for i in range(4200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    limits = fit_limits(docs, docs, least=1000)
    packer = zstandard.ZstdCompressor(level=3)
    ratios = [len(packer.compress(t.encode())) / len(t) for _, t in rows]
    low, left, middle, right, high = np.quantile(ratios, [0.002, 0.16, 0.5, 0.84, 0.998])
    reach = 3.3 * (right - left) / 2
    assert list(limits.fitted) == [math.floor(2 * math.log2(699))]
    assert limits.fitted[18] == pytest.approx((min(low, middle - reach), max(high, middle + reach)))
    # no words are drawn: those of half the texts fill the dictionary
    assert all(f" {w}".encode() in limits.dictionary for w in words)
