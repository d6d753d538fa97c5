"""Quality rules: word and line counts, and compression bands over whole texts and fixed chunks."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass, field, replace
from itertools import count
from typing import Any

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.quantiles import exact_quantiles
from .batches import SPACES, texts, with_computed
from .storing import sent_whole, stored

#: zstandard's bytes out per byte in, lowest and highest that pass, by least length in bytes, for
#: lengths without fitted limits. Short texts compress badly whatever they hold, so the band narrows and sinks with length. Under the first
#: length nothing can be told.
BANDS: tuple[tuple[int, float, float], ...] = (
    (64, 0.55, 1.35),
    (128, 0.45, 1.10),
    (256, 0.42, 0.90),
    (512, 0.40, 0.80),
    (1024, 0.36, 0.72),
    (2048, 0.32, 0.66),
    (4096, 0.28, 0.64),
    (8192, 0.26, 0.62),
)
SYMBOLS = b"#*$%&|<>"
COLUMNS = {
    "n_words": "long",
    "word_chars": "long",
    "n_symbols": "long",
    "n_dup_lines": "long",
    "n_repeat_words": "long",
    "ratio": "double",
    "odd_share": "double",
    "base_failed": "boolean",
    "kept": "boolean",
}


def repeated_words(words: Sequence[bytes], size: int = 5) -> int:
    """Words covered by windows of ``size`` words that occur at least twice, the first included."""
    n = len(words)
    if n <= size:
        return 0
    known: dict[bytes, int] = {}
    number = count()
    runs = np.fromiter((known.setdefault(w, i) for w, i in zip(words, number)), np.int64, n)
    # windows get longer by a word a step and are numbered anew, so that equal numbers mean equal windows
    ids = runs
    for k in range(1, size):
        ids = ids[:-1] * n + runs[k:]
        if k + 1 < size:
            ids = np.unique(ids, return_inverse=True)[1]
    _, where, times = np.unique(ids, return_inverse=True, return_counts=True)
    again = times[where] > 1
    if not again.any():
        return 0
    covered = np.zeros(n, bool)
    for k in range(size):
        covered[k : k + len(again)] |= again
    return int(covered.sum())


def repeated_lines(text: bytes) -> int:
    """Lines with a word that equal an earlier line."""
    lines = [line for line in text.split(b"\n") if line.strip(SPACES)]
    return len(lines) - len(set(lines))


@dataclass(frozen=True)
class Limits:
    """Lowest and highest ratio that pass: of whole texts by length, and of chunks, all of the same size."""

    bands: Sequence[tuple[int, float, float]] = BANDS
    fitted: Mapping[int, tuple[float, float]] = field(default_factory=dict)  # by class of length
    chunk: int = 4096
    chunks: tuple[float, float] = (0.28, 0.64)  # lowest without the dictionary, highest with it
    odd_limit: float = 0.25  # of a text's chunks
    dictionary: bytes = b""  # that tells whether chunks are incompressible
    level: int = 3

    def whole(self, n: int) -> tuple[float, float]:
        """Limits of a text of ``n`` bytes: those fitted to its class of length, else the fixed band."""
        found = self.fitted.get(length_class(n)) if n else None
        if found is None:
            found = (0.0, math.inf)
            for least, low, high in self.bands:
                if n >= least:
                    found = (low, high)
        return found

    def sizes(self) -> tuple[Callable[[bytes], float], Callable[[bytes], float]]:
        """Functions that give the ratio of a whole text and that of a chunk."""
        plain = zstandard.ZstdCompressor(level=self.level)
        aided = plain
        if self.dictionary:
            known = zstandard.ZstdCompressionDict(self.dictionary)
            known.precompute_compress(level=self.level)
            aided = zstandard.ZstdCompressor(dict_data=known)
        return lambda x: len(plain.compress(x)) / len(x), lambda x: len(aided.compress(x)) / len(x)


def length_class(n: int) -> int:
    """Two classes for each doubling of the length."""
    return math.floor(2 * math.log2(n))


def chunks_of(data: bytes, size: int) -> Iterator[bytes]:
    """Chunks of ``size`` bytes, the last one moved back to where it fits; a shorter text has none."""
    if len(data) >= size:
        for i in range(0, len(data) - size + 1, size):
            yield data[i : i + size]
        if len(data) % size:
            yield data[-size:]


def base_fails(words: Sequence[bytes], again: int) -> bool:
    """Fewer than 10 words, or over a fifth of them in five-word windows that repeat."""
    return len(words) < 10 or 100 * again > 20 * len(words)


def _spread(quantiles: Sequence[float], width: float) -> tuple[float, float]:
    low, left, middle, right, high = quantiles
    reach = width * (right - left) / 2
    return min(low, middle - reach), max(high, middle + reach)


def _quantile(times: Mapping[int, int], share: float) -> float:
    """The quantile (linear interpolation) of values that occur so many times."""
    values = np.array(sorted(times))
    upto = np.cumsum([times[v] for v in values.tolist()])
    at = (int(upto[-1]) - 1) * share
    low, high = (float(values[np.searchsorted(upto, i, side="right")]) for i in (math.floor(at), math.ceil(at)))
    return low + (high - low) * (at - math.floor(at))


def _labelled_texts(docs: DataFrame, good: DataFrame, key: str, text: str) -> DataFrame:
    """``hash`` and ``text`` of every key in ``good``, one text a key (that of the smallest hash), equal texts once."""
    wanted = stored(good.select(F.col(key).alias("key")).where("key is not null").distinct())
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text")).where("text <> ''")
    rows = rows.withColumn("hash", F.xxhash64("text")).join(sent_whole(wanted), "key", "left_semi")
    one = stored(rows.groupBy("key").agg(F.min("hash").alias("hash")))
    return rows.join(sent_whole(one), ["key", "hash"], "left_semi").groupBy("hash").agg(F.min("text").alias("text"))


def _frequent_words(texts_of: DataFrame, size: int) -> bytes:
    """A dictionary of ``size`` bytes: the words whose repetition holds most bytes, those most often used last, where
    they are cheapest to point at. All words of all texts are counted; what comes back is set by ``size``."""

    def count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            times = Counter(w for x in texts(batch.column("text")) for w in x.split())
            yield pa.RecordBatch.from_pydict({"word": pa.array([*times], pa.binary()), "n": pa.array([*times.values()], pa.int64())})

    counts = texts_of.select("text").mapInArrow(count_words, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))
    # with the space before it; a match of three bytes or less saves nothing
    saved = F.col("n") * (F.octet_length("word") - 2)
    best = counts.where("n > 1 and octet_length(word) > 2").orderBy(saved.desc(), "word").limit(size // 4)
    taken, held = [], 0
    for r in best.collect():
        if held + len(r.word) + 1 <= size:
            taken.append((r.n, bytes(r.word)))
            held += len(r.word) + 1
    return b"".join(b" " + w for _, w in sorted(taken))


def fit_limits(
    docs: DataFrame,
    good: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    least: int = 40,
    chunk: int = 512,
    odd_limit: float = 0.5,
    tail: float = 0.002,
    width: float = 3.3,
    dictionary_bytes: int = 64 << 10,
) -> Limits:
    """Limits from all texts known to be good: ``docs`` whose ``key`` is in ``good``.

    One text a key and equal texts once count, without those that the base rules reject. A class of length with
    ``least`` of them gets limits of its own, from exact quantiles of all its ratios: they leave out at most a share
    of ``tail`` on either side and lie at least ``width`` standard deviations (from the middle 68 %) off the median.
    Other classes keep the fixed bands. The texts are halved by hash: the words of one half are counted for a
    dictionary, so that text of another kind does not compress like theirs; all chunks of the other half set the
    limits of chunks. With fewer than ``2 * least`` chunks a half, chunks keep their fixed band too.

    What reaches the driver are the words of the dictionary, quantiles, and how often each compressed size of a
    chunk occurs. Null keys and null, empty or missing texts teach nothing.
    """

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole, _ = Limits().sizes()
        for batch in batches:
            sound, kinds, ratios, chunks = [], [], [], []
            for data in texts(batch.column("text")):
                words = data.split()
                sound.append(not base_fails(words, repeated_words(words)))
                if sound[-1]:
                    kinds.append(length_class(len(data)))
                    ratios.append(whole(data))
                    chunks.append(-(-len(data) // chunk) if len(data) >= chunk else 0)
            rows = batch.filter(pa.array(sound, pa.bool_()))
            half = pa.array(rows.column("hash").to_numpy() & 1, pa.int32())
            columns = [half, pa.array(kinds, pa.int32()), pa.array(ratios, pa.float64()), pa.array(chunks, pa.int64()), rows.column("text")]
            yield pa.RecordBatch.from_arrays(columns, ["half", "class", "ratio", "chunks", "text"])

    drawn = _labelled_texts(docs, good, key, text)
    seen = stored(drawn.mapInArrow(measure, "half int, class int, ratio double, chunks long, text string"))
    sizes = {r["class"]: r.n for r in seen.groupBy("class").agg(F.count(F.lit(1)).alias("n")).collect()}
    own = sorted(c for c, n in sizes.items() if n >= least)
    fitted: dict[int, tuple[float, float]] = {}
    if own:
        by_class = seen.select(*[F.when(F.col("class") == c, F.col("ratio")).alias(f"class {c}") for c in own])
        spread = exact_quantiles(by_class, by_class.columns, [tail, 0.16, 0.5, 0.84, 1 - tail])
        fitted = {c: _spread(spread[f"class {c}"], width) for c in own}
    held = {r["half"]: r for r in seen.groupBy("half").agg(F.sum("chunks").alias("n")).collect()}
    if min(held[h].n if h in held else 0 for h in (0, 1)) < 2 * least:
        return Limits(fitted=fitted)
    dictionary = _frequent_words(seen.where("half = 0"), min(dictionary_bytes, held[0].n * chunk // 8))
    limits = Limits(fitted=fitted, chunk=chunk, odd_limit=odd_limit, dictionary=dictionary)

    def compress(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        functions = limits.sizes()
        for batch in batches:
            times = Counter((i, round(f(c) * chunk)) for x in texts(batch.column("text")) for c in chunks_of(x, chunk) for i, f in enumerate(functions))
            which, size = zip(*times) if times else ((), ())
            columns = [pa.array(which, pa.int32()), pa.array(size, pa.int64()), pa.array([*times.values()], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["aided", "size", "n"])

    packed = seen.where("half = 1").select("text").mapInArrow(compress, "aided int, size long, n long")
    plain, aided = {}, {}
    for r in packed.groupBy("aided", "size").agg(F.sum("n").alias("n")).collect():
        (aided if r.aided else plain)[r["size"]] = r.n
    return replace(limits, chunks=(_quantile(plain, tail) / chunk, _quantile(aided, 1 - 2 * tail) / chunk))


def quality_bands(docs: DataFrame, text: str = "text", limits: Limits = Limits()) -> DataFrame:
    """The input with counts, compression figures and a verdict for every row.

    ``ratio`` is the compressed size of the whole text over its size in bytes (null for an empty text).
    ``odd_share`` is the share of its chunks whose own ratio lies outside the limits of chunks. ``kept`` is false
    if the base rules fail (fewer than 10 words, or over a fifth of the words in five-word windows that repeat),
    if the whole text lies outside the limits of its length (below: repetitive, above: incompressible), or if
    ``odd_share`` is over the limit.

    Null and empty texts have counts of zero and are rejected; equal rows get equal results, no rows give no
    rows, and input columns named like an output column are replaced.
    """

    def make() -> Callable[[pa.RecordBatch], Mapping[str, Any]]:
        whole, part = limits.sizes()
        lowest, highest = limits.chunks

        def row(data: bytes) -> tuple:
            words = data.split()
            solid = data.translate(None, SPACES)
            chars = len(solid) - len(solid.translate(None, _LEADS))
            symbols = len(data) - len(data.translate(None, SYMBOLS))
            again = repeated_words(words)
            failed = base_fails(words, again)
            ratio, share, kept = None, 0.0, not failed
            if data:
                ratio = whole(data)
                # a copy of what the dictionary holds is not repetitive in itself
                odd = [whole(c) < lowest or part(c) > highest for c in chunks_of(data, limits.chunk)]
                share = sum(odd) / len(odd) if odd else 0.0
                low, high = limits.whole(len(data))
                kept = not failed and low <= ratio <= high and share <= limits.odd_limit
            return len(words), chars, symbols, repeated_lines(data), again, ratio, share, failed, kept

        def compute(batch: pa.RecordBatch) -> Mapping[str, Any]:
            rows = [row(x) for x in texts(batch.column(text))]
            return dict(zip(COLUMNS, zip(*rows)))

        return compute

    return with_computed(docs, COLUMNS, make)


#: Bytes that begin a code point.
_LEADS = bytes(b for b in range(256) if not 0x80 <= b < 0xC0)
