"""Spelling variants: words one edit apart, found by search schemes over FM-indexes in both directions."""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .storing import stored

#: Words of an index, as bounded by the copies that its shard receives.
SHARD = 20_000
#: Runs of letters; the range holds the signs of multiplication and division, too.
LETTERS = "[A-Za-zÀ-ÿ]+"


def vocabulary(docs: DataFrame, key: str = "doc_id", text: str = "text", slip: int = 97, least_chars: int = 5) -> DataFrame:
    """``word`` and ``n`` of the words of at least ``least_chars`` code points in whole texts.

    Words are maximal runs of letters with A-Z in lower case. Where ``slip`` divides the CRC-32 of
    ``<key>:<word>`` (UTF-8), the word loses its code point number CRC-32 mod length. Null texts have no words; a
    null key counts as an empty one. Repeated rows count each. Words are counted in each batch before the shuffle.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = re.compile(LETTERS).findall
        for batch in batches:
            counts: Counter[str] = Counter()
            for k, x in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if not x:
                    continue
                begun = zlib.crc32(f"{'' if k is None else k}:".encode())
                for w, n in Counter(find(x.encode().lower().decode())).items():  # bytes.lower() knows A-Z only
                    if len(w) < least_chars:
                        continue
                    h = zlib.crc32(w.encode(), begun)
                    if h % slip == 0:
                        at = h % len(w)
                        w = w[:at] + w[at + 1 :]
                        if len(w) < least_chars:
                            continue
                    counts[w] += n
            yield pa.record_batch({"word": pa.array(counts.keys(), pa.string()), "n": pa.array(counts.values(), pa.int64())})

    found = docs.select(F.col(key).cast("string"), F.col(text)).mapInArrow(run, "word string, n long")
    return found.groupBy("word").agg(F.sum("n").alias("n"))


class Index:
    """FM-index of distinct words, each closed to a ring by a delimiter.

    Rows are the suffixes of all words up to the delimiter in order, equal ones by word, so that rows 0 to n - 1
    are the delimiters: row i is that of word i. An interval of rows stands for what was matched so far and
    grows to the left.
    """

    def __init__(self, words: list[str]):
        self.words = sorted(words)
        n = len(self.words)
        text = np.frombuffer("\0".join([*self.words, ""]).encode("utf-32-le"), "<u4")
        self.alphabet, symbols = np.unique(text, return_inverse=True)  # the delimiter is 0
        size = len(text)
        ends = np.flatnonzero(symbols == 0)
        rank = symbols.astype(np.int64) + n
        rank[ends] = np.arange(n)
        # sort by prefixes of doubled length; those that reach a delimiter are unique already
        span = 1
        longest = int(np.diff(ends, prepend=-1).max(initial=1))
        while span < longest:
            after = np.zeros(size, np.int64)
            after[:-span] = rank[span:]
            rank = np.unique(rank * (size + n + len(self.alphabet)) + after, return_inverse=True)[1]
            span *= 2
        order = np.empty(size, np.int64)
        order[np.unique(rank, return_inverse=True)[1]] = np.arange(size)
        before = np.concatenate([symbols[-1:], symbols[:-1]])  # the delimiter comes before a word's start
        self.size, self.last = size, before[order].astype(np.int64)
        by_symbol = np.argsort(self.last, kind="stable")
        self.keys = self.last[by_symbol] * size + by_symbol
        self.up = np.empty(size, np.int64)
        self.up[by_symbol] = np.arange(size)

    def codes(self, texts: str) -> np.ndarray:
        """Symbols of texts; -1 for characters that no word has."""
        points = np.frombuffer(texts.encode("utf-32-le"), "<u4")
        at = np.minimum(np.searchsorted(self.alphabet, points), len(self.alphabet) - 1)
        return np.where(self.alphabet[at] == points, at, -1).astype(np.int64)

    def extend(self, symbol: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Intervals grown by one symbol each; empty where nothing matches."""
        base = symbol * self.size
        return np.searchsorted(self.keys, base + low), np.searchsorted(self.keys, base + high)

    def branches(self, low: np.ndarray, high: np.ndarray, most: int = 1 << 21) -> Iterator[tuple[np.ndarray, ...]]:
        """All ways to grow each interval: the interval's number, the symbol and the new interval, in portions.

        Small intervals are read row by row, large ones are asked for each symbol of the alphabet.
        """
        sizes = high - low
        wide = np.flatnonzero(sizes > len(self.alphabet))
        for symbol in range(len(self.alphabet)) if len(wide) else ():
            a, b = self.extend(np.full(len(wide), symbol), low[wide], high[wide])
            hit = a < b
            yield wide[hit], np.full(hit.sum(), symbol), a[hit], b[hit]
        small = np.flatnonzero(sizes <= len(self.alphabet))
        step = max(1, most // len(self.alphabet))
        for i in range(0, len(small), step):
            part = small[i : i + step]
            owner = np.repeat(part, sizes[part])
            first = np.cumsum(sizes[part]) - sizes[part]
            rows = np.arange(len(owner)) + np.repeat(low[part] - first, sizes[part])
            symbol = self.last[rows]
            order = np.lexsort((rows, symbol, owner))
            owner, symbol, rows = owner[order], symbol[order], rows[order]
            new = np.ones(len(owner), bool)
            new[1:] = (owner[1:] != owner[:-1]) | (symbol[1:] != symbol[:-1])
            starts = np.flatnonzero(new)
            stops = np.append(starts[1:], len(owner)) - 1
            yield owner[starts], symbol[starts], self.up[rows[starts]], self.up[rows[stops]] + 1

    def one_error(self, queries: np.ndarray, exact: int) -> tuple[np.ndarray, np.ndarray]:
        """Queries (rows of symbols in the order of matching) and the words that differ from them by one edit
        behind the first ``exact`` symbols.

        Two fronts move along the queries: matches so far, and matches with one edit. Of edits inside a run of
        one symbol only that at its end is tried, as all give the same word.
        """
        n, length = queries.shape
        who, low, high = np.arange(n), np.zeros(n, np.int64), np.full(n, len(self.words))
        edited = tuple(np.zeros(0, np.int64) for _ in range(3))

        def step(front: tuple[np.ndarray, ...], symbol: np.ndarray) -> tuple[np.ndarray, ...]:
            a, b = self.extend(symbol, front[1], front[2])
            hit = a < b
            return front[0][hit], a[hit], b[hit]

        for j in range(length + 1):
            following = queries[:, j] if j < length else np.zeros(n, np.int64)  # then the delimiter
            if j >= exact and len(who):
                grown = []
                for i, symbol, a, b in self.branches(low, high):
                    hit = (symbol != 0) & (symbol != following[who[i]])
                    grown.append((who[i][hit], a[hit], b[hit]))
                grown = tuple(map(np.concatenate, zip(*grown))) if grown else edited
                edited = tuple(map(np.concatenate, zip(edited, grown)))  # an inserted symbol
            edited = step(edited, following[edited[0]])
            if j < length and j >= exact and len(who):
                edited = tuple(map(np.concatenate, zip(edited, grown)))  # a replaced one
                run_ends = queries[who, j] != queries[who, j + 1] if j + 1 < length else np.ones(len(who), bool)
                left_out = who[run_ends], low[run_ends], high[run_ends]
                edited = tuple(map(np.concatenate, zip(edited, left_out)))
            if j < length:
                who, low, high = step((who, low, high), following[who])
        return edited[0], edited[1]


def near_in_shard(targets: list[str], queries: list[str], side: int) -> tuple[list[int], list[int]]:
    """Numbers of queries and targets that are one edit apart with the same first (``side`` 0) or last half."""
    turn = (lambda w: w[::-1]) if side == 0 else (lambda w: w)
    place = {turn(w): i for i, w in enumerate(targets)}
    index = Index(list(place))
    original = np.array([place[w] for w in index.words])
    found_queries, found_targets = [], []
    by_length: dict[int, list[int]] = {}
    for i, q in enumerate(queries):
        by_length.setdefault(len(q), []).append(i)
    for length, ids in by_length.items():
        symbols = index.codes("".join([queries[i] for i in ids])).reshape(len(ids), length)
        # an index of reversed words grows matches to the right, one of the words themselves to the left
        exact = length // 2 if side == 0 else length - length // 2
        who, row = index.one_error(symbols if side == 0 else symbols[:, ::-1], exact)
        found_queries += np.array(ids)[who].tolist()
        found_targets += original[row].tolist()
    return found_queries, found_targets


def _halves(word: Column, length: Column, side: int) -> Column:
    """What a query of ``length`` code points keeps of a word of about that length."""
    kept = F.floor(length / 2).cast("int") if side == 0 else F.ceil(length / 2).cast("int")
    return F.left(word, kept) if side == 0 else F.right(word, kept)


def near_words(words: DataFrame, word: str = "word", n: str = "n", shard: int = SHARD) -> DataFrame:
    """``word``, ``near`` and ``near_n`` (the count of the near word) for all pairs of words one edit apart.

    ``words`` holds distinct, non-null words. One edit leaves the first or the last half of a word unchanged, so
    a word is searched for among those with the same first half and among those with the same last half, by
    length. Halves are dealt into shards by hash; a half that more than ``shard`` words share gets several
    shards, each with a part of its words, and its queries visit them all. Each shard is indexed in the
    direction in which its searches grow, and no task holds more than its shards.
    """
    column, length = F.col(word), F.char_length(word)
    listed = []
    for side in (0, 1):
        half = F.array_distinct(F.array(*[_halves(column, length + d, side) for d in (-1, 0, 1)]))
        listed.append(words.select(column.alias("word"), F.col(n).alias("n"), F.lit(side).alias("side"), F.explode(half).alias("half")))
    targets = stored(listed[0].union(listed[1]))
    sizes = targets.groupBy("side", "half").agg(F.count(F.lit(1)).alias("size"))
    hot = sizes.where(F.col("size") > shard).withColumn("parts", F.ceil(F.col("size") / shard).cast("int")).drop("size")
    total = targets.count()
    shards = max(1, -(-total // shard))
    asked = [
        words.select(column.alias("word"), F.lit(None).cast("long").alias("n"), F.lit(s).alias("side"), _halves(column, length, s).alias("half"))
        for s in (0, 1)
    ]
    rows = targets.select("*", F.lit(False).alias("asks")).union(asked[0].union(asked[1]).select("*", F.lit(True).alias("asks")))
    rows = rows.join(hot, ["side", "half"], "left")
    own = F.array(F.pmod(F.xxhash64("word"), "parts").cast("int"))
    every = F.sequence(F.lit(0), F.col("parts") - 1)
    parts = F.when(F.col("parts").isNull(), F.array(F.lit(-1))).when(F.col("asks"), every).otherwise(own)
    dealt = rows.withColumn("part", F.explode(parts)).select(
        "side",
        F.when(F.col("part") < 0, F.concat(F.lit("*"), F.pmod(F.xxhash64("half"), F.lit(shards)).cast("string")))
        .otherwise(F.concat_ws("*", "half", "part"))
        .alias("shard"),
        "word",
        "n",
        "asks",
    )

    def search(key: tuple, rows: pa.Table) -> pa.Table:
        side = key[0].as_py()
        asks = rows["asks"].to_numpy()
        words, counts = np.array(rows["word"].to_pylist(), object), rows["n"].to_numpy()
        held = dict(zip(words[~asks].tolist(), counts[~asks].tolist()))
        queries = sorted(set(words[asks].tolist()))
        targets = list(held)
        if not targets or not queries:
            q, t = [], []
        else:
            q, t = near_in_shard(targets, queries, side)
        return pa.table(
            {
                "word": pa.array([queries[i] for i in q], pa.string()),
                "near": pa.array([targets[i] for i in t], pa.string()),
                "near_n": pa.array([int(held[targets[i]]) for i in t], pa.int64()),
            }
        )

    found = dealt.groupBy("side", "shard").applyInArrow(search, "word string, near string, near_n long")
    return found.distinct()


def roots(forms: DataFrame) -> DataFrame:
    """``word`` and ``root``, the end of the chain of ``form``, for words with a form.

    A form occurs at least twice as often as its word, so chains end; each round doubles the steps taken.
    """
    ups = stored(forms.where(F.col("form").isNotNull()).select("word", F.col("form").alias("root")))
    while True:
        further = ups.select(F.col("word").alias("_at"), F.col("root").alias("_next"))
        joined = ups.join(further, F.col("root") == F.col("_at"), "left")
        moved = stored(joined.select("word", F.coalesce("_next", "root").alias("root"), F.col("_next").isNotNull().alias("moved")))
        ups = moved.select("word", "root")
        if not moved.where("moved").limit(1).count():
            return ups


def spelling_forms(words: DataFrame, times: int = 2, shard: int = SHARD) -> DataFrame:
    """For each of the distinct words (``word``, ``n``): ``form``, its near word of largest n if that is at least
    ``times`` n (of equal ones the first in the order of code points), ``root``, where forms lead to (the word
    itself if it has none), ``n``, ``n_near`` (near words) and ``form_n`` (the form's n). Null words are dropped.
    """
    words = stored(words.where(F.col("word").isNotNull()).select("word", "n"))
    near = near_words(words, shard=shard)
    best = F.min(F.struct((-F.col("near_n")).alias("m"), "near"))
    summary = near.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best.alias("best"))
    joined = words.join(summary, "word", "left")
    frequent = -F.col("best.m") >= F.lit(times) * F.col("n")
    forms = stored(
        joined.select(
            "word",
            F.when(frequent, F.col("best.near")).alias("form"),
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(frequent, -F.col("best.m")).alias("form_n"),
        )
    )
    ends = roots(forms)
    return forms.join(ends, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
