"""Packing documents into windows of equal length by multiway differencing (Karmarkar-Karp)."""

from __future__ import annotations

import heapq
import math
import os
import re
from bisect import insort
from collections.abc import Callable, Iterator, Sequence
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from .batches import per_process, portions, texts

COLUMNS = {
    "start": "long",
    "length": "long",
    "ids": "binary",
    "doc_tokens": "long",
    "sequence_id": "long",
    "offset": "long",
}


def difference(sizes: Sequence[int], k: int) -> list[list[int]]:
    """Positions of ``sizes`` in ``k`` sets of nearly equal sums.

    Every size begins as a partial partition with one set in use. The two partitions with the largest
    difference between their sets are merged, the largest set of one with the smallest of the other, until
    one is left. A partition lists its used sets by sum; those not listed are empty.
    """
    parts: list[list[tuple[int, int]]] = []  # (sum, first item) of each used set, in rising order
    following = [-1] * len(sizes)  # items of a set as a chain from its first item
    final = list(range(len(sizes)))

    def spread(part: list[tuple[int, int]]) -> int:
        return part[-1][0] - (part[0][0] if len(part) == k else 0)

    heap = []
    for i, s in enumerate(sizes):
        parts.append([(s, i)])
        heap.append((-spread(parts[-1]), i))
    heapq.heapify(heap)
    while len(heap) > 1:
        one, two = heapq.heappop(heap)[1], heapq.heappop(heap)[1]
        a, b = parts[one], parts[two]
        if len(a) < len(b):
            a, b = b, a
        meet = len(a) + len(b) - k
        if meet <= 0:
            for x in b:
                insort(a, x)
        else:
            # the smallest sets of one meet the largest of the other; the rest meet empty ones
            joined = a[meet:] + b[: len(b) - meet]
            for (s, i), (t, j) in zip(a[:meet], reversed(b[-meet:])):
                following[final[i]], final[i] = j, final[j]
                joined.append((s + t, i))
            joined.sort()
            a = joined
        parts[one], parts[two] = a, []
        heapq.heappush(heap, (-spread(a), one))
    out = []
    for _, i in parts[heap[0][1]] if heap else []:
        chain = []
        while i >= 0:
            chain.append(i)
            i = following[i]
        out.append(chain)
    return out


def windows(sizes: Sequence[int], capacity: int) -> list[list[int]]:
    """Sets of positions with sums of at most ``capacity``; their number rises from the least possible."""
    k = max(1, math.ceil(sum(sizes) / capacity))
    while True:
        found = difference(sizes, k)
        if all(sum(sizes[i] for i in w) <= capacity for w in found):
            return found
        k += 1


def cuts(n: int, capacity: int, piece: int) -> Iterator[tuple[int, int]]:
    """Start and length of a document's pieces: whole windows first, then equal parts of at most ``piece``."""
    whole = n // capacity
    for i in range(whole):
        yield i * capacity, capacity
    rest = n - whole * capacity
    parts = math.ceil(rest / piece)
    for i in range(parts):
        s, e = rest * i // parts, rest * (i + 1) // parts
        yield whole * capacity + s, e - s


#: Words of plain Latin letters, which the vocabulary's normaliser keeps letters and its pre-tokenizer keeps
#: whole, with the punctuation behind them, which is a word of its own. U+0130 becomes two characters.
_PLAIN = re.compile("([A-Za-zÀ-ÖØ-öø-įı-ſ]+)([.,;:!?]*)")


class _Ids:
    """Ids of texts by the tokenizers library, which is asked once for each word.

    White space ends every token of this vocabulary and its normaliser works on characters, so the ids of a
    text are those of its pieces between white space. Plain words are encoded side by side as one text, whose
    ids are cut where a token ends a word. What is remembered is bounded by ``most`` pieces.
    """

    def __init__(self, spec: str, most: int = 600_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(spec)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        mark = self.tokenizer.model.end_of_word_suffix
        if not mark:
            raise ValueError("the vocabulary has no end-of-word mark")
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for t, i in vocabulary.items() if t.endswith(mark)]] = True
        self.known: dict[bytes, bytes] = {}
        self.most = most

    @staticmethod
    def _chunks(data: bytes) -> list[bytes]:
        # lower case first makes fewer pieces; not beside special tokens, nor where a letter and a combining
        # mark (U+0300 to U+036F) might compose in one case only
        if b"<|" in data or b"\xcc" in data or b"\xcd" in data:
            return data.split()
        return data.lower().split()

    def _encode(self, chunks: list[str]) -> list[np.ndarray]:
        found = self.tokenizer.encode_batch_fast(chunks, add_special_tokens=False)
        return [np.array(x.ids, "<u4") for x in found]

    def _learn(self, new: list[bytes]) -> None:
        known = self.known
        plain: dict[str, None] = {}
        other: list[str] = []
        joined: list[tuple[bytes, str, str]] = []
        for chunk in new:
            text = chunk.decode()
            word = _PLAIN.fullmatch(text)
            if not word:
                other.append(text)
                continue
            stem, tail = word.groups()
            plain[stem] = None
            if tail:
                joined.append((chunk, stem, tail))
        tails = {t for _, _, t in joined}
        other += [t for t in tails if t.encode() not in known]
        for text, ids in zip(other, self._encode(other)):
            known[text.encode()] = ids.tobytes()
        words = [w for w in map(str.encode, plain) if w not in known]
        if words:
            ids = self._encode([b" ".join(words).decode()])[0]
            cuts = (4 * (np.flatnonzero(self.ends[ids]) + 1)).tolist()
            flat = ids.tobytes()
            known.update(zip(words, (flat[s:e] for s, e in zip([0, *cuts], cuts)), strict=True))
        for chunk, stem, tail in joined:
            known[chunk] = known[stem.encode()] + known[tail.encode()]

    def __call__(self, rows: list[bytes]) -> list[bytes]:
        chunks = [self._chunks(x) for x in rows]
        if len(self.known) > self.most:
            self.known.clear()
        self._learn(list(set().union(*chunks).difference(self.known)))
        return [b"".join(map(self.known.__getitem__, c)) for c in chunks]


def pack(
    docs: DataFrame,
    path: str,
    key: str = "doc_id",
    text: str = "text",
    capacity: int = 2048,
    piece: int = 512,
    end_id: int = 1,
    group: int = 2 << 20,
) -> DataFrame:
    """Pieces of tokenized documents, each with its place in a window of at most ``capacity`` ids.

    Columns: ``key``, ``start`` (ids of the document before the piece), ``length``, ``ids`` (little-endian
    unsigned 32-bit), ``doc_tokens`` (with ``end_id``, which ends every document), ``sequence_id``, ``offset``
    (in the window, gapless from 0). ``path`` is a vocabulary file on the driver.

    Each task packs its documents in groups of about ``group`` ids, so nothing is shuffled and the memory of a
    task does not grow with the input; window ids carry the task's number. A document gives whole windows and
    a rest in equal parts of at most ``piece`` ids. Null and empty texts have the end id only; equal rows and
    null keys are packed like others; no rows give no rows; further columns are left out.
    """
    with open(path, encoding="utf-8") as f:
        spec = docs.sparkSession.sparkContext.broadcast(f.read())
    schema = T.StructType([docs.schema[key], *T.StructType.fromDDL(", ".join(f"{c} {t}" for c, t in COLUMNS.items())).fields])
    arrow = to_arrow_schema(schema)
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode: Callable[[list[bytes]], list[bytes]] = per_process(("ids", path), lambda: _Ids(spec.value))
        sequence = TaskContext.get().partitionId() << 40
        held: list[tuple[Any, bytes]] = []
        size = 0

        def packed() -> pa.RecordBatch:
            nonlocal sequence
            rows, loose = [], []
            for k, ids in held:
                n = len(ids) // 4
                for s, m in cuts(n, capacity, piece):
                    row = (k, s, m, ids[4 * s : 4 * (s + m)], n)
                    if m == capacity:
                        rows.append((*row, sequence, 0))
                        sequence += 1
                    else:
                        loose.append(row)
            for window in windows([r[2] for r in loose], capacity):
                offset = 0
                for i in window:
                    rows.append((*loose[i], sequence, offset))
                    offset += loose[i][2]
                sequence += 1
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), arrow)], schema=arrow)

        for batch in batches:
            keys = iter(batch.column(key).to_pylist())
            for part in portions(texts(batch.column(text))):
                for ids in encode(part):
                    held.append((next(keys), ids + end))
                    size += len(ids) // 4 + 1
                    if size >= group:
                        yield packed()
                        held, size = [], 0
        if held:
            yield packed()

    return docs.select(key, text).mapInArrow(run, schema)
