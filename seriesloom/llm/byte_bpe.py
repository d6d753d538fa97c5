"""Byte-level BPE by a global shuffle of distinct words, and decoding by a join with the token-byte table."""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Callable, Iterator
from itertools import repeat
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .batches import per_process
from .blockwise import Exploded, by_element, cut, elements, explode, packed, reassemble, text_sizes

_NEVER = 1 << 62
_SHORT = 100


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes to rank from a file of base64 tokens and ranks; every single byte must be a token."""
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, filter(bytes.strip, f))}
    if any(bytes([b]) not in ranks for b in range(256)):
        raise ValueError("a byte without a token: some texts could not be encoded")
    return ranks


def unlike_characters() -> dict[int, str]:
    """Characters that tiktoken and the regex module class differently, each with a stand-in of tiktoken's class.

    The two libraries carry different versions of Unicode. An encoding whose pattern is one class returns the
    characters of that class and skips all others.
    """
    every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    single = {bytes([b]): b for b in range(256)}
    out: dict[int, str] = {}
    theirs: dict[str, set[str]] = {}
    for name, kind in (("letter", r"\p{L}"), ("number", r"\p{N}"), ("space", r"\s")):
        ids = tiktoken.Encoding(name, pat_str=f"{kind}+", mergeable_ranks=single, special_tokens={}).encode_ordinary(every)
        theirs[name] = set(bytes(ids).decode())
        for c in theirs[name] ^ set(regex.findall(kind, every)):
            out[ord(c)] = "!"
    for name, like in (("letter", "a"), ("number", "1"), ("space", "\t")):
        out |= {c: like for c in out if chr(c) in theirs[name]}
    return out


class Splitter:
    """The matches of a pattern in a text, by tiktoken's classes of characters."""

    def __init__(self, pattern: str, unlike: dict[int, str]):
        self.pattern, self.unlike = regex.compile(pattern), unlike
        runs: list[list[int]] = []
        for c in sorted(unlike):
            if runs and c == runs[-1][1] + 1:
                runs[-1][1] = c
            else:
                runs.append([c, c])
        spans = "".join(f"{regex.escape(chr(a))}-{regex.escape(chr(b))}" for a, b in runs)
        self.search = regex.compile(f"[{spans}]").search if spans else lambda text: None

    def __call__(self, text: str) -> list[str]:
        if text.isascii() or not self.search(text):
            return self.pattern.findall(text)
        # the pattern's matches are as long in a text with stand-ins of the same classes
        return [text[m.start() : m.end()] for m in self.pattern.finditer(text.translate(self.unlike))]


def merge(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one word: of all neighbouring pairs that form a token, the one of lowest rank merges first, the
    left one of equal ones, until none does."""
    whole = ranks.get(word)
    if whole is not None:
        return [whole]
    if len(word) > _SHORT:
        return _merge_long(word, ranks)
    parts = [word[i : i + 1] for i in range(len(word))]
    pairs = [ranks.get(a + b, _NEVER) for a, b in zip(parts, parts[1:])]
    while pairs:
        low = min(pairs)
        if low == _NEVER:
            break
        i = pairs.index(low)
        parts[i : i + 2] = [parts[i] + parts[i + 1]]
        del pairs[i]
        if i:
            pairs[i - 1] = ranks.get(parts[i - 1] + parts[i], _NEVER)
        if i < len(pairs):
            pairs[i] = ranks.get(parts[i] + parts[i + 1], _NEVER)
    return [ranks[p] for p in parts]


def _merge_long(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The same for long words: pairs wait in a heap, pieces are linked to their neighbours."""
    n = len(word)
    end = list(range(1, n + 1))  # of the piece that begins here; 0 where none does
    before = list(range(-1, n - 1))
    heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(word[i : i + 2])) is not None]
    heapq.heapify(heap)
    while heap:
        _, i, until = heapq.heappop(heap)
        middle = end[i]
        if not middle or middle >= n or not end[middle] or end[middle] != until:
            continue  # one of the two pieces is another by now
        end[i], end[middle] = until, 0
        if until < n:
            before[until] = i
            if (r := ranks.get(word[i : end[until]])) is not None:
                heapq.heappush(heap, (r, i, end[until]))
        if (p := before[i]) >= 0 and (r := ranks.get(word[p:until])) is not None:
            heapq.heappush(heap, (r, p, until))
    return [ranks[word[i : end[i]]] for i in range(n) if end[i]]


def token_bytes(spark: Any, path: str) -> DataFrame:
    """The token-byte table: ``id`` and ``bytes`` of every token of a rank file. Its size is the vocabulary's."""
    rows = [(i, bytearray(t)) for t, i in read_ranks(path).items()]
    return F.broadcast(spark.createDataFrame(rows, "id int, bytes binary"))


class _Numbers(dict):
    """Words in the order of their first occurrence."""

    def __missing__(self, word: str) -> int:
        number = self[word] = len(self)
        return number


def _exploded(docs: DataFrame, pattern: str, text: str) -> DataFrame:
    unlike = docs.sparkSession.sparkContext.broadcast(unlike_characters())
    kept = [c for c in docs.columns if c != text]

    def make() -> Callable[[pa.RecordBatch], Iterator[Exploded]]:
        split = per_process(("splitter", pattern), lambda: Splitter(pattern, unlike.value))

        def run(batch: pa.RecordBatch) -> Iterator[Exploded]:
            for part in cut(batch, text_sizes(batch.column(text))):
                numbers, parts, ends, total = _Numbers(), [np.zeros(0, np.int32)], [], 0
                for x in part.column(text).to_pylist():
                    if x:
                        parts.append(np.fromiter(map(numbers.__getitem__, split(x)), np.int32))
                        total += len(parts[-1])
                    ends.append(total)
                words = pa.array([w.encode() for w in numbers], pa.binary())
                coded = pa.DictionaryArray.from_arrays(pa.array(np.concatenate(parts)), words)
                yield Exploded(part.select(kept), np.array(ends), coded)

        return run

    return explode(docs, make, "binary", F.octet_length(text))


def _looked_up(docs: DataFrame, path: str, pattern: str, text: str) -> tuple[DataFrame, DataFrame]:
    """The blocks of a table, and the ids of every word of every block, packed. Words are dealt by hash, so that a
    word is encoded once however many blocks have it."""
    blocks = _exploded(docs, pattern, text)
    ranks = docs.sparkSession.sparkContext.broadcast(read_ranks(path))

    def make() -> Callable[[pa.Array], pa.Array]:
        return lambda words: pa.array([merge(w, ranks.value) for w in words.to_pylist()], pa.list_(pa.int32()))

    return blocks, by_element(blocks, make, "ids")


def _gather(values: pa.ChunkedArray, places: np.ndarray) -> pa.Array:
    return values.combine_chunks().take(pa.array(places)) if len(places) else values.combine_chunks().slice(0, 0)


def _spans(taken: pa.Array, ends: np.ndarray) -> tuple[np.ndarray, list[int]]:
    """Where the values of each row end among the flattened values of its elements."""
    offsets = np.asarray(taken.offsets if isinstance(taken, pa.ListArray) else np.frombuffer(taken.buffers()[1], "<i4")[taken.offset : taken.offset + len(taken) + 1])
    stops = offsets[ends] - offsets[0]
    return stops, [0, *stops[:-1].tolist()]


def encode(docs: DataFrame, path: str, pattern: str, text: str = "text", out: str = "ids") -> DataFrame:
    """The other columns of the input with the ids of each text as an array ``out``.

    Every match of ``pattern`` (a word) is encoded for itself by the ranks in ``path``, a file on the driver;
    what the pattern leaves out is dropped, as tiktoken does. Words are exploded with their places in blocks and
    shuffled by word, each distinct word of the corpus is encoded once, and ids go back to their blocks, where
    they are reassembled by place.
    Null and empty texts have no ids. Rows, repeated ones too, come back one to one; a column named like ``out``
    is replaced.
    """
    kept = docs.drop(*[c for c in docs.columns if c.lower() == out.lower() and c != text])
    blocks, found = _looked_up(kept, path, pattern, text)
    schema = T.StructType([f for f in kept.schema.fields if f.name != text]).add(out, T.ArrayType(T.IntegerType()))

    def make() -> Callable[..., dict[str, Any]]:
        def run(block: Exploded, values: pa.Table, places: np.ndarray) -> dict[str, Any]:
            if not len(places):
                return {out: [[]] * len(block.ends)}
            ids = _gather(values["ids"], places)
            stops, _ = _spans(ids, block.ends)
            return {out: pa.ListArray.from_arrays(pa.array([0, *stops], pa.int32()), ids.flatten())}

        return run

    return reassemble(blocks, found, schema, make)


def decode(encoded: DataFrame, path: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """The other columns of the input with the bytes that the ids of each row stand for.

    Distinct ids of a block are joined with the token-byte table and reassembled by place. Bytes need not be
    valid UTF-8. No ids or null give no bytes; an id that the table lacks is an error. A column named like
    ``out`` is replaced.
    """
    kept = encoded.drop(*[c for c in encoded.columns if c.lower() == out.lower() and c != ids])
    others = [c for c in kept.columns if c != ids]

    def split() -> Callable[[pa.RecordBatch], Iterator[Exploded]]:
        def run(batch: pa.RecordBatch) -> Iterator[Exploded]:
            sizes = pc.fill_null(pc.list_value_length(batch.column(ids)), 0).to_numpy(zero_copy_only=False)
            for part in cut(batch, sizes.astype(np.int64) * 4):
                counts = pc.fill_null(pc.list_value_length(part.column(ids)), 0).to_numpy(zero_copy_only=False)
                yield Exploded(part.select(others), np.cumsum(counts, dtype=np.int64), part.column(ids).flatten())

        return run

    blocks = explode(kept, split, "int", F.size(F.coalesce(ids, F.array())) * 4)
    found = elements(blocks, "id").join(token_bytes(encoded.sparkSession, path), "id", "left")
    schema = T.StructType([f for f in kept.schema.fields if f.name != ids]).add(out, "binary")

    def make() -> Callable[..., dict[str, Any]]:
        def run(block: Exploded, values: pa.Table, places: np.ndarray) -> dict[str, Any]:
            if not len(places):
                return {out: [b""] * len(block.ends)}
            if values["bytes"].null_count:
                raise ValueError("an id without a token")
            joined = _gather(values["bytes"], places)
            stops, starts = _spans(joined, block.ends)
            data = memoryview(joined.buffers()[2])
            return {out: [bytes(data[a:b]) for a, b in zip(starts, stops)]}

        return run

    return reassemble(blocks, packed(found.drop("id")), schema, make)


def encode_decode_digests(docs: DataFrame, path: str, pattern: str, text: str = "text") -> DataFrame:
    """The other columns of the input with ``n_tokens``, ``ids_sha256`` (of the ids as little-endian unsigned
    32-bit numbers) and ``decoded_sha256`` (of the decoded bytes), from the ids of each row's words, which are not
    kept. A block decodes where its ids are put together: the token-byte table, which has the vocabulary's size,
    is there as one array, and is read by id. Null and empty texts have no tokens and the digests of nothing;
    columns named like a result are replaced."""
    new = {"n_tokens": "long", "ids_sha256": "string", "decoded_sha256": "string"}
    kept = docs.drop(*[c for c in docs.columns if c.lower() in new and c != text])
    blocks, found = _looked_up(kept, path, pattern, text)
    schema = T.StructType([f for f in kept.schema.fields if f.name != text])
    for name, kind in new.items():
        schema = schema.add(name, kind)
    ranks = docs.sparkSession.sparkContext.broadcast(read_ranks(path))

    def make() -> Callable[..., dict[str, Any]]:
        def table() -> pa.Array:
            tokens = [b""] * (max(ranks.value.values()) + 1)
            for token, i in ranks.value.items():
                tokens[i] = token
            return pa.array(tokens, pa.binary())

        token_of = per_process(("tokens", path), table)

        def digests(data: memoryview, stops: np.ndarray, width: int) -> list[str]:
            starts = [0, *stops[:-1].tolist()]
            return [hashlib.sha256(data[a * width : b * width]).hexdigest() for a, b in zip(starts, stops.tolist())]

        def run(block: Exploded, values: pa.Table, places: np.ndarray) -> dict[str, Any]:
            n = len(block.ends)
            if not len(places):
                nothing = list(repeat(hashlib.sha256().hexdigest(), n))
                return {"n_tokens": [0] * n, "ids_sha256": nothing, "decoded_sha256": nothing}
            taken = _gather(values["ids"], places)
            stops, _ = _spans(taken, block.ends)
            ids = np.ascontiguousarray(taken.flatten().to_numpy(), "<u4")
            decoded = token_of.take(pa.array(ids))
            until, _ = _spans(decoded, stops)
            return {
                "n_tokens": np.diff(stops, prepend=0),
                "ids_sha256": digests(memoryview(ids).cast("B"), stops, 4),
                "decoded_sha256": digests(memoryview(decoded.buffers()[2]), until, 1),
            }

        return run

    return reassemble(blocks, found, schema, make)
