"""Byte-pair encoding by backtracking over longest matches, and decoding with an offset table."""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Callable, Mapping
from typing import Any

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from tokenizers import Tokenizer

from .batches import per_process, texts, with_computed

_END = "\0"  # stands for the vocabulary's end-of-word mark; byte symbols never use it
_NEVER = 1 << 62
#: Characters beyond U+017F, whose classes and compositions depend on the version of Unicode.
_FOREIGN = re.compile("[^\0-\u017f]")


def _byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(other)) for b in range(256)]


class Vocabulary:
    """Tables of one vocabulary file: matches, merges, pair compatibility and the text of every id."""

    def __init__(self, spec: str):
        data = json.loads(spec)
        model = data["model"]
        suffix = model["end_of_word_suffix"]
        steps = [n["type"] for n in (data["normalizer"] or {}).get("normalizers", [])]
        split = (data["pre_tokenizer"] or {}).get("pretokenizers", [{}])[0]
        if model["type"] != "BPE" or not suffix or steps != ["NFC", "Replace", "Lowercase"] or split["type"] != "Split":
            raise ValueError("only lower-cased byte-level BPE with an end-of-word mark is read here")
        ids: dict[str, int] = model["vocab"]
        self.special = {t["content"]: t["id"] for t in data["added_tokens"]}
        self.texts = {**{i: t for t, i in ids.items()}, **{i: t for t, i in self.special.items()}}
        self.n = max(self.texts) + 1
        self.symbols = _byte_symbols()
        self.pattern = regex.compile(split["pattern"]["Regex"])
        library = Tokenizer.from_str(spec)
        self.normalise, self.split = library.normalizer.normalize_str, library.pre_tokenizer.pre_tokenize_str
        self.specials = regex.compile("|".join(map(regex.escape, self.special))) if self.special else None

        self.left, self.right = list(range(self.n)), list(range(self.n))
        self.rank = [-1] * self.n
        self.merged: dict[tuple[int, int], int] = {}
        for rank, merge in enumerate(model["merges"]):
            a, b = (ids[x] for x in (merge.split(" ") if isinstance(merge, str) else merge))
            whole = ids[self.texts[a] + self.texts[b]]
            self.merged[a, b] = rank
            self.left[whole], self.right[whole], self.rank[whole] = a, b, rank
        self.fits: dict[int, bool] = {}

        # tokens that their own text encodes to; others are never produced
        words = {
            t[: -len(suffix)] + _END if t.endswith(suffix) and t != suffix else t: i
            for t, i in ids.items()
            if self.rank[i] < 0 or self._unmerged(self.left[i], self.right[i], self.rank[i])
        }
        self.size = {i: len(w) for w, i in words.items()}
        self.shorter: dict[int, int] = {}
        for w, i in words.items():
            for k in range(len(w) - 1, 0, -1):
                if w[:k] in words:
                    self.shorter[i] = words[w[:k]]
                    break
        self.matches = ahocorasick.Automaton()
        for w, i in words.items():
            self.matches.add_word(w, i)
        self.matches.make_automaton()
        self.words: dict[str, bytes] = {}

    def _unmerged(self, x: int, y: int, until: int = _NEVER) -> bool:
        """Whether x and y stay apart, when their texts are encoded side by side, until merge ``until``.

        Goes back in time from the finished tokens. The pieces at the seam meet until a merge uses one of them;
        a merge across the seam would come first if it ranks lower. Of equal merges the left one goes first.
        """
        left_used = right_used = until
        while True:
            across = self.merged.get((x, y), _NEVER)
            if across < left_used and (across < right_used or across == right_used != until):
                return False
            if self.rank[x] < 0 and self.rank[y] < 0:
                return True
            if self.rank[x] > self.rank[y]:
                x, left_used = self.right[x], self.rank[x]
            else:
                y, right_used = self.left[y], self.rank[y]

    def compatible(self, x: int, y: int) -> bool:
        """The table of token pairs that may follow each other, filled as pairs come up."""
        key = x << 32 | y
        found = self.fits.get(key)
        if found is None:
            found = self.fits[key] = self._unmerged(x, y)
        return found

    def merge(self, word: str) -> list[int]:
        """Ids of a word in byte symbols: the only sequence of compatible tokens, found from the left with the
        longest match first, shorter matches next, and a step back where none fits."""
        word += _END
        size, shorter, end = self.size, self.shorter, len(word)
        longest = [-1] * (end + 1)
        for last, token in self.matches.iter(word):  # longer matches of a place come later
            longest[last + 1 - size[token]] = token
        open_at = [True] * (end + 1)
        open_at[end - 1] = False  # the mark belongs to the last byte
        out: list[int] = []
        at, token = 0, longest[0]
        while at < end:
            following = at + size[token]
            if open_at[following] and (not out or self.compatible(out[-1], token)):
                out.append(token)
                at, token = following, longest[following]
            elif token in shorter:
                token = shorter[token]
            else:
                open_at[at] = False
                token = out.pop()
                at -= size[token]
        return out

    def chunk(self, data: bytes) -> bytes:
        """Little-endian 32-bit ids of text without ASCII white space.

        Characters up to U+017F are lower-cased and split into words here. For others the library's normaliser
        and splitter are asked, so that both go by one version of Unicode.
        """
        text = data.decode()
        if _FOREIGN.search(text):
            words = [w for w, _ in self.split(self.normalise(text))]
        else:
            words = ["".join([self.symbols[b] for b in w.encode()]) for w in self.pattern.findall(text.lower())]
        out = []
        for word in words:
            ids = self.words.get(word)
            if ids is None:
                ids = self.words[word] = np.array(self.merge(word), "<u4").tobytes()
            out.append(ids)
        return b"".join(out)


class _Chunks(dict):
    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary

    def __missing__(self, data: bytes) -> bytes:
        ids = self[data] = self.vocabulary.chunk(data)
        return ids


class Encoder:
    """Ids of whole texts; what it remembers of words is bounded by ``most`` entries a table."""

    def __init__(self, vocabulary: Vocabulary, most: int = 400_000):
        self.vocabulary, self.most = vocabulary, most
        self.chunks = _Chunks(vocabulary)

    def _plain(self, text: str) -> bytes:
        if not _FOREIGN.search(text):
            text = text.lower()  # fewer different pieces
        return b"".join(map(self.chunks.__getitem__, text.encode().split()))

    def __call__(self, text: str) -> np.ndarray:
        v = self.vocabulary
        for held in (self.chunks, v.words, v.fits):
            if len(held) > self.most:
                held.clear()
        if v.specials is None or not v.specials.search(text):
            return np.frombuffer(self._plain(text), "<u4")
        out, at = [], 0
        for m in v.specials.finditer(text):
            out += [self._plain(text[at : m.start()]), np.array([v.special[m[0]]], "<u4").tobytes()]
            at = m.end()
        return np.frombuffer(b"".join([*out, self._plain(text[at:])]), "<u4")


class OffsetTable:
    """Texts of all ids in one buffer with the place where each begins; joins texts of many ids at once."""

    def __init__(self, entries: list[bytes]):
        self.data = np.frombuffer(b"".join(entries), np.uint8)
        self.sizes = np.fromiter(map(len, entries), np.int64, len(entries))
        self.starts = np.cumsum(self.sizes) - self.sizes

    def __call__(self, ids: np.ndarray) -> bytes:
        sizes = self.sizes[ids]
        ends = np.cumsum(sizes)
        total = int(ends[-1]) if len(ids) else 0
        return self.data[np.repeat(self.starts[ids] - ends + sizes, sizes) + np.arange(total)].tobytes()


def decoding_table(vocabulary: Vocabulary, separator: str = " ") -> OffsetTable:
    """The file names no decoder, so texts of tokens are joined by a space, which each entry carries."""
    return OffsetTable([(vocabulary.texts.get(i, "") + separator).encode() for i in range(vocabulary.n)])


def _tools(spec: str) -> tuple[Encoder, OffsetTable, OffsetTable]:
    v = Vocabulary(spec)
    return Encoder(v), decoding_table(v), OffsetTable([f"{i} ".encode() for i in range(v.n)])


def encode(docs: DataFrame, path: str, text: str = "text", out: str = "ids") -> DataFrame:
    """The input with the ids of each text as little-endian unsigned 32-bit numbers in one binary value.

    ``path`` is a vocabulary file on the driver; its content goes to the executors once. The result is that of
    the tokenizers library without special tokens added; their strings in a text become their ids. Null and
    empty texts have no ids; a column named like ``out`` is replaced.
    """
    with open(path, encoding="utf-8") as f:
        spec = docs.sparkSession.sparkContext.broadcast(f.read())

    def make() -> Callable[[pa.RecordBatch], Mapping[str, Any]]:
        encoder = per_process(("bpe", path), lambda: _tools(spec.value))[0]
        return lambda batch: {out: [encoder(x.decode()).tobytes() for x in texts(batch.column(text))]}

    return with_computed(docs, {out: "binary"}, make)


def decode(encoded: DataFrame, path: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """The input with the text that its ids decode to, special tokens included; no ids give an empty text."""
    with open(path, encoding="utf-8") as f:
        spec = encoded.sparkSession.sparkContext.broadcast(f.read())

    def make() -> Callable[[pa.RecordBatch], Mapping[str, Any]]:
        table = per_process(("bpe", path), lambda: _tools(spec.value))[1]
        return lambda batch: {
            out: [table(np.frombuffer(x, "<u4"))[:-1].decode() for x in texts(batch.column(ids))]
        }

    return with_computed(encoded, {out: "string"}, make)


def encode_decode_digests(docs: DataFrame, path: str, text: str = "text", block: int = 1 << 17) -> DataFrame:
    """The input with ``n_tokens``, ``ids_sha256`` (of the decimal ids joined by one space) and
    ``decoded_sha256`` (of the decoded text), made from the ids and the decoded text of ``encode`` and
    ``decode`` without keeping them. Null and empty texts have no tokens and the digest of nothing."""
    with open(path, encoding="utf-8") as f:
        spec = docs.sparkSession.sparkContext.broadcast(f.read())

    def make() -> Callable[[pa.RecordBatch], Mapping[str, Any]]:
        encoder, plain, decimal = per_process(("bpe", path), lambda: _tools(spec.value))

        def digest(table: OffsetTable, ids: np.ndarray) -> str:
            whole = hashlib.sha256()
            for i in range(0, len(ids), block):
                part = table(ids[i : i + block])
                whole.update(part if i + block < len(ids) else part[:-1])
            return whole.hexdigest()

        def compute(batch: pa.RecordBatch) -> Mapping[str, Any]:
            n, a, b = [], [], []
            for x in texts(batch.column(text)):
                ids = encoder(x.decode())
                n.append(len(ids))
                a.append(digest(decimal, ids))
                b.append(digest(plain, ids))
            return {"n_tokens": n, "ids_sha256": a, "decoded_sha256": b}

        return compute

    return with_computed(docs, {"n_tokens": "long", "ids_sha256": "string", "decoded_sha256": "string"}, make)
