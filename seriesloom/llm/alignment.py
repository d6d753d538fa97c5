"""Alignment of two tokenizers' tokens of the same texts by skipping along diagonals."""

from __future__ import annotations

import hashlib
import json
import os
from collections.abc import Callable, Iterator, Mapping
from itertools import accumulate
from typing import Any, NamedTuple

import numpy as np
import pyarrow as pa
import sentencepiece
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

from .batches import per_process, with_computed
from .blockwise import Exploded, cut, elements, explode, occurrences, packed, reassemble, text_sizes
from .bpe import _FOREIGN, _byte_symbols
from .storing import stored
from .token_counts import SPLIT

_SHIFT = 20  # an id pair is one number: A's id, then 20 bits of B's
_WIDE = 4096  # links of a group that are listed one by one


def diagonal_groups(a: list[int], b: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Where groups end, as numbers of tokens of A and of B, for two rising lists of token ends with equal last
    ends.

    While tokens end together, A's token i meets B's token i + shift: stretches of doubling length are compared
    at that shift and jumped over, then halved down to the first difference. There A and B advance token by
    token, whichever is behind, until they end together again; that is one group, and it sets the new shift.
    """
    i = j = 0
    n = len(a)
    a_ends, b_ends, lengths = [], [], []
    while i < n:
        start, step = i, 4
        while i + step <= n and a[i : i + step] == b[j : j + step]:
            i += step
            j += step
            step *= 2
        while step > 1:  # less than the last stretch is left to jump
            step //= 2
            if i + step <= n and a[i : i + step] == b[j : j + step]:
                i += step
                j += step
        if i > start:
            a_ends.append(i)
            b_ends.append(j)
            lengths.append(i - start)
            if i == n:
                break
        x, y = a[i], b[j]
        while x != y:
            if x < y:
                i += 1
                x = a[i]
            else:
                j += 1
                y = b[j]
        i += 1
        j += 1
        a_ends.append(i)
        b_ends.append(j)
        lengths.append(1)
    runs = np.array(lengths, np.int64)
    within = np.arange(runs.sum()) - np.repeat(np.cumsum(runs) - runs, runs) + 1
    return (np.repeat(np.array(x, np.int64) - runs, runs) + within for x in (a_ends, b_ends))


def group_links(a: np.ndarray, b: np.ndarray, a_ends: np.ndarray, b_ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct id pairs of all links of a text, and how many links each has.

    Every token of A in a group is linked to every token of B in it. Wide groups are counted by their distinct
    ids, so that a group of many equal tokens costs no list of all its links.
    """
    n_a, n_b = np.diff(a_ends, prepend=0), np.diff(b_ends, prepend=0)
    links = n_a * n_b
    listed = links <= _WIDE
    per_a = np.repeat(np.where(listed, n_b, 0), n_a)  # links of each token of A
    left = np.repeat(np.arange(len(a)), per_a)
    first = np.repeat(np.repeat(b_ends - n_b, n_a), per_a)
    pairs = a[left].astype(np.int64) << _SHIFT | b[first + np.arange(len(left)) - np.repeat(np.cumsum(per_a) - per_a, per_a)]
    found, counts = np.unique(pairs, return_counts=True)
    if not listed.all():
        parts, weights = [found], [counts]
        for g in np.flatnonzero(~listed):
            x, k = np.unique(a[a_ends[g] - n_a[g] : a_ends[g]], return_counts=True)
            y, m = np.unique(b[b_ends[g] - n_b[g] : b_ends[g]], return_counts=True)
            parts.append((x.astype(np.int64)[:, None] << _SHIFT | y).ravel())
            weights.append(np.outer(k, m).ravel())
        found, place = np.unique(np.concatenate(parts), return_inverse=True)
        counts = np.bincount(place, np.concatenate(weights), len(found)).astype(np.int64)
    return found, counts


class Tokens(NamedTuple):
    """Ids of both tokenizers and, after each token, the bytes so far."""

    a: np.ndarray
    b: np.ndarray
    a_ends: list[int]
    b_ends: list[int]


def _as_ranks(data: dict, texts: dict[int, bytes]) -> tiktoken.Encoding | None:
    """The same encoding for tiktoken, which is faster, if the file is plain byte-level BPE with merges in the order
    of ids. The libraries class characters beyond U+017F by different versions of Unicode, so it serves texts
    without them."""
    model, split = data["model"], data["pre_tokenizer"] or {}
    ids = [model["vocab"]["".join(m.split(" ") if isinstance(m, str) else m)] for m in model["merges"]]
    plain = split.get("type") == "ByteLevel" and not split.get("add_prefix_space") and split.get("use_regex", True)
    if not plain or data["normalizer"] or model.get("ignore_merges") or ids != sorted(set(ids)):
        return None
    special = {t["id"] for t in data["added_tokens"]}
    ranks = {t: i for i, t in texts.items() if i not in special}
    return tiktoken.Encoding("fast", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})


class Tokenizers:
    """A byte-level tokenizer (A) and a sentencepiece model that puts a space before a text (B)."""

    def __init__(self, spec_a: str, model_b: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.a = Tokenizer.from_str(spec_a)
        self.a.encode_special_tokens = True
        data = json.loads(spec_a)
        byte = {s: b for b, s in enumerate(_byte_symbols())}
        ids: dict[str, int] = data["model"]["vocab"]
        special = {t["id"]: t["content"].encode() for t in data["added_tokens"]}
        texts = {i: bytes(byte[c] for c in t) for t, i in ids.items() if all(c in byte for c in t)} | special
        self.a_bytes = [texts.get(i, b"") for i in range(max(texts) + 1)]
        self.b = sentencepiece.SentencePieceProcessor(model_proto=model_b)
        size = self.b.get_piece_size()
        pieces = [self.b.id_to_piece(i) for i in range(size)]
        self.b_bytes = [bytes([int(p[3:-1], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        self.fast = _as_ranks(data, texts)
        self.a_sizes, self.b_sizes = list(map(len, self.a_bytes)), list(map(len, self.b_bytes))
        decimal_a = [b"%d" % i for i in range(len(self.a_bytes))]
        decimal_b = [b"%d" % i for i in range(size)]
        #: ids as the digest writes them: inside a group, then at the end of A's and of B's part
        self.written = [x + end for ids, ends in ((decimal_a, (b",", b"|")), (decimal_b, (b",", b";"))) for end in ends for x in ids]

    def __call__(self, texts: list[str]) -> Iterator[Tokens | None]:
        """Tokens of each text; None where either tokenizer's bytes are not a space and the text."""
        spaced = [" " + x for x in texts]
        for text, b in zip(spaced, self.b.encode(texts, num_threads=1)):
            if self.fast is not None and not _FOREIGN.search(text):
                a = self.fast.encode_ordinary(text)
            else:
                a = self.a.encode(text, add_special_tokens=False).ids
            whole = text.encode()
            if b"".join(map(self.a_bytes.__getitem__, a)) != whole or b"".join(map(self.b_bytes.__getitem__, b)) != whole:
                yield None
                continue
            ends = (list(accumulate(map(sizes.__getitem__, x))) for sizes, x in ((self.a_sizes, a), (self.b_sizes, b)))
            yield Tokens(np.array(a, np.int64), np.array(b, np.int64), *ends)

    def digest(self, tokens: Tokens, a_ends: np.ndarray, b_ends: np.ndarray) -> str:
        """SHA-256 of all groups written as ``a1,a2|b1;a3|b2,b3``."""
        n_a, n_b = len(self.a_bytes), len(self.b_bytes)
        a, b = tokens.a.copy(), tokens.b + 2 * n_a  # places in ``written``
        a[a_ends - 1] += n_a
        b[b_ends - 1] += n_b
        parts = np.empty(len(a) + len(b), np.int64)
        # a token comes after all tokens of its own side before it and those of the other side's earlier groups
        group_a = np.repeat(np.arange(len(a_ends)), np.diff(a_ends, prepend=0))
        group_b = np.repeat(np.arange(len(b_ends)), np.diff(b_ends, prepend=0))
        parts[np.arange(len(a)) + np.concatenate([[0], b_ends])[group_a]] = a
        parts[np.arange(len(b)) + a_ends[group_b]] = b
        return hashlib.sha256(b"".join(map(self.written.__getitem__, parts.tolist()))[:-1]).hexdigest()


def _tools(docs: DataFrame, path_a: str, path_b: str) -> Callable[[], Tokenizers]:
    with open(path_a, encoding="utf-8") as f:
        spec = docs.sparkSession.sparkContext.broadcast(f.read())
    with open(path_b, "rb") as g:
        model = docs.sparkSession.sparkContext.broadcast(g.read())
    return lambda: per_process(("alignment", path_a, path_b), lambda: Tokenizers(spec.value, model.value))


def align(docs: DataFrame, path_a: str, path_b: str, text: str = "text") -> DataFrame:
    """The input with ``ids_a`` and ``ids_b``, and ``ends_a`` and ``ends_b``: for each group the number of A's and
    B's tokens up to its end.

    A group ends where tokens of both end at the same byte. Tokenizer A (a tokenizers file) reads a space and the
    text, B (a sentencepiece model) the text, to which it adds the space; special tokens' strings are plain text.
    Null and empty texts, and texts that either tokenizer does not give back byte by byte, have no tokens. Columns
    named like a result are replaced.
    """
    tools = _tools(docs, path_a, path_b)
    new = {n: "array<int>" for n in ("ids_a", "ids_b", "ends_a", "ends_b")}

    def make() -> Callable[[pa.RecordBatch], Mapping[str, Any]]:
        both = tools()

        def run(batch: pa.RecordBatch) -> Mapping[str, Any]:
            out: dict[str, list] = {n: [] for n in new}
            for tokens in both([x or "" for x in batch.column(text).to_pylist()]):
                if tokens is None or not len(tokens.b):
                    row = ([], [], [], [])
                else:
                    row = (tokens.a, tokens.b, *diagonal_groups(tokens.a_ends, tokens.b_ends))
                for name, value in zip(new, row):
                    out[name].append(value)
            return out

        return run

    return with_computed(docs, new, make)


COLUMNS = {"n_a": "long", "n_b": "long", "n_groups": "long", "n_links": "long", "n_best": "long", "count_sum": "long"}


def pair_counts(blocks: DataFrame) -> DataFrame:
    """``pair``, its ``id_a`` and ``id_b``, ``n`` (documents that hold it linked) and ``best`` (whether n is the
    highest of its A id, ties included), from the blocks of ``alignment_scores``.

    The highest counts are one row for each id of A, at most the vocabulary, and are broadcast.
    """
    found = stored(occurrences(blocks, "pair").withColumn("id_a", F.shiftright("pair", _SHIFT).cast("int")))
    highest = found.groupBy("id_a").agg(F.max("n").alias("most"))
    return found.join(F.broadcast(highest), "id_a").select(
        "pair", "id_a", F.col("pair").bitwiseAND((1 << _SHIFT) - 1).cast("int").alias("id_b"), "n", (F.col("n") == F.col("most")).alias("best")
    )


def aligned_blocks(docs: DataFrame, path_a: str, path_b: str, text: str = "text") -> DataFrame:
    """Blocks of aligned texts: each row's figures, digest and links, its distinct id pairs as elements."""
    tools = _tools(docs, path_a, path_b)
    kept = [c for c in docs.columns if c != text]

    def make() -> Callable[[pa.RecordBatch], Iterator[Exploded]]:
        both = tools()

        def run(batch: pa.RecordBatch) -> Iterator[Exploded]:
            for part in cut(batch, text_sizes(batch.column(text))):
                figures: list[tuple] = []
                pairs, links, ends, total = [], [], [], 0
                column = part.column(text)
                for piece in cut(part.select([text]), text_sizes(column), 1 << 20):  # encodings are large
                    for tokens in both([x or "" for x in piece.column(0).to_pylist()]):
                        if tokens is None or not len(tokens.b):
                            figures.append((0, 0, 0, 0, ""))
                        else:
                            a_ends, b_ends = diagonal_groups(tokens.a_ends, tokens.b_ends)
                            p, w = group_links(tokens.a, tokens.b, a_ends, b_ends)
                            pairs.append(p)
                            links.append(w)
                            total += len(p)
                            sizes = len(tokens.a), len(tokens.b), len(a_ends), int(w.sum())
                            figures.append((*sizes, both.digest(tokens, a_ends, b_ends)))
                        ends.append(total)
                arrays = [part.column(c) for c in kept]
                arrays += [pa.array(x, k) for x, k in zip(zip(*figures), [pa.int64()] * 4 + [pa.string()])]
                weights = pa.ListArray.from_arrays(pa.array([0, *ends], pa.int32()), pa.array(np.concatenate(links) if links else [], pa.int64()))
                rows = pa.RecordBatch.from_arrays([*arrays, weights], [*kept, *_FIGURES, "links"])
                yield Exploded(rows, np.array(ends), pa.array(np.concatenate(pairs) if pairs else [], pa.int64()))

        return run

    return explode(docs, make, "long", F.octet_length(text))


_FIGURES = ["n_a", "n_b", "n_groups", "n_links", "groups_sha256"]


def alignment_scores(docs: DataFrame, path_a: str, path_b: str, text: str = "text") -> DataFrame:
    """The other columns of the input with ``n_a``, ``n_b``, ``n_groups``, ``n_links``, ``n_best`` (links whose
    count is the highest of their A id), ``count_sum`` (of the counts of all links) and ``groups_sha256``.

    The count of an id pair is the number of rows that hold it linked; repeated rows count each. Rows are cut
    into groups as in ``align``; those without tokens get zeros and an empty string. Pairs are looked up once for
    each block of rows that holds them. Columns named like a result, or ``links``, are replaced.
    """
    new = {**COLUMNS, "groups_sha256": "string"}
    kept = docs.drop(*[c for c in docs.columns if c.lower() in (*new, "links") and c != text])
    blocks = aligned_blocks(kept, path_a, path_b, text)
    counts = pair_counts(blocks).select("pair", "n", "best")
    found = elements(blocks, "pair").join(counts, "pair").drop("pair")
    schema = T.StructType([f for f in kept.schema.fields if f.name != text])
    for name, kind in new.items():
        schema = schema.add(name, kind)

    def make() -> Callable[..., dict[str, Any]]:
        def run(block: Exploded, values: pa.Table, places: np.ndarray) -> dict[str, Any]:
            if not len(places):
                return {"n_best": [0] * len(block.ends), "count_sum": [0] * len(block.ends)}
            links = block.rows["links"].flatten().to_numpy()
            n = values["n"].to_numpy()[places]
            best = values["best"].to_numpy(zero_copy_only=False)[places]
            before = np.concatenate([[0], block.ends])
            best_links = np.concatenate([[0], np.cumsum(links * best)])[before]
            counted = np.concatenate([[0], np.cumsum(links * n)])[before]
            return {"n_best": np.diff(best_links), "count_sum": np.diff(counted)}

        return run

    return reassemble(blocks, packed(found), schema, make)
