"""Near-duplicate lines by a segment-partition edit join, with Spark's own functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .batches import free_name
from .components import components
from .storing import sent_whole, stored

_SOON = 32
_BLOCK = 16  # characters in a block of the hashes that find where two lines begin to differ


def _cut(n: Column, i: int, parts: int) -> Column:
    return F.floor(n * i / parts).cast("int")


def _char(text: Column, i: Column) -> Column:
    """The i-th character, from 0, of a text in UTF-32."""
    return F.substring(text, 4 * i + 1, F.lit(4))


def _size(text: Column) -> Column:
    return F.shiftright(F.octet_length(text), 2)


def within_edits(a: Column, b: Column, edits: int, skip: Column | None = None) -> Column:
    """Whether two texts in UTF-32 are within ``edits`` insertions, deletions and replacements.

    Bit p of the d-th number tells whether the first j - edits + p characters of ``a`` and the first j of ``b``
    are within d edits; only these 2 edits + 1 diagonals can matter. All bits of a column come from the column
    before by shifts: a match keeps d, a replacement, an insertion or a deletion takes a bit of d - 1. Once no
    bit is left, the columns that follow are passed over. The first ``skip`` characters are known to be equal.
    The numbers lie side by side in one, the d-th at bit d (2 edits + 1).
    """
    skip = F.lit(0) if skip is None else skip
    width = 2 * edits + 1
    band = (1 << width) - 1

    def column(state: Column, j: Column) -> Column:
        own = _char(b, j)
        hits = F.lit(0).cast("long")
        for p in range(width):
            i = j - edits + p
            hits = hits + F.when((i >= skip) & (_char(a, i) == own), F.lit(1 << p).cast("long")).otherwise(F.lit(0).cast("long"))

        def step(match: Column) -> Column:
            new, all_new = None, F.lit(0).cast("long")
            for d in range(edits + 1):
                old = F.shiftright(state, d * width).bitwiseAND(F.lit(band))
                bits = old.bitwiseAND(match)
                if d:
                    below = F.shiftright(state, (d - 1) * width).bitwiseAND(F.lit(band))
                    bits = bits.bitwiseOR(below).bitwiseOR(F.shiftright(below, 1)).bitwiseOR(F.shiftleft(new, 1))
                new = bits.bitwiseAND(F.lit(band))
                all_new = all_new.bitwiseOR(F.shiftleft(new, d * width))
            return all_new

        # the matches are made once and handed on as the only element of an array
        return F.when(state == 0, state).otherwise(F.get(F.transform(F.array(hits), step), F.lit(0)))

    # before the first of b's characters, i characters of a are i edits
    start = sum((sum(1 << (edits + i) for i in range(d + 1)) & band) << d * width for d in range(edits + 1))
    size_a, size_b = _size(a), _size(b)
    none = F.array().cast("array<int>")

    def after(state: Column, first: Column, stop: Column) -> Column:
        ahead = (state != 0) & (stop > first)
        return F.aggregate(F.when(ahead, F.sequence(first, stop - 1)).otherwise(none), state, column)

    # most pairs that are no link end within a few columns
    soon = F.array(after(F.lit(start).cast("long"), skip, F.least(size_b, skip + _SOON)))
    end = F.get(F.transform(soon, lambda state: after(state, skip + _SOON, size_b)), F.lit(0))
    last = F.shiftright(end, edits * width).bitwiseAND(F.lit(band))
    bit = F.element_at(F.array(*[F.lit(1 << p) for p in range(width)]), size_a - size_b + edits + 1)
    return F.when(F.abs(size_a - size_b) <= edits, last.bitwiseAND(bit) != 0).otherwise(False)


def _alike(x: Column, y: Column) -> Column:
    """Characters at the beginning that two lines share, in whole blocks."""
    same = F.zip_with(x["blocks"], y["blocks"], lambda u, v: u.eqNullSafe(v))
    first = F.array_position(same, False).cast("int")
    return F.when(first > 0, (first - 1) * _BLOCK).otherwise(F.least(F.size(x["blocks"]), F.size(y["blocks"])) * _BLOCK)


def edit_links(lines: DataFrame, edits: int = 2, min_chars: int = 30, chunk: int = 64) -> DataFrame:
    """Links ``a`` - ``b`` between rows of ``lines`` (``id``, ``line``, distinct) within ``edits`` edits.

    A line is cut into edits + 1 segments, of which one stays as it is under that many edits. Each line stands
    in an index under its length and each segment, and looks up, for every length it can reach by deletions,
    the substrings that can be that segment: the edits left and right of a kept segment limit its shift. Only
    keys that lines meet under go on. The index lines of a key come in arrays of about ``chunk``, and each line
    that looks the key up verifies one array at a time with ``within_edits``, so lines that share a segment
    with many others give as many rows as there are arrays, and only links become rows of their own. Lines
    under ``min_chars`` code points link with nothing.
    """
    parts = edits + 1
    n = F.char_length("line")
    long = lines.where(n >= max(min_chars, parts)).select("id", "line", n.alias("n"))
    at = F.col("n")

    def entry(of_index: bool, fits: Column, length: Column, i: int, start: Column, size: Column) -> Column:
        key = F.xxhash64(length, F.lit(i), F.substring("line", start + 1, size))
        return F.when(fits, F.struct(key.alias("key"), F.lit(of_index).alias("of_index"), F.lit(i > 0).alias("later")))

    entries = []
    for shorter in range(edits + 1):
        length = at - shorter
        for i in range(parts):
            start, end = _cut(length, i, parts), _cut(length, i + 1, parts)
            if not shorter:
                entries.append(entry(True, F.lit(True), length, i, start, end - start))
            for shift in range(max(-i, shorter - (edits - i)), min(i, shorter + edits - i) + 1):
                if not shorter and not shift:
                    continue  # its own place in the index, where equal-length lines meet it
                first = start + shift
                fits = (length >= max(min_chars, parts)) & (first >= 0) & (first + end - start <= at)
                entries.append(entry(False, fits, length, i, first, end - start))
    rows = long.select("id", F.explode(F.array_compact(F.array(*entries))).alias("e")).select("id", "e.*")
    group = Window.partitionBy("key")
    met = rows.select(
        "*",
        F.min("id").over(group).alias("low"),
        F.max("id").over(group).alias("high"),
        F.count_if("of_index").over(group).alias("indexed"),
    ).where("low < high and indexed > 0")
    met = stored(met.select("key", "id", "of_index", "later", F.ceil(F.col("indexed") / chunk).cast("int").alias("chunks")))

    needed = stored(met.select("id").distinct())
    code = F.encode("line", "UTF-32").alias("code")
    block = F.transform(
        F.sequence(F.lit(0), F.floor(F.char_length("line") / _BLOCK).cast("int")),
        lambda i: F.xxhash64(F.substring("code", 4 * _BLOCK * i + 1, F.lit(4 * _BLOCK))),
    )
    written = stored(
        lines.join(sent_whole(needed), "id", "left_semi")
        .select("id", "line", code)
        .select("id", F.struct("code", block.alias("blocks")).alias("text"))
    )
    index = met.where("of_index").join(written, "id").withColumn("chunk", F.pmod(F.xxhash64("id"), F.col("chunks")).cast("int"))
    index = index.groupBy("key", "chunk").agg(F.collect_list(F.struct("id", "text")).alias("held"))
    probes = met.select("key", "id", "of_index", "later", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"))
    met_again = probes.join(written, "id").join(index, ["key", "chunk"])

    def linked(x: Column) -> Column:
        y = F.col("text")
        # of two lines in the index the later one looks the other up
        other = F.when(F.col("of_index"), x["id"] < F.col("id")).otherwise(x["id"] != F.col("id"))

        def verified(alike: Column) -> Column:
            # lines that begin with the same segment meet under it, and are verified there
            met_before = F.col("later") & (alike >= _cut(_size(x["text"]["code"]), 1, parts))
            return ~met_before & within_edits(x["text"]["code"], y["code"], edits, alike)

        return other & F.get(F.transform(F.array(_alike(x["text"], y)), verified), F.lit(0))

    found = F.filter("held", linked)
    links = met_again.select("id", F.explode(F.transform(found, lambda x: x["id"])).alias("other"))
    return links.select(F.least("id", "other").alias("a"), F.greatest("id", "other").alias("b")).distinct()


def line_dedup(
    docs: DataFrame, key: str = "doc_id", text: str = "text", edits: int = 2, min_chars: int = 30, short_chars: int = 10
) -> DataFrame:
    """The input with ``text`` cut to first lines, and ``n_lines`` and ``n_removed``.

    Lines end at a line feed. Lines that are equal, or lead to each other over lines within the edits that their
    length allows, are one class: ``edits`` from ``min_chars`` code points, one less from ``short_chars``, none
    below; of two lines the shorter one decides. Blank lines under ``min_chars`` stay, and with no ``edits`` at
    all lines under it stay. A class stays in the document with the smallest key that has one of its lines, at its first
    place there, and is removed everywhere else.

    Equal lines are counted before anything is compared. Rows with the same key and text share their fate;
    null keys come after all others, and where a class has only those each row keeps its first line of it.
    Null texts stay null with no lines; an empty text is one empty line; no rows give no rows; columns
    ``n_lines`` and ``n_removed`` are replaced.
    """
    lines_of = F.split(F.col(text), "\n")
    marked = docs.select(F.col(key).alias("key"), F.xxhash64(text).alias("hash"), F.posexplode(lines_of).alias("place", "line"))
    n, words = F.char_length("line"), F.col("line").rlike(r"[^\x20\x09-\x0D]")
    marked = marked.where((n >= min_chars) | F.lit(edits > 0) & words)
    counted = marked.groupBy("line").agg(F.min("key").alias("first"), F.count(F.lit(1)).alias("times"))
    lines = stored(counted.withColumn("id", F.monotonically_increasing_id()))

    links = edit_links(lines.select("id", "line"), edits, min_chars)
    if edits > 1 and short_chars < min_chars:
        short = stored(lines.where(F.char_length("line").between(short_chars, min_chars + edits - 2)).select("id", "line"))
        links = links.union(edit_links(short, edits - 1, short_chars))
    classes = components(links).toDF("id", "class")
    classes = stored(classes)
    known = lines.join(sent_whole(classes), "id", "left").where("times > 1 or class is not null")
    known = known.select(F.xxhash64("line").alias("h1"), F.xxhash64(F.lit(1), "line").alias("h2"), "first", F.coalesce("class", "id").alias("class"))
    known = stored(known)
    lowest = known.groupBy("class").agg(F.min("first").alias("first"))
    known = known.drop("first").join(lowest, "class")

    seen = marked.select("key", "hash", "place", F.xxhash64("line").alias("h1"), F.xxhash64(F.lit(1), "line").alias("h2"))
    in_class = seen.join(known, ["h1", "h2"])
    # of a row's lines in one class, the first may stay
    inside = in_class.groupBy("key", "hash", "class", "first").agg(F.min("place").alias("keep"), F.collect_set("place").alias("places"))
    stays = F.col("key").eqNullSafe(F.col("first"))
    dropped = F.when(stays, F.array_remove("places", F.col("keep"))).otherwise(F.col("places"))
    removed = inside.select("key", "hash", dropped.alias("places")).where(F.size("places") > 0)
    kept = [c for c in docs.columns if c.lower() not in ("n_lines", "n_removed")]
    of, which, gone_at, split = (free_name(docs.columns, f"_{c}") for c in ("key", "hash", "gone", "lines"))
    removed = removed.groupBy("key", "hash").agg(F.flatten(F.collect_list("places")).alias("gone")).toDF(of, which, gone_at)
    joined = docs.select(*[F.col(f"`{c}`") for c in kept]).join(
        removed, F.col(key).eqNullSafe(F.col(of)) & (F.xxhash64(text) == F.col(which)), "left"
    )
    joined = joined.withColumn(split, lines_of)
    n_lines = F.greatest(F.coalesce(F.size(split), F.lit(0)), F.lit(0)).cast("long")
    gone = F.greatest(F.coalesce(F.size(gone_at), F.lit(0)), F.lit(0)).cast("long")
    left = F.array_except(F.sequence(F.lit(0), F.size(split) - 1), F.col(gone_at))
    cut = F.array_join(F.transform(left, lambda i: F.get(split, i)), "\n")
    columns = [F.when(gone > 0, cut).otherwise(F.col(text)).alias(text) if c == text else F.col(f"`{c}`") for c in kept]
    return joined.select(*columns, n_lines.alias("n_lines"), gone.alias("n_removed"))
