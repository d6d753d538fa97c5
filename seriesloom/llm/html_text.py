"""Main text of web pages: a tree-structured model over the DOM with sum-product marginals."""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from collections.abc import Callable, Iterator, Mapping
from dataclasses import dataclass, field
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .batches import texts, with_computed

# Elements by what they do to text.
SKIPPED = set("script style noscript template iframe object svg math select textarea button title head audio video canvas map".split())
RAW = set("script style textarea title iframe noscript".split())
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
KINDS = {
    "article": "main", "main": "main", "nav": "nav", "header": "header", "footer": "footer", "aside": "aside",
    "form": "form", "fieldset": "form", "dialog": "form", "p": "text", "blockquote": "text", "pre": "text",
    "figcaption": "text", "dd": "text", "address": "text", "h1": "heading", "h2": "heading", "h3": "heading",
    "h4": "heading", "h5": "heading", "h6": "heading", "dt": "heading", "summary": "heading", "li": "item",
    "td": "item", "th": "item", "caption": "item", "ul": "list", "ol": "list", "dl": "list", "menu": "list",
    "table": "list", "thead": "list", "tbody": "list", "tfoot": "list", "tr": "list", "body": "body", "html": "body",
    "div": "group", "section": "group", "figure": "group", "details": "group", "center": "group", "hr": "group",
}
#: What a start tag ends when it is open: itself or one of these, up to one of the stops.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "tbody": ({"thead", "tbody", "tr", "td", "th"}, {"table"}), "tfoot": ({"tbody", "tr", "td", "th"}, {"table"}),
}
REMOTE = set(
    "ad ads advert adverts advertisement banner sponsor sponsored promo promotion nav navbar navigation menu breadcrumb "
    "breadcrumbs header masthead footer contentinfo sidebar aside complementary widget related recommended share sharing "
    "social comment comments reply replies respond discussion disqus cookie cookies consent notice gdpr popup modal "
    "overlay dialog newsletter subscribe subscription signup login search form toolbar pagination pager tags skip hidden "
    "copyright legal alert".split()
)
NEAR = set("article content post entry story main body text prose".split())
FAR_KINDS = {"nav", "header", "footer", "aside", "form"}
#: Elements that a head may hold; any other begins the body.
HEAD = set("base basefont bgsound head html link meta noframes noscript script style template title".split())
#: Block elements that end a drawing or a formula that was not closed.
BREAKS_OUT = {"p", "div", "ul", "ol", "dl", "table", "pre", "blockquote", "h1", "h2", "h3", "h4", "h5", "h6"}

_TAG = re.compile(
    r"<(?:!--(?:.*?-->|.*$)|(?P<end>/?)(?P<name>[A-Za-z][^\s/>]*)(?P<rest>(?:\"[^\"]*\"|'[^']*'|[^>\"'])*+)>"
    r"|(?P<end2>/?)(?P<name2>[A-Za-z][^\s/>]*)(?P<rest2>[^>]*)>|/?[A-Za-z][^>]*$|[!?/][^>]*(?:>|$))",
    re.S,
)
_NAMED = re.compile(r"""(?:^|\s)(class|id|role|hidden|aria-hidden|data-main)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?(?=\s|/|$)""", re.I)
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


@dataclass
class Page:
    """DOM nodes in page order and the text blocks that they hold; node 0 stands for the page."""

    parent: list[int] = field(default_factory=lambda: [0])
    kind: list[str] = field(default_factory=lambda: ["body"])
    hint: list[str] = field(default_factory=lambda: ["none"])
    marked: list[bool] = field(default_factory=lambda: [False])
    blocks: list[tuple[int, str, int]] = field(default_factory=list)  # node, text, characters in links


def _hint(rest: str) -> tuple[str, bool]:
    words, marked = set(), False
    for name, a, b, c in _NAMED.findall(rest):
        name, value = name.lower(), a or b or c
        if name == "data-main":
            marked = True
        elif name in ("hidden", "aria-hidden"):
            words |= {"hidden"} if value.lower() != "false" else set()
        else:
            words |= {w.lower() for w in _WORDS.findall(value)}
    return "remote" if words & REMOTE else "near" if words & NEAR else "none", marked


def parse(source: str) -> Page:
    """Block elements as nodes, inline ones as part of their block. White space in a block becomes one space;
    character references are decoded; skipped elements leave nothing; an unfinished tag at the end is dropped.

    A head that is not closed ends at the first element or text that it may not hold. Another skipped element that
    is not closed ends with its parent, at a sectioning element, or, as a drawing or formula, at a block."""
    page = Page()
    stack: list[tuple[str, int]] = [("", 0)]  # open elements and their nodes
    run: list[str] = []
    in_links = links = 0
    skipping: list[str] = []  # the skipped element and what is open inside it

    def over(name: str, ends: str) -> bool:
        """Whether a tag ends the skipped element without being its end tag."""
        if skipping == ["head"]:
            return name in ("body", "html") if ends else name not in HEAD
        if ends:
            return any(x == name for x, _ in stack)
        kind = KINDS.get(name)
        if name == "body" or kind in ("main", "nav", "header", "footer", "aside") and skipping[0] not in ("template", "dialog"):
            return "foreignobject" not in skipping
        return skipping[0] in ("svg", "math") and name in BREAKS_OUT and "foreignobject" not in skipping

    def close_run() -> None:
        nonlocal in_links
        words = html.unescape("".join(run)).split()
        if words:
            whole = " ".join(words)
            page.blocks.append((stack[-1][1], whole, min(in_links, len(whole))))
        run.clear()
        in_links = 0

    def pop_to(i: int) -> None:
        close_run()
        del stack[i:]

    at, end = 0, len(source)
    while at < end:
        found = _TAG.search(source, at)
        stop = found.start() if found else end
        if stop > at and skipping == ["head"] and source[at:stop].strip():
            skipping.clear()
        if stop > at and not skipping:
            piece = source[at:stop]
            run.append(piece)
            if links:
                in_links += len(piece)
        if not found:
            break
        at = found.end()
        name = (found["name"] or found["name2"] or "").lower()
        if not name:
            continue
        ends, rest = found["end"] or found["end2"], found["rest"] or found["rest2"] or ""
        if skipping:
            if ends and name in skipping:
                while skipping.pop() != name:
                    pass
                continue
            if over(name, ends):
                skipping.clear()
            elif ends or name in VOID or rest.endswith("/"):
                continue
            elif name not in RAW:
                skipping.append(name)
                continue
        if name in SKIPPED and not ends:
            if name in RAW:
                close = re.compile(rf"</{name}[\s/>]", re.I).search(source, at)
                at = close.start() if close else end
                after = source.find(">", at)
                at = after + 1 if after >= 0 else end
            elif not rest.endswith("/"):
                skipping.append(name)
            continue
        if name == "br" or name in VOID and name not in KINDS:
            run.append(" ")
            continue
        if name == "a":
            links = 0 if ends else 1
            continue
        kind = KINDS.get(name)
        if kind is None:
            continue
        if ends:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i][0] == name:
                    pop_to(i)
                    break
            else:
                close_run()
            continue
        close_run()
        links = 0
        ended, stops = CLOSES.get(name, ({"p"}, set()))
        for i in range(len(stack) - 1, 0, -1):
            if stack[i][0] in stops:
                break
            if stack[i][0] in ended or stack[i][0] == "p":
                pop_to(i)
                if name not in CLOSES:
                    break
        if kind == "heading" and KINDS.get(stack[-1][0]) == "heading":
            pop_to(len(stack) - 1)
        hint, marked = _hint(rest) if rest else ("none", False)
        page.parent.append(stack[-1][1])
        page.kind.append(kind)
        page.hint.append(hint)
        page.marked.append(marked)
        if name != "hr":
            stack.append((name, len(page.parent) - 1))
    close_run()
    return page


def _looks(page: Page) -> list[tuple[str, str]]:
    """Of each node: size of its own text, and how much of it is links or whether it ends like a sentence."""
    size, linked, closed = [0] * len(page.parent), [0] * len(page.parent), [False] * len(page.parent)
    for n, t, k in page.blocks:
        size[n] += len(t)
        linked[n] += k
        closed[n] |= t[-1] in ".!?…\"'”»。"
    out = []
    for s, k, c in zip(size, linked, closed):
        length = "" if not s else "s" if s < 25 else "m" if s < 100 else "l" if s < 400 else "x"
        out.append((length, "" if not s else "link" if 3 * k > s else "end" if c else "open"))
    return out


def teacher_labels(page: Page) -> list[bool] | None:
    """Labels from markup that states its meaning: inside a main element and not inside a remote one. None for
    pages without a main element."""
    if not any(page.marked) and "main" not in page.kind:
        return None
    by_mark = any(page.marked)
    state = [0]  # 0 outside, 1 inside, 2 in a remote part
    for i in range(1, len(page.parent)):
        s = state[page.parent[i]]
        starts = page.marked[i] if by_mark else page.kind[i] == "main"
        if page.kind[i] in FAR_KINDS or page.hint[i] == "remote":
            s = 2
        elif s == 0 and starts:
            s = 1
        state.append(s)
    return [s == 1 for s in state]


#: Made-up surroundings for labelled pages: a page's own paragraphs in places that are no main text.
_AROUND = (
    '<aside class="sidebar"><h3>{a}</h3><p>{b}</p></aside>', '<div class="sidebar"><p>{b}</p><ul><li><a href="#">{a}</a></li></ul></div>',
    '<div class="cookie-notice"><p>{b}</p></div>', '<header><h2>{a}</h2><p>{b}</p></header>', '<footer><p>{b}</p></footer>',
    '<div class="ad"><p>{b}</p></div>', '<div><a href="#">{a}</a> <a href="#">{a}</a></div>', '<nav><p><a href="#">{a}</a></p></nav>',
    '<ul><li><a href="#">{a}</a></li><li><a href="#">{a}</a></li></ul>',
)
_INSIDE = (
    '<section id="comments"><h2>{a}</h2><div class="comment"><p>{b}</p></div><div><p>{b}</p></div></section>',
    '<form action="#"><p>{b}</p><label>{a}</label></form>', '<div class="share"><p>{a}</p></div>', '<aside><p>{b}</p></aside>',
    '<nav><ul><li><a href="#">{a}</a></li></ul></nav>', '<header><p>{b}</p></header>', '<footer><p>{b}</p></footer>',
    '<div class="related"><ul><li><a href="#">{a}</a></li></ul></div>', '<div class="newsletter"><h3>{a}</h3><p>{b}</p></div>',
)
_MORE = (
    "", "<ul><li>{a}</li><li>{b}</li></ul>", "<blockquote><p>{b}</p></blockquote>", "<table><tr><td>{a}</td><td>{b}</td></tr></table>",
    "<div><p>{b}</p></div>", "<h2>{a}</h2><p>{b}</p>",
)
_HOMES = ("article", "main", 'div class="post-content"', 'div id="content"', "div", "section", 'section class="story"')
_ARTICLE = re.compile(r"<article[^>]*>(.*?)(?:</article>|$)", re.S | re.I)


def surrounded(source: str, page: Page, turn: int) -> str | None:
    """A labelled page made of the main part of ``source`` in another container, beside remote parts."""
    inner = _ARTICLE.search(source)
    long = [html.escape(t) for _, t, _ in page.blocks if len(t) > 40]
    if not inner or not long:
        return None
    part = {"a": long[turn % len(long)][:30], "b": long[(turn * 7 + 1) % len(long)]}
    home = _HOMES[turn % len(_HOMES)]
    before, after = (_AROUND[(turn // k) % len(_AROUND)].format(**part) for k in (7, 11))
    more = _MORE[(turn // 5) % len(_MORE)].format(**part)
    last = _INSIDE[(turn // 3) % len(_INSIDE)].format(**part)
    return f"<body>{before}<div><{home} data-main>{inner[1]}{more}{last}</{home.split()[0]}></div>{after}</body>"


@dataclass(frozen=True)
class Model:
    """Log potentials: of a child's label given its parent's and its markup, and of a node's text given its label."""

    pairs: Mapping[tuple[bool, str, str], tuple[float, float]]
    fallback: Mapping[bool, tuple[float, float]]
    looks: Mapping[tuple[str, str], tuple[float, float]]

    def marginals(self, page: Page) -> list[float]:
        """Probability of each node to hold main text, by messages up from the leaves and down from the root."""
        n = len(page.parent)
        nothing = (0.0, 0.0)
        own = [self.looks.get(x, nothing) for x in _looks(page)]
        # below[i]: weights of node i's labels from its own text and all below it
        below = [[math.exp(a), math.exp(b)] for a, b in own]
        psi = [None] * n
        up: list[tuple[float, float]] = [(1.0, 1.0)] * n
        for i in range(n - 1, 0, -1):
            rows = []
            for p in (False, True):
                a, b = self.pairs.get((p, page.kind[i], page.hint[i]), self.fallback[p])
                rows.append((math.exp(a), math.exp(b)))
            psi[i] = rows
            x0, x1 = below[i]
            m0, m1 = rows[0][0] * x0 + rows[0][1] * x1, rows[1][0] * x0 + rows[1][1] * x1
            s = m0 + m1
            up[i] = (m0 / s, m1 / s)
            y = below[page.parent[i]]
            y[0] *= up[i][0]
            y[1] *= up[i][1]
            t = y[0] + y[1]
            y[0] /= t
            y[1] /= t
        belief = [(1.0, 0.0)] + [(0.0, 0.0)] * (n - 1)  # the page itself holds no main text
        for i in range(1, n):
            b0, b1 = belief[page.parent[i]]
            c0, c1 = b0 / max(up[i][0], 1e-300), b1 / max(up[i][1], 1e-300)  # without this child's message
            rows, (x0, x1) = psi[i], below[i]
            d0 = (c0 * rows[0][0] + c1 * rows[1][0]) * x0
            d1 = (c0 * rows[0][1] + c1 * rows[1][1]) * x1
            s = d0 + d1
            belief[i] = (d0 / s, d1 / s)
        return [b for _, b in belief]


def fit(pages: DataFrame, source: str = "html", sample: int = 2000, smoothing: float = 0.5, weight: float = 1.0) -> Model:
    """Potentials counted over labelled pages: the ``sample`` different ones with the smallest hashes among all
    pages that name a main element in their markup, each as it is and once more in made-up surroundings. Equal
    pages count once and pages without labels take no place. ``weight`` tempers the text of a node, whose features
    depend on each other. Counts are made on the executors; what comes back has a row a feature. Without any
    labelled page no node is more likely main text than not, and every page has an empty text."""
    hashed = pages.select(F.col(source).alias("source"), F.xxhash64(source).alias("hash"))
    hashed = hashed.where(F.col("source").rlike(r"(?i)<(article|main)[\s/>]|data-main"))
    smallest = hashed.select("hash").distinct().orderBy("hash").limit(sample)
    chosen = hashed.join(F.broadcast(smallest), "hash", "left_semi").groupBy("hash").agg(F.min("source").alias("source"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter = Counter()
        for batch in batches:
            for data in texts(batch.column("source")):
                text = data.decode()
                page = parse(text)
                other = surrounded(text, page, len(data))
                for p in [page, *([parse(other)] if other else [])]:
                    labels = teacher_labels(p)
                    if labels is None:
                        continue
                    for i, (look, label) in enumerate(zip(_looks(p), labels)):
                        if look[0]:  # containers tell nothing by themselves
                            found["look", look[0], look[1], False, label] += 1
                        if i:
                            found["pair", p.kind[i], p.hint[i], labels[p.parent[i]], label] += 1
        if found:
            columns = list(zip(*(k for k in found)))
            yield pa.RecordBatch.from_arrays(
                [*map(pa.array, columns), pa.array(list(found.values()), pa.int64())], ["what", "x", "y", "parent", "label", "n"]
            )

    rows = chosen.select("source").mapInArrow(count, "what string, x string, y string, parent boolean, label boolean, n long")
    counts: Counter = Counter()
    for r in rows.groupBy("what", "x", "y", "parent", "label").agg(F.sum("n").alias("n")).collect():
        counts[r.what, r.x, r.y, r.parent, r.label] = r.n

    def split(pick: Callable[[tuple], bool]) -> tuple[float, float]:
        no, yes = (sum(v for k, v in counts.items() if k[4] is x and pick(k)) for x in (False, True))
        return math.log((no + smoothing) / (no + yes + 2 * smoothing)), math.log((yes + smoothing) / (no + yes + 2 * smoothing))

    pairs = {(k[3], k[1], k[2]) for k in counts if k[0] == "pair"}
    looks = {(k[1], k[2]) for k in counts if k[0] == "look"}
    totals = [sum(v for k, v in counts.items() if k[0] == "look" and k[4] is x) for x in (False, True)]
    return Model(
        {(p, a, b): split(lambda k, p=p, a=a, b=b: k[:4] == ("pair", a, b, p)) for p, a, b in pairs},
        {p: split(lambda k, p=p: k[0] == "pair" and k[3] is p) for p in (False, True)},
        {
            (a, b): tuple(
                weight * math.log((counts["look", a, b, False, x] + smoothing) / (totals[i] + smoothing * (len(looks) + 1)))
                for i, x in enumerate((False, True))
            )
            for a, b in looks
        },
    )


def main_text(pages: DataFrame, model: Model, source: str = "html", out: str = "text", limit: float = 0.5) -> DataFrame:
    """The input with the main text of every page: blocks of nodes with a marginal over ``limit``, in page order
    and joined by an empty line. Null and empty pages, and pages without main text, have an empty text; a
    column named like ``out`` is replaced."""

    def extract(data: bytes) -> str:
        page = parse(data.decode())
        p = model.marginals(page)
        return "\n\n".join(t for n, t, _ in page.blocks if p[n] > limit)

    def make() -> Callable[[pa.RecordBatch], Mapping[str, Any]]:
        return lambda batch: {out: [extract(x) for x in texts(batch.column(source))]}

    return with_computed(pages, {out: "string"}, make)
