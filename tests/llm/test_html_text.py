"""Parsing, marginals against enumeration, and the text of given and made-up pages."""

from __future__ import annotations

import html
import itertools
import math
import re

import pytest

from seriesloom.llm.html_text import Model, fit, main_text, parse, teacher_labels


@pytest.fixture(scope="module")
def model(spark, sf):
    return fit(spark.read.parquet(f"{sf}/pages.parquet"))


def _blocks(source):
    return [t for _, t, _ in parse(source).blocks]


def test_parsing():
    assert _blocks("a &amp; b&nbsp;c<br>d<p>x <b>y</b>\n z<p>w &lt;i&gt; &#233;") == ["a & b c d", "x y z", "w <i> é"]
    assert _blocks("<script>if (a<b) '</p>'</script>x<!-- <p>no -->y<style>p{}</style>") == ["xy"]
    assert _blocks("<ul><li>a<li>b</ul><table><tr><td>c<td>d</table>") == ["a", "b", "c", "d"]
    assert _blocks("<select><option>a</select>b<textarea><p>c</textarea>d") == ["bd"]
    assert _blocks("a < b <1 </> <p class=\"x>y\">c</p><p title='open>d</p> e") == ["a < b <1", "c", "d", "e"]
    assert _blocks("text <p cla") == ["text"] and _blocks("x<!-- y") == ["x"] and _blocks("x &am") == ["x &am"]
    assert _blocks("") == [] and _blocks("<html><head><title>t</title><body>b") == ["b"]
    assert len(_blocks("<div>" * 5000 + "deep" + "</div>" * 5000)) == 1


def test_elements_left_open():
    assert _blocks("<head><title>t</title><article><p>b</article>") == ["b"]
    assert _blocks("<html><head><meta charset=x><script>'<p>'</script><p>a") == ["a"]
    assert _blocks("<head><title>t</title>text<p>a") == ["text", "a"]
    assert _blocks("<head><template><p>x</template><title>t</title></head><p>a") == ["a"]
    assert _blocks("<div><button>Press</div><p>a") == ["a"] and _blocks("<button>Press<article>a</article>b") == ["a", "b"]
    assert _blocks("<div><svg><path d=x></div><p>a") == ["a"] and _blocks("<svg><g><p>a</p>b") == ["a", "b"]
    assert _blocks("<svg><foreignObject><div>x</div></foreignObject></svg>y") == ["y"]
    assert _blocks("<button><div>x<p>y</div></button>z<select><option>a<option>b</select>c") == ["zc"]
    assert _blocks("<section><select><option>a</section>b") == ["b"]


def test_sample_of_labelled_pages(spark):
    plain = [(f"<div><p>menu {i}</p></div>",) for i in range(300)]
    page = "<nav><a href=x>go</a></nav><article><p>{}</p></article>"
    words = "A sentence that goes on for some words and ends with number"
    some = [(page.format(f"{words} {i}."),) for i in range(20)]
    df = spark.createDataFrame(plain + some + some[:1] * 400 + [(None,)], "html string")
    few, same = fit(df, sample=20), fit(spark.createDataFrame(some, "html string"), sample=20)
    assert few == same  # neither unlabelled nor equal pages take places of others
    got = main_text(df, few).where("text like 'A sentence%'").count()
    assert got == 420
    nothing = fit(spark.createDataFrame(plain, "html string"))
    assert main_text(df, nothing).where("text <> ''").count() == 0


def test_marginals_are_exact():
    source = "<div class=post><p>Some words that end here.</p><div><a href=x>link</a></div><ul><li>a<li>b</ul></div><p>q</p>"
    page = parse(source)
    pairs = {(p, k, h): (math.log(0.3 + 0.1 * p), math.log(0.7 - 0.1 * p)) for p in (False, True) for k in ("group", "text", "list", "item") for h in ("none", "near")}
    looks = {("m", "end"): (-3.0, -1.0), ("s", "link"): (-0.5, -2.5), ("s", "open"): (-1.0, -1.2)}
    model = Model(pairs, {False: (math.log(0.5),) * 2, True: (math.log(0.5),) * 2}, looks)
    from seriesloom.llm.html_text import _looks

    own, n = _looks(page), len(page.parent)
    total, sums = 0.0, [0.0] * n
    for labels in itertools.product((False, True), repeat=n - 1):
        labels = (False, *labels)
        w = math.exp(sum(looks.get(own[i], (0, 0))[labels[i]] for i in range(n)))
        for i in range(1, n):
            w *= math.exp(pairs[labels[page.parent[i]], page.kind[i], page.hint[i]][labels[i]])
        total += w
        sums = [s + w * x for s, x in zip(sums, labels)]
    assert model.marginals(page) == pytest.approx([s / total for s in sums])


def test_teacher():
    page = parse("<nav><p>n</p></nav><article><p>a</p><aside><p>b</p></aside></article>")
    assert [t for n, t, _ in page.blocks if teacher_labels(page)[n]] == ["a"]
    assert teacher_labels(parse("<p>x</p>")) is None


def _by_article(source):
    inner = re.search(r"<article>(.*?)(?:</article>|$)", source, re.S)[1]
    inner = re.sub(r"<[^<>]*$", "", inner.replace("<br>", " ").replace("<b>", "").replace("</b>", ""))
    parts = [" ".join(html.unescape(x).split()) for x in re.split(r"</?(?:p|h1)>", inner)]
    return "\n\n".join(x for x in parts if x)


def test_given_pages(spark, sf, model):
    pages = spark.read.parquet(f"{sf}/pages.parquet")
    got = main_text(pages, model).collect()
    assert len(got) == pages.count() and all(r.text == _by_article(r.html) for r in got)


@pytest.mark.parametrize("home", ["article", "main", 'div class="post-body"', "div", 'section id="story"'])
def test_other_layouts(model, home):
    words = "A sentence of the article that goes on for a number of words, as they do. " * 3
    source = f"""<body><header><h2>Site</h2><p>{words}</p></header><div><nav>menu</nav><{home}><h1>Title of it</h1><p>{words}1</p>
      <ul><li>one</li></ul><p>{words}2</p><div class="comments"><p>{words}c</p></div><form><p>{words}f</p></form></{home.split()[0]}>
      <div class="sidebar"><p>{words}s</p></div></div><div class="cookie-banner"><p>{words}</p></div><footer><p>{words}</p></footer>"""
    page = parse(source)
    p = model.marginals(page)
    text = [t for n, t, _ in page.blocks if p[n] > 0.5]
    assert text == ["Title of it", f"{words}1", "one", f"{words}2"]


def test_odd_pages(spark, model):
    rows = [(1, None, 1), (2, "", 2), (3, "<p>", 3), (None, "<nav>x</nav>", 4), (4, "<article>" + "<p>word.</p>" * 20000, 5), (4, "<article>x.", 6)]
    df = spark.createDataFrame(rows, "page_id long, html string, text int")
    got = [(r.page_id, r.text) for r in main_text(df, model).collect()]
    assert got[:4] == [(1, ""), (2, ""), (3, ""), (None, "")] and got[4][1].count("word.") == 20000
    assert main_text(df.limit(0), model).count() == 0
    fit(df.limit(0))
