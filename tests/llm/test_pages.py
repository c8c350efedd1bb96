"""Main text of pages: the query against plain reading of marked pages, the labeller against slow loops, and hostile pages."""

import html
import random
import re
import time

import numpy as np
import pytest

from corpusloom.llm import mainbody as m
from corpusloom.llm import queries

Q = queries.queries()
VOCAB = "river mountain city people government market water music school history weather season animal garden kitchen football paper engine doctor letter window summer village machine science teacher student family story picture question answer money winter dinner coffee".split()


@pytest.fixture(scope="module")
def model():
    out = m.BiLstm(np.random.default_rng(0))
    out.p = m.trained()
    return out


def said(model, page):
    found = m.blocks(page)
    return [b.text for b, k in zip(found, m.labelled(model, [found])[0]) if k]


def prose(r, sentences):
    return " ".join(" ".join(r.choices(VOCAB, k=r.randint(6, 15))).capitalize() + "." for _ in range(sentences))


def test_query_on_pages_with_a_marked_article(spark):
    """The given pages put their article between <article> tags: read by hand, block by block."""
    rows = spark.read.parquet("/root/testdata/sf0.001/pages.parquet").collect()
    want = {}
    for r in rows:
        inside = re.search("<article>(.*?)</article>", r.html, re.S)[1]
        parts = (" ".join(html.unescape(re.sub("<[^>]*>", "", p.replace("<br>", " "))).split()) for p in re.split("</?(?:h1|p)>", inside))
        want[r.page_id, r.url] = "\n".join(p for p in parts if p)
    got = Q["op6_main_text"](spark, "/root/testdata/sf0.001").collect()
    assert {(r.page_id, r.url): r.text for r in got} == want and len(got) == len(rows)
    assert all(r.n_chars == len(r.text) for r in got)


@pytest.mark.parametrize("which", ["odd", "repeated", "none"])
def test_query_on_awkward_tables(spark, request, model, which):
    """Each row, repeated and null ones as well, by the blocks and the labels of its own page."""
    d = request.getfixturevalue(which)
    rows = spark.read.parquet(f"{d}/pages.parquet").collect()
    want = sorted(str((r.page_id, r.url, t := "\n".join(said(model, r.html or "")), len(t))) for r in rows)
    assert sorted(str((r.page_id, r.url, r.text, r.n_chars)) for r in Q["op6_main_text"](spark, d).collect()) == want
    assert not rows or any("long text. " * 100 in w for w in want)


def test_blocks():
    texts = lambda page: [b.text for b in m.blocks(page)]
    assert texts("<p>İstanbul haber</p><SCRIPT>x=1</Script><p>abc def</p>") == ["İstanbul haber", "abc def"]
    assert texts("<head><title>t</title><p>a &amp; b&nbsp;c<br>d <b>e</b>&#x41;</p>﻿f") == ["a & b c d eA", "﻿f"]
    assert texts("a<!-- b --><!doctype x>c<!-->d<?x?>e< f </>g<![CDATA[h<&amp;]]>") == ["acde< f gh<&amp;"]
    assert texts('<p title="a > b">x</p><p>y<table><tr><td>1<td>2<tr><td>3</table>z') == ["x", "y", "1", "2", "3", "z"]
    assert texts('<p>a<p title="b>c<p>d</p>e') == ["a", "c", "d", "e"]
    assert texts("<ul><li>a<ul><li>b<li>c</ul><li>d</ul><select><option>x</select>e") == ["a", "b", "c", "d", "e"]
    assert texts("x <unclosed y <b>z</b> <") == ["x z <"]  # as browsers read it
    path = lambda page: m.blocks(page)[-1].path.words
    assert path('<div data-id="no" class="Side-Bar x" id=more>t') == ("t:div", "c:side", "c:bar", "c:x", "c:more")


@pytest.mark.parametrize("page", ['<a x="' * 150_000, '<a x=">' * 150_001 + "y", "<" * 1_000_000, "<div>" * 150_000, "<b><i>" * 100_000 + "</u>" * 100_000, "<i><div>" + "<b>" * 100_000 + "</i>" * 100_000, "<![CDATA[" * 100_000, "<!--" * 200_000, "</p" * 200_000, "<script>" * 100_000, "".join(f'<div class="x{i}">t' for i in range(20_000))], ids=lambda p: p[:9])
def test_hostile_pages_take_linear_time(page):
    began = time.process_time()
    m.vectors(m.blocks(page))
    assert time.process_time() - began < 15


THREADS = {
    "p in a section": lambda c: '<section class="comments">' + "".join(f"<p>{x}</p>" for x in c) + "</section>",
    "p after a heading": lambda c: '<section class="comments"><h3>Comments</h3>' + "".join(f"<p>{x}</p>" for x in c) + "</section>",
    "p in a named div": lambda c: '<div id="comments">' + "".join(f"<p>{x}</p>" for x in c) + "</div>",
    "div by div": lambda c: '<div class="comments">' + "".join(f'<div class="comment"><p>{x}</p></div>' for x in c) + "</div>",
    "list": lambda c: '<ul class="comment-list">' + "".join(f"<li>{x}</li>" for x in c) + "</ul>",
    "articles": lambda c: '<div class="comments-area"><ol class="commentlist">' + "".join(f'<li class="comment"><article><footer class="comment-meta">Ann Lee</footer><p>{x}</p></article></li>' for x in c) + "</ol></div>",
}


@pytest.mark.parametrize("form", THREADS)
def test_threads_of_any_length_go(model, form):
    r = random.Random(1)
    for n in (1, 2, 4, 10, 40, 150, 400):
        body = ["Title of the story here", *(prose(r, r.randint(2, 4)) for _ in range(5))]
        page = f'<html><head><title>t</title></head><body><nav><a href="/">Home</a></nav><h1>{body[0]}</h1>' + "".join(f"<p>{x}</p>" for x in body[1:]) + THREADS[form]([prose(r, 2) for _ in range(n)]) + "<footer>Copyright 2024</footer></body></html>"
        assert said(model, page) == body, n


def test_menus_and_articles_of_any_length(model):
    r = random.Random(2)
    for n in (50, 450, 1000):
        for link in (lambda: "Same link", lambda: " ".join(r.choices(VOCAB, k=2))):
            body = ["Title of it", *(prose(r, 3) for _ in range(5))]
            page = "<body><nav><ul>" + "".join(f'<li><a href="/{i}">{link()}</a></li>' for i in range(n)) + f"</ul></nav><article><h1>{body[0]}</h1>" + "".join(f"<p>{x}</p>" for x in body[1:]) + "</article></body>"
            assert said(model, page) == body
        body = ["Title of it", *(prose(r, 3) for _ in range(n))]
        assert said(model, f"<body><nav><a>Home</a></nav><article><h1>{body[0]}</h1>" + "".join(f"<p>{x}</p>" for x in body[1:]) + "</article><footer>(c)</footer></body>") == body


def test_unseen_generated_pages(model):
    rng, right, total = np.random.default_rng(123), 0, 0
    for _ in range(150):
        page, truth = m.training_page(rng)
        found = m.blocks(page)
        if len(found) == len(truth):
            right += int((m.labelled(model, [found])[0] == np.array(truth)).sum())
            total += len(truth)
    assert right / total > 0.97


def test_long_class_lists_and_deep_nesting(model):
    """Names after many layout classes or many levels up, and words late in a block, count; the labels are right."""
    text = " ".join(["some plain words of the story"] * 8) + "."
    wide, deep, end = "col-xs-12 col-md-4 col-lg-3 px-2", "<div>" * 15, "</div>" * 15
    vectors = lambda page: m.vectors(m.blocks(page))
    assert (vectors(f'<div class="{wide} sidebar"><p>x</div>') != vectors(f'<div class="{wide} content"><p>x</div>')).any()
    assert (vectors(f'<div class="comments">{deep}<p>x') != vectors(f'<div class="content">{deep}<p>x')).any()
    assert (vectors("<p>" + "a " * 30 + "late") != vectors("<p>" + "a " * 30 + "last")).any()
    assert (vectors("<p>" + "a" * 500 + ".") != vectors("<p>" + "a" * 500 + ",")).any()
    for open_, close in ((lambda names: f'<div class="{wide} {names}">', "</div>"), (lambda names: f'<div class="{names}">{deep}', f"{end}</div>")):
        page = f"<body>{open_('menu')}<ul><li><a href=/>Home</a><li><a href=/b>News</a></ul>{close}{open_('sidebar widget')}<p>{text}</p><p>{text}</p>{close}{open_('article-body')}<h1>The title here</h1><p>{text}</p><p>{text} again</p><p>{text}</p>{close}{open_('comments')}<p>{text}</p><p>{text} yes</p>{close}</body>"
        assert said(model, page) == ["The title here", text, f"{text} again", text]


def slow_scores(model, x):
    """Sums of the output layer over one page, cell by cell."""
    n, sig = m.HIDDEN, lambda z: 1 / (1 + np.exp(-z.astype(float)))
    total = np.full(len(x), float(model.p["k"][0]))
    for d in range(2):
        h, c = np.zeros(n), np.zeros(n)
        for s in range(len(x)) if d == 0 else reversed(range(len(x))):
            a = x[s] @ model.p["W"][d] + h @ model.p["U"][d] + model.p["c"][d, 0]
            i, f, o, v = sig(a[:n]), sig(a[n : 2 * n]), sig(a[2 * n : 3 * n]), np.tanh(a[3 * n :])
            c = f * c + i * v
            h = o * np.tanh(c)
            total[s] += h @ model.p["o"][d * n : (d + 1) * n, 0]
    return total


def test_long_pages_are_labelled_as_a_whole():
    """Pages of many stretches beside short ones get the labels of one run over the whole sequence."""
    rng = np.random.default_rng(4)
    model = m.BiLstm(rng)
    model.p["c"][..., m.HIDDEN : 2 * m.HIDDEN] = 8  # a state that hardly fades
    pages = [m.blocks("".join(f"<p>{' '.join(rng.choice(list('abcdefgh'), 5))}" for _ in range(n))) for n in (3 * m.STRETCH + 7, 5, 2 * m.STRETCH, 0, m.STRETCH + 1)]
    for page, got in zip(pages, m.labelled(model, pages)):
        scores = slow_scores(model, m.vectors(page))
        sure = abs(scores) > 1e-3
        assert len(got) == len(page) and (got == (scores >= 0))[sure].all() and sure.sum() >= len(page) * 0.9


def test_gradients():
    """Against differences of the loss."""
    rng = np.random.default_rng(5)
    model = m.BiLstm(rng)
    pages = [(rng.standard_normal((n, m.DIM)).astype(np.float32), rng.integers(0, 2, n).astype(np.float32)) for n in (4, 7, 1)]

    def loss():
        out, n = 0.0, 0
        for x, y in pages:
            z = slow_scores(model, x)
            out, n = out + float((np.logaddexp(0, z) - y * z).sum()), n + len(y)
        return out / n

    got = model.gradients(*m.padded(pages))
    for name, g in got.items():
        at = np.unravel_index(int(np.argmax(abs(g))), g.shape)
        step = 1e-2
        model.p[name][at] += step
        up = loss()
        model.p[name][at] -= 2 * step
        down = loss()
        model.p[name][at] += step
        assert abs((up - down) / (2 * step) - g[at]) < 0.02 * abs(g[at]) + 1e-4, name
