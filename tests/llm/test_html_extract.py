from __future__ import annotations

import random

import numpy as np
import pytest

from sieveline.llm import boosting, html_extract
from sieveline.llm.dom import Page
from sieveline.llm.html_extract import decode, extract, layout, main_text

WORDS = "river stone the of and walked quickly toward an old house, where nobody had lived since winter.".split()


def prose(rng, n):
    return " ".join(rng.choice(WORDS) for _ in range(n)).strip().capitalize() + "."


def article(rng):
    return [prose(rng, 6)] + [prose(rng, rng.choice([1, 4, 30, 80])) for _ in range(rng.randrange(1, 12))]


def site(i, blocks, rng):
    body = f"<article><h1>{blocks[0]}</h1>" + "".join(f"<p>{b}" + rng.choice(["</p>", "<br>"]) for b in blocks[1:]) + "</article>"
    menu = "<nav><ul>" + "".join(f'<li><a href="/{w}">{w}</a></li>' for w in WORDS[:5]) + "</ul></nav>"
    return f"<!DOCTYPE html><html><head><title>t</title><script>var t='</p>';</script></head><body>{menu}<div class=\"ad\">{prose(rng, 8)}</div>{body}<footer>&copy; {i} {prose(rng, 9)}</footer></body></html>"


@pytest.fixture(scope="module")
def pages():
    rng = random.Random(5)
    made = [article(rng) for _ in range(120)]
    return [(i, f"http://x/{i}", site(i, blocks, rng), "\n\n".join(blocks)) for i, blocks in enumerate(made)]


def frame(spark, rows):
    return spark.createDataFrame([(*r[:3], "t", 1) for r in rows], "page_id long, url string, html string, text string, N_chars long").repartition(3)


def test_articles_come_out_whole(spark, pages):
    rows = pages + [(500, None, None, ""), (501, "u", "", ""), (None, "u", pages[0][2], pages[0][3]), (0, "again", pages[0][2], pages[0][3])]
    got = main_text(frame(spark, rows)).collect()
    assert sorted([(r.page_id, r.url, r.text, r.n_chars) for r in got], key=str) == sorted([(i, u, t, len(t)) for i, u, _, t in rows], key=str)
    assert main_text(frame(spark, rows).limit(0)).count() == 0


def test_the_sample_holds_distinct_pages_however_often_they_occur(spark, pages):
    few = [h for _, _, h, _ in pages[:5]]
    table = spark.createDataFrame([(h,) for h in few], "html string").selectExpr("explode(array_repeat(html, 900)) AS html")
    assert sorted(html_extract.sample(table, 10)) == sorted(few)
    assert len(html_extract.sample(table, 3)) == 3 and set(html_extract.sample(table, 3)) < set(few)
    assert html_extract.sample(table.limit(0), 3) == []


def test_trees_are_fitted_whatever_the_copies(spark, pages):
    few = [h for _, _, h, _ in pages[:1]]
    table = spark.createDataFrame([(h,) for h in few], "html string").selectExpr("explode(array_repeat(html, 50000)) AS html")
    assert html_extract.fit(table) is not None


def test_unseen_layouts_are_mostly_decided_right(pages):
    trees = boosting.fit(*html_extract.examples([h for _, _, h, _ in pages[:80]]))
    rng = random.Random(77)
    others = [b for _, _, _, t in pages[:40] for b in t.split("\n\n")]
    right = 0
    for _ in range(120):
        blocks = article(rng)
        right += next(extract([layout(blocks, others, rng)], trees)) == "\n\n".join(blocks)
    assert right >= 105


def test_reader_takes_what_pages_contain():
    page = Page("<p>a &amp; b<p>c<br>d <b>e</b>\n f<script>x</p></script><ul><li>1<li>2</ul><!-- no --><div class='x sideBar'>t</div>&lt;z<style>p{}")
    assert page.text([True] * len(page.tag)) == "a & b\n\nc d e f\n\n1\n\n2\n\nt\n\n<z"
    assert {"x", "side", "bar"} in page.words
    for broken in ("", "<", "<p", "</p></div>", "<!--", "<a href='>x", "a < b > c", "<script>never closed", "<p>" * 3000 + "x"):
        page = Page(broken)
        assert len(page.end) == len(page.tag) and all(e > i for i, e in enumerate(page.end))
        page.text([True] * len(page.tag))


@pytest.mark.parametrize(
    "html, want",
    [
        ('<p>a<svg class="icon"/>b</p><p>c</p>', "ab\n\nc"),
        ("<p>a<math/>b<svg><path d='M0'/><title>t</title><text>no</text></svg>c</p>", "abc"),
        ("<div>a<button>no</div><p>b</p><button>no</button>c", "a\n\nb\n\nc"),
        ("<div>a<a href='/'>b<svg>no</a>c</div><p>d</p>", "abc\n\nd"),
        ("<div><select><option>no<select>no</select>a</div>b", "a\n\nb"),
        ("<div>a<object><div>no</div><object>no</object>no</object>b</div>", "ab"),
        ("<ul><li>a<video src=x>no</li><li>b</li></ul><iframe>no", "a\n\nb"),
        ("<div><noscript><style>x</div></style><p>no</p></noscript>a</div>", "a"),
        ("<head><noscript>no</head><body>a<template><script>'</template>'</script>no</template>b<textarea>no</p>", "ab"),
        ("<head><noscript>no<body>a", "a"),
    ],
)
def test_elements_without_text_end_with_themselves_or_their_parent(html, want):
    page = Page(html)
    assert page.text([True] * len(page.tag)) == want


def test_decoding_has_no_kept_node_in_a_dropped_one():
    rng = np.random.default_rng(1)
    page = Page("<body><div><p>a b c</p><div><p>d</p></div></div><main><p>e</p><p>f g</p></main></body>")
    for _ in range(200):
        logits = rng.normal(0, 3, len(page.tag))
        keep = decode(page, logits)
        gain = np.clip(logits, -4, 4) * (1 + np.log1p(page.chars) / 3)
        assert (not any(keep)) or gain[keep].sum() > 0
    assert decode(page, np.full(len(page.tag), -3.0)) == [False] * len(page.tag)
    assert all(decode(page, np.full(len(page.tag), 3.0)))
    article = np.where(np.arange(len(page.tag)) >= 6, 3.0, -3.0)
    article[-1] = -0.2  # a weak doubt about one paragraph
    assert page.text(decode(page, article)) == "e\n\nf g"


def test_without_examples_tags_decide():
    assert list(extract(["<nav>m</nav><main>a<nav>b</nav></main>c", "<nav>m</nav><p>x</p>", None], None)) == ["a", "x", ""]


def test_boosting_learns_an_interaction():
    rng = np.random.default_rng(2)
    x = rng.uniform(-1, 1, (4000, 5))
    y = ((x[:, 0] > 0) ^ (x[:, 3] > 0.2)).astype(float)
    model = boosting.fit(x[:3000], y[:3000], np.ones(3000))
    assert ((model.logits(x[3000:]) > 0) == (y[3000:] > 0)).mean() > 0.95
