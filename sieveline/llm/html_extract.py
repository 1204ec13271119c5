"""Main text of web pages by gradient-boosted trees over DOM nodes.

Every block element is a node.  Its features are its tag, words of its class, id and role (and of
its ancestors'), depth, text and link density of its subtree, its share of the page, where it
lies, and the same of its parent and siblings.  The trees give each node a score; decoding then
chooses for each subtree whether all of it stays, all of it goes, or its children decide, where a
change inside a subtree has a price: no node stays inside one that goes as a whole, and a short
paragraph does not leave its article for a weak doubt.

The trees are fitted on a bounded sample, the SAMPLE_PAGES distinct pages
whose content has the smallest hashes.
Labels come from how pages are built: pages that mark their article in HTML are examples as they
are, and the blocks of text of sampled pages are set anew in generated layouts, with and without
telling names, whose parts are known.

A null or empty page has no text.  Results depend on the html alone; repeated rows and other
columns change nothing.  Without any page to learn from, an element that is an article or main,
or else the body, decides.  Pages of any length are read whole.
"""

from __future__ import annotations

import random
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import arrow_udf

from sieveline.llm import boosting
from sieveline.llm.dom import TAGS, Page

#: Pages that the trees are fitted on, and generated layouts per page.
SAMPLE_PAGES, LAYOUTS = 150, 3
#: Nodes in one prediction.
NODES = 20_000
#: Price of a change inside a subtree, and the most that one node can say.
CHANGE, CERTAIN = 3.0, 4.0

#: Words of attributes that pages use for their parts.
NAMES = {
    "content": "content article post entry body text story main page prose",
    "menu": "nav navbar navigation menu breadcrumb breadcrumbs tabs toc pagination pager skip topbar",
    "advert": "ad ads adv advert advertisement advertising sponsor sponsored promo promotion banner adbox dfp",
    "side": "sidebar side aside widget related recommended recommendations trending popular rail more tags",
    "comment": "comment comments reply replies discussion respond disqus feedback thread commentlist reviews",
    "foot": "footer foot copyright legal colophon bottom credits siteinfo",
    "head": "header masthead logo brand branding site top",
    "notice": "cookie cookies consent gdpr notice popup modal overlay newsletter subscribe subscription alert privacy",
    "form": "form login signup search signin contact register",
    "share": "share sharing social follow print toolbar byline meta author date",
}
_WORD_KIND = {word: k for k, words in enumerate(NAMES.values()) for word in words.split()}
_KINDS = len(NAMES)
#: Tags that are told apart; the others are one kind.
_TAG_KINDS = "article main section div p h1 h2 h3 ul ol li table td form nav header footer aside blockquote body".split()
_TAG_KIND = np.full(len(TAGS), len(_TAG_KINDS))
for _k, _tag in enumerate(_TAG_KINDS):
    _TAG_KIND[TAGS[_tag]] = _k
_BAD_TAGS = np.isin(np.arange(len(TAGS)), [TAGS[t] for t in ("nav", "header", "footer", "aside", "form", "menu", "dialog", "search")])
_GOOD_TAGS = np.isin(np.arange(len(TAGS)), [TAGS[t] for t in ("article", "main")])


def features(pages: list[Page]) -> np.ndarray:
    """A row of features per node of all pages."""
    sizes = np.array([len(p.tag) for p in pages])
    first = np.repeat(np.cumsum(sizes) - sizes, sizes)
    flat = lambda name: np.array([x for p in pages for x in getattr(p, name)])
    n = len(first)
    tag, parent, end, depth = flat("tag"), flat("parent"), flat("end") + first, flat("depth")
    chars, links = flat("chars").astype(float), flat("link_chars").astype(float)
    is_root = parent < 0
    parent = np.where(is_root, np.arange(n), parent + first)

    own = np.zeros((n, _KINDS))
    at = 0
    for page in pages:
        for words in page.words:
            for word in words:
                if (kind := _WORD_KIND.get(word)) is not None:
                    own[at, kind] = 1
            at += 1
    above = np.column_stack([own, _BAD_TAGS[tag], _GOOD_TAGS[tag]]).astype(float)
    for level in range(1, int(depth.max(initial=0)) + 1):  # parents before children
        rows = np.flatnonzero(depth == level)
        above[rows] = np.maximum(above[rows], above[parent[rows]])

    def below(values: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(values)])
        return sums[end] - sums[np.arange(n)]

    def share(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return a / np.maximum(b, 1)

    text, link, nodes = below(chars), below(links), below(np.ones(n))
    blocks = below((chars > 0).astype(float))
    paragraphs = below(((tag == TAGS["p"]) & (chars > 0)).astype(float))
    page_text = text[first]
    before = np.concatenate([[0], np.cumsum(chars)])[:-1]
    before = before - before[first]
    density = share(link, text)
    children = np.bincount(parent, minlength=n) - is_root
    sibling_text = share(np.bincount(parent, text * ~is_root, n)[parent], children[parent])
    sibling_link = share(np.bincount(parent, link * ~is_root, n)[parent], np.bincount(parent, text * ~is_root, n)[parent])
    columns = [
        _TAG_KIND[tag] == k for k in range(len(_TAG_KINDS))
    ] + [
        depth, np.log1p(chars), np.log1p(text), density, np.log1p(nodes), blocks, paragraphs, np.log1p(share(text, blocks)),
        share(text, page_text), share(before, page_text), share(page_text - before - text, page_text), children,
        np.log1p(text[parent]), density[parent], paragraphs[parent], share(text, text[parent]), children[parent],
        np.log1p(sibling_text), sibling_link, share(paragraphs, blocks),
    ]
    return np.column_stack([np.column_stack(columns).astype(float), own, above])


def decode(page: Page, logits: np.ndarray) -> list[bool]:
    """Per node whether its direct text stays."""
    n = len(page.tag)
    chars = np.array(page.chars)
    gain = np.clip(logits, -CERTAIN, CERTAIN) * (1 + np.log1p(chars) / 3)
    gain = gain.tolist()
    whole, mixed = gain[:], [max(0.0, g) if c else 0.0 for g, c in zip(gain, page.chars)]
    best = [0.0] * n
    for i in range(n - 1, -1, -1):  # children before parents
        best[i] = max(0.0, whole[i], mixed[i] - CHANGE)
        if i:
            whole[page.parent[i]] += whole[i]
            mixed[page.parent[i]] += best[i]
    keep = [False] * n
    state: list[int] = [0] * n  # 0: the children decide, 1: all stays, -1: all goes
    for i in range(n):
        above = state[page.parent[i]] if i else 0
        if above:
            state[i] = above
        elif whole[i] > 0 and whole[i] >= mixed[i] - CHANGE:
            state[i] = 1
        elif mixed[i] - CHANGE <= 0:
            state[i] = -1
        keep[i] = state[i] > 0 or (state[i] == 0 and page.chars[i] > 0 and gain[i] > 0)
    return keep


def extract(htmls: list[str | None], trees: boosting.Boosted | None) -> Iterator[str]:
    """The main text of every page."""
    held: list[Page] = []
    nodes = 0

    def done() -> Iterator[str]:
        if trees is None:
            yield from (page.text((_by_tag(page) > 0).tolist()) for page in held)
            return
        logits, at = trees.logits(features(held)), 0
        for page in held:
            yield page.text(decode(page, logits[at : at + len(page.tag)]))
            at += len(page.tag)

    for html in htmls:
        page = Page(html or "")
        held.append(page)
        nodes += len(page.tag)
        if nodes > NODES:
            yield from done()
            held, nodes = [], 0
    if held:
        yield from done()


def _by_tag(page: Page) -> np.ndarray:
    """Without trees: inside an article or main, or else everywhere but in parts that are never content."""
    good = [bool(_GOOD_TAGS[t]) for t in page.tag]
    bad = [bool(_BAD_TAGS[t]) for t in page.tag]
    for i in range(1, len(page.tag)):
        good[i] |= good[page.parent[i]]
        bad[i] |= bad[page.parent[i]]
    marked = any(good)
    return np.array([CERTAIN if (g or not marked) and not b else -CERTAIN for g, b in zip(good, bad)])


# --- examples -------------------------------------------------------------------------------


def _escape(text: str) -> str:
    return text.replace("&", "&amp;").replace("<", "&lt;")


def layout(blocks: list[str], others: list[str], rng: random.Random) -> str:
    """A page around an article of these blocks, with the blocks of other pages in its other parts.

    An element that is content has the attribute itemprop="keep", which is no feature.
    """
    pick = lambda n: [_escape(rng.choice(others)) for _ in range(n)]
    some = lambda kind: rng.choice(NAMES[kind].split())
    telling = rng.random() < 0.8

    def part(kind: str, tags: str, inner: str) -> str:
        tag = rng.choice(tags.split())
        named = rng.choice([f' class="{some(kind)}"', f' id="{some(kind)}"', f' class="x-{some(kind)} b{rng.randrange(9)}"'])
        return f"<{tag}{named if telling or tag == 'div' and rng.random() < 0.5 else ''}>{inner}</{tag}>"

    def links(n: int) -> str:
        items = [f'<a href="/{k}">{w}</a>' for k, w in enumerate(" ".join(pick(2)).split()[:n])]
        return rng.choice(["<ul><li>" + "</li><li>".join(items) + "</li></ul>", " ".join(items), "<p>" + " | ".join(items) + "</p>"])

    first, *rest = [_escape(b) for b in blocks] or [""]
    mark = ' itemprop="keep"'
    loose = rng.random() < 0.3
    inner = rng.choice([f"<h1{mark}>{first}</h1>", f"<h2{mark}>{first}</h2>", f"<p{mark}>{first}</p>"])
    for text in rest:
        kind = rng.random()
        if kind < 0.85:
            inner += f"<p{mark}>{rng.choice(['', '<b>', ''])}{text}" + ("<br>" if loose else "</p>")
        elif kind < 0.9:
            inner += f"<ul{mark}><li{mark}>{text}</li></ul>"
        elif kind < 0.95:
            inner += f"<blockquote{mark}>{text}</blockquote>"
        else:
            inner += f"<div{mark}>{text}</div>"
        if rng.random() < 0.05:
            inner += part("advert", "div aside", f"<p>{pick(1)[0]}</p>")
    tag = rng.choice(["article", "article", "main", "div", "section"])
    name = f' class="{some("content")}"' if rng.random() < 0.6 else ""
    article = f"<{tag}{name}{mark}>{inner}</{tag}>"
    comments = "".join(part("comment", "div li", f"<p>{t}</p>") for t in pick(rng.randrange(1, 5)))
    before = [
        part("menu", "nav div header ul", links(rng.randrange(3, 9))),
        part("head", "header div", rng.choice([f"<h1>{pick(1)[0][:30]}</h1>", f"<p>{pick(1)[0][:60]}</p>", links(3)])),
        part("notice", "div section dialog", f"<p>{pick(1)[0]}</p>" + rng.choice(["", links(2)])),
        part("advert", "div aside", rng.choice([pick(1)[0], f"<p>{pick(1)[0]}</p>"])),
    ]
    after = [
        part("side", "aside div", f"<h3>{pick(1)[0][:30]}</h3>" + links(rng.randrange(2, 8)) + "".join(f"<p>{t}</p>" for t in pick(rng.randrange(3)))),
        part("comment", "section div", f"<h3>{pick(1)[0][:20]}</h3>" + comments),
        part("form", "form div", f"<label>{pick(1)[0][:40]}</label><input name=q><p>{pick(1)[0][:50]}</p>"),
        part("advert", "div aside", pick(1)[0]),
        part("share", "div ul", links(3)),
    ]
    foot = part("foot", "footer div", rng.choice([f"&copy; {pick(1)[0]}", f"<p>{pick(1)[0]}</p>" + links(3)]))
    rng.shuffle(before)
    rng.shuffle(after)
    around = before[: rng.randrange(1, 5)] + [article] + after[: rng.randrange(0, 5)]
    if rng.random() < 0.3:
        around = [f"<div>{''.join(around)}</div>"]
    if rng.random() < 0.2:  # comments inside the element that holds the article
        around = [f"<main>{''.join(around)}</main>"]
    return "<html><head><title>x</title></head><body>" + "".join(around) + foot + "</body></html>"


def _marked(page: Page) -> np.ndarray:
    return np.array(["keep" in words for words in page.words])


def examples(htmls: list[str], seed: int = 1) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features, labels and weights of nodes of sampled and generated pages."""
    rng = random.Random(seed)
    sampled = [Page(h) for h in htmls]
    plain = [_by_tag(p) > 0 for p in sampled]
    articles = [p.text(k.tolist()).split("\n\n") for p, k in zip(sampled, plain)]
    pool = [b for a in articles for b in a if b] or ["text"]
    pages, labels = [], []
    for page, keep in zip(sampled, plain):
        if any(_GOOD_TAGS[t] for t in page.tag):
            pages.append(page)
            labels.append(keep)
    for blocks in articles:
        for _ in range(LAYOUTS):
            mixed = [b for b in blocks if b][: rng.randrange(1, 40)]
            page = Page(layout(mixed or ["text"], [b[: rng.choice([20, 60, 200, 2000])] for b in rng.sample(pool, min(len(pool), 20))], rng))
            pages.append(page)
            labels.append(_marked(page))
    x, y = features(pages), np.concatenate(labels).astype(float)
    weight = np.concatenate([np.full(len(p.tag), 30.0 / len(p.tag)) for p in pages])
    return x, y, weight


def fit(pages: DataFrame, sample_pages: int = SAMPLE_PAGES) -> boosting.Boosted | None:
    """Trees learnt from a sample of the pages; None if there are none."""
    html = pages.select(F.col("html").cast("string").alias("html")).filter("html <> ''")
    some = sample(html, sample_pages)
    return boosting.fit(*examples(some)) if some else None


def sample(html: DataFrame, sample_pages: int = SAMPLE_PAGES) -> list[str]:
    """The distinct pages of smallest hash."""
    drawn = html.withColumn("draw", F.xxhash64(F.lit(2), "html"))
    least = [r[0] for r in drawn.select("draw").distinct().orderBy("draw").limit(sample_pages).collect()]
    some = drawn.filter(F.col("draw").isin(least)).groupBy("draw").agg(F.min("html").alias("html"))
    return [r["html"] for r in some.orderBy("draw").collect()]


_RESULT = T.StructType([T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())])


def extract_column(trees, html: Column) -> Column:
    """The main text of a page and its number of code points, by broadcast trees."""

    @arrow_udf(_RESULT)
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            texts = list(extract(batch.to_pylist(), trees.value))
            yield pa.StructArray.from_arrays([pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], _RESULT.names)

    return run.asNondeterministic()(html.cast("string"))


def main_text(pages: DataFrame, sample_pages: int = SAMPLE_PAGES) -> DataFrame:
    """Per row of pages: page_id, url, text, n_chars."""
    trees = pages.sparkSession.sparkContext.broadcast(fit(pages, sample_pages))
    found = pages.select("page_id", "url", extract_column(trees, F.col("html")).alias("r"))
    return found.select("page_id", "url", "r.text", "r.n_chars")
