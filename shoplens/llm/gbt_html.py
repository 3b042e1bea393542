"""Main-text extraction with gradient-boosted trees over DOM nodes.

A page is parsed into its block elements; inline markup only adds to the text
of its block. Each node gets features of its subtree (text and link density,
tags, sentences), its attribute tokens, its depth and its siblings. Boosted
trees give the log odds that a node belongs to the article. Decoding takes the
whole tree: dropping a node drops all below it and costs their log odds,
keeping it leaves the choice to its children, so no kept node stands below a
dropped one. The kept blocks are the text, in page order.

The trees are trained here, with Spark's boosted trees, on a bounded sample of
pages (``SAMPLE``, by hash of the id). What stands in a page's article element
is positive, the rest negative; in pages without one, known layout elements
(navigation, adverts, footers, asides, forms, comments) are negative. Each page
is also used in a second form, in which layout and article elements carry other
common tags and attributes, so that the trees don't lean on one template, and
a share of the second forms once more in disguise, without any such tag or
word or with misleading ones, so that text, links and place decide there.

Defined cases: null html is empty and gives the empty string; a page without
elements is one block of text; unclosed and misplaced tags are closed the way
browsers do for blocks, also a head without end; scripts, styles, comments, templates and the head never
count as text; pages of any length are parsed whole; repeated rows each get a
row; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import html as entities
import random
import re

import numpy as np
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shoplens.llm.common import map_rows, prepare, spread, table, texts_of

SAMPLE, TREES, DEPTH, SEED = 300, 20, 4, 7
DISGUISED = 0.3  # share of the pages
TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<(script|style|noscript|template|svg|iframe|title)\b(?:[^>"']|"[^"]*"|'[^']*')*>.*?(?:</\1\s*>|\Z)"""
    r"""|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*)>|<[!?][^>]*>""",
    re.S | re.I,
)
ATTRIBUTE = re.compile(r"""\b(class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.I)
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr input button select option textarea picture source video audio".split())
#: Elements of a head besides those whose text never counts; any other ends it.
HEAD = frozenset("head meta link base basefont bgsound".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements that end an open paragraph, and those that end an open one of their kind.
ENDS_P = frozenset("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre search section summary table ul li".split())
OWN_KIND = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
FENCE = frozenset("ul ol dl table body html article section div nav aside footer header main form blockquote".split())
LAYOUT = frozenset("nav menu menubar navigation breadcrumb breadcrumbs footer header masthead sidebar aside complementary ad ads advert advertisement adsense sponsor sponsored promo banner cookie cookies consent notice alert popup modal newsletter subscribe signup login form search share sharing social related recommended comment comments reply replies disqus pagination pager toolbar widget copyright legal toc tags meta".split())
MAIN = frozenset("article main content post entry story body text maincontent articlebody".split())
WORDS = re.compile(r"[a-z]+")
TAGS = ("p", "h", "list", "div", "nav", "foot", "side", "main", "section", "form", "table", "root", "quote")
KIND = {"p": 0, **{f"h{k}": 1 for k in range(1, 7)}, "ul": 2, "ol": 2, "li": 2, "dl": 2, "div": 3, "nav": 4, "menu": 4, "footer": 5, "header": 5, "aside": 6, "article": 7, "main": 7, "section": 8, "form": 9, "fieldset": 9, "table": 10, "tr": 10, "td": 10, "body": 11, "html": 11, "": 11, "blockquote": 12, "pre": 12}


class Page:
    """Block elements of a page in page order, and their texts.

    ``parent``, ``tags``, ``tokens``: of each node (0 is the page). ``blocks``:
    (node, text) of each run of text between block boundaries."""

    def __init__(self, html: str):
        self.parent, self.tags, self.tokens = [-1], [""], [frozenset()]
        self.blocks: list[tuple[int, str]] = []
        self.links, self.marks = [0], [0]
        self._run: list[str] = []
        open_, at, in_link, in_head = [0], 0, False, False
        for m in TOKEN.finditer(html):
            if m.start() > at:
                in_head = in_head and not html[at : m.start()].strip()
                if not in_head:
                    self._text(html[at : m.start()], open_[-1], in_link)
            at = m.end()
            name = m[3]
            if name is None:
                continue
            name, ends = name.lower(), bool(m[2])
            if name == "head" or in_head and name in HEAD:
                in_head = not (name == "head" and ends)
                continue
            in_head = False
            self.marks[open_[-1]] += 1
            if name in INLINE:
                if name == "a":
                    in_link = not ends
                elif name == "br":
                    self._run.append(" ")
                continue
            if ends:
                for k in range(len(open_) - 1, 0, -1):
                    if self.tags[open_[k]] == name:
                        self._close(open_[-1])
                        del open_[k:]
                        break
                continue
            self._close(open_[-1])
            if name in ENDS_P:
                self._end(open_, ("p",))
            if name in OWN_KIND:
                self._end(open_, OWN_KIND[name])
            self.parent.append(open_[-1])
            self.tags.append(name)
            self.links.append(0)
            self.marks.append(0)
            words = " ".join(v for _, v in ATTRIBUTE.findall(m[4])).lower() if m[4] else ""
            self.tokens.append(frozenset(WORDS.findall(words)) if words else frozenset())
            if name not in VOID:
                open_.append(len(self.tags) - 1)
        if at < len(html):
            self._text(html[at:], open_[-1], in_link)
        self._close(open_[-1])

    def _text(self, text: str, node: int, in_link: bool) -> None:
        if "&" in text:
            text = entities.unescape(text)
        self._run.append(text)
        if in_link:
            self.links[node] += len(text)

    def _close(self, node: int) -> None:
        if self._run:
            text = " ".join("".join(self._run).split())
            self._run.clear()
            if text:
                self.blocks.append((node, text))

    def _end(self, open_: list[int], names: tuple[str, ...]) -> None:
        for k in range(len(open_) - 1, 0, -1):
            tag = self.tags[open_[k]]
            if tag in names:
                del open_[k:]
                return
            if tag in FENCE:
                return

    def features(self) -> np.ndarray:
        """One row for each node."""
        n = len(self.parent)
        parent = np.array(self.parent)
        own, stops, runs = np.zeros(n), np.zeros(n), np.zeros(n)
        begin = np.full(n, np.inf)
        at = 0
        for node, text in self.blocks:
            own[node] += len(text)
            stops[node] += text.count(". ") + text.count("? ") + text.count("! ") + (text[-1] in ".?!")
            runs[node] += 1
            begin[node] = min(begin[node], at)
            at += len(text)
        size, sentences, blocks, links, marks = own.copy(), stops.copy(), runs.copy(), np.array(self.links, float), np.array(self.marks, float)
        paragraphs = np.array([t == "p" for t in self.tags], float)
        children = np.bincount(parent[1:], minlength=n).astype(float)
        for v in range(n - 1, 0, -1):  # children come after their parents
            p = self.parent[v]
            for x in (size, sentences, blocks, links, marks, paragraphs):
                x[p] += x[v]
            begin[p] = min(begin[p], begin[v])
        depth, against, toward = np.zeros(n), np.zeros(n), np.zeros(n)
        layout = np.array([float(t in LAYOUT or bool(a & LAYOUT)) for t, a in zip(self.tags, self.tokens, strict=True)])
        main = np.array([float(t in ("article", "main") or bool(a & MAIN)) for t, a in zip(self.tags, self.tokens, strict=True)])
        place, seen = np.zeros(n), np.zeros(n, int)
        before, after, last = np.zeros(n), np.zeros(n), {}
        same = np.zeros(n)
        kinds: dict[tuple[int, str], int] = {}
        for v in range(1, n):
            p = self.parent[v]
            depth[v], against[v], toward[v] = depth[p] + 1, against[p] + layout[p], toward[p] + main[p]
            place[v], seen[p] = seen[p], seen[p] + 1
            if p in last:
                before[v], after[last[p]] = size[last[p]], size[v]
            last[p] = v
            kinds[p, self.tags[v]] = kinds.get((p, self.tags[v]), 0) + 1
        for v in range(1, n):
            same[v] = kinds[self.parent[v], self.tags[v]]
        siblings = np.maximum(children[parent], 1)
        siblings[0] = 1
        total = max(at, 1)
        kind = np.array([KIND.get(t, -1) for t in self.tags])
        columns = [
            depth, np.log1p(size), np.log1p(own), links / np.maximum(size, 1), marks / (1 + size), children, place / siblings, siblings, same / siblings,
            np.log1p(paragraphs), sentences / (1 + size), np.log1p(size / np.maximum(blocks, 1)), layout, main, np.minimum(against, 3), np.minimum(toward, 3),
            np.where(np.isfinite(begin), begin, total) / total, size / total, np.log1p(before), np.log1p(after),
            *[(kind == k).astype(float) for k in range(len(TAGS))],
        ]
        return np.stack(columns, 1)

    def decode(self, odds: np.ndarray) -> list[str]:
        """The blocks of the best consistent choice of nodes; log odds."""
        n = len(self.parent)
        drop, keep = -odds.astype(float), odds.astype(float)
        for v in range(n - 1, 0, -1):
            p = self.parent[v]
            keep[p] += max(keep[v], drop[v])
            drop[p] += drop[v]
        kept = np.zeros(n, bool)
        kept[0] = True  # the page itself
        for v in range(1, n):
            kept[v] = kept[self.parent[v]] and keep[v] > drop[v]
        return [text for node, text in self.blocks if kept[node]]


class Trees:
    """Boosted trees as arrays: log odds of the rows of a feature matrix."""

    def __init__(self, model: GBTClassificationModel):
        self.trees, self.weights = [], list(model.treeWeights)
        for tree in model.trees:
            nodes: list[tuple[int, float, int, int, float]] = []

            def add(node, nodes=nodes) -> int:
                k = len(nodes)
                nodes.append((-1, 0.0, k, k, node.prediction()))
                if node.numDescendants():
                    split = node.split()
                    left, right = add(node.leftChild()), add(node.rightChild())
                    nodes[k] = (split.featureIndex(), split.threshold(), left, right, 0.0)
                return k

            add(tree._java_obj.rootNode())
            self.trees.append([np.array(c) for c in zip(*nodes, strict=True)])

    def odds(self, x: np.ndarray) -> np.ndarray:
        total = np.zeros(len(x))
        rows = np.arange(len(x))
        for w, (feature, cut, left, right, value) in zip(self.weights, self.trees, strict=True):
            at = np.zeros(len(x), int)
            for _ in range(DEPTH):
                at = np.where(x[rows, feature[at]] <= cut[at], left[at], right[at])
            total += w * value[at]
        return 2 * total


#: Other forms of layout and article elements for the second form of a page.
LAYOUTS = ('aside class="sidebar"', 'div class="cookie-notice"', 'section id="comments"', "form", "header", 'div class="related"', 'div class="widget"', 'div id="newsletter"', 'div role="navigation"', 'div class="share"', 'ol class="comment-list"', 'div class="promo"')
ARTICLES = ("main", 'div class="post-content"', 'div id="content"', 'div class="entry"', "section", "div")


def _answers(page: Page) -> np.ndarray:
    """1 for nodes of the article, 0 for layout and what stands in it."""
    out = np.ones(len(page.parent))
    for v in range(1, len(page.parent)):
        layout = page.tags[v] in LAYOUT or bool(page.tokens[v] & LAYOUT)
        out[v] = out[page.parent[v]] if not layout else 0
    return out


def _in_article(page: Page) -> np.ndarray:
    """1 for nodes in an article element and around one; ``_answers`` of a page
    without any."""
    out = np.array([float(t == "article") for t in page.tags])
    if not out.any():
        return _answers(page)
    for v in range(1, len(out)):
        out[v] = max(out[v], out[page.parent[v]])
    for v in range(len(out) - 1, 0, -1):
        out[page.parent[v]] = max(out[page.parent[v]], out[v])
    out[0] = 1
    return out


def _disguise(page: Page, answers: np.ndarray, rng: random.Random, misleading: bool) -> None:
    """Take the words and tags of layout and article away from the page, or
    give some to nodes of the other side."""
    layout, main = sorted(LAYOUT), sorted(MAIN)
    children = set(page.parent)
    for v in range(1, len(page.tags)):
        if page.tags[v] in LAYOUT or page.tags[v] in ("article", "main", "section"):
            page.tags[v] = "div"
        page.tokens[v] = frozenset()
        if misleading and v in children and rng.random() < 0.5:
            page.tokens[v] = frozenset([rng.choice(layout if answers[v] else main)])


def _reform(html: str, rng: random.Random) -> str:
    """The page with other tags for layout and article, and layout within the
    article too."""
    inner = [m[0] for m in re.finditer(r'<div class="ad">.*?</div>|<footer>.*?</footer>', html, re.S)]

    def other(_: re.Match) -> str:
        form = rng.choice(LAYOUTS)
        text = re.sub(r"<[^>]*>", " ", rng.choice(inner)) if inner else "More"
        body = f"<p>{text}</p>" * rng.randint(1, 4) if rng.random() < 0.5 else text
        return f"<{form}>{body}</{form.split()[0]}>"

    html = re.sub(r'<div class="ad">.*?</div>', lambda m: other(m) + other(m), html, flags=re.S)
    html = re.sub(r"<footer>", lambda m: other(m) + m[0], html)
    paragraphs = [m.end() for m in re.finditer(r"</p>", html)]
    for at in sorted(rng.sample(paragraphs, min(2, len(paragraphs))), reverse=True):
        html = html[:at] + other(None) + html[at:]
    article = rng.choice(ARTICLES)
    return html.replace("<article>", f"<{article}>").replace("</article>", other(None) + f"</{article.split()[0]}>")


def train(spark: SparkSession, pages: list[str]) -> Trees | None:
    """The trees from sampled pages; None without any."""
    rng, rows = random.Random(SEED), []
    for html in pages:
        other = _reform(html, rng)
        for form, misleading in ((html, None), (other, None), (other, rng.random() < 0.5)):
            page = Page(form)
            answers = _in_article(page) if form is html else _answers(page)
            if misleading is not None and rng.random() < DISGUISED:
                _disguise(page, answers, rng, misleading)
            rows += [(float(y), Vectors.dense(x)) for x, y in zip(page.features(), answers, strict=True)]
    if len({y for y, _ in rows}) < 2:
        return None
    data = spark.createDataFrame(rows, ["label", "features"]).repartition(2).cache()
    try:
        return Trees(GBTClassifier(maxIter=TREES, maxDepth=DEPTH, stepSize=0.3, seed=SEED).fit(data))
    finally:
        data.unpersist()


def sample(pages: DataFrame, size: int = SAMPLE, id_col: str = "page_id", html_col: str = "html") -> list[str]:
    """At most ``size`` pages, by hash of the id."""
    ids = pages.select(id_col).where(F.col(id_col).isNotNull()).orderBy(F.xxhash64(id_col), id_col).limit(size)
    rows = pages.select(id_col, html_col).join(F.broadcast(ids), id_col, "left_semi").where(F.col(html_col).isNotNull()).orderBy(id_col).limit(size)
    return [r[html_col] for r in rows.collect()]


def main_texts(pages: DataFrame, keep: list[str], id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """The ``keep`` columns with ``text`` and ``n_chars``."""
    spark = pages.sparkSession
    prepare(spark)
    trees = train(spark, sample(pages, id_col=id_col, html_col=html_col))

    def run(batch):
        texts, chars = [], []
        pages_of = texts_of(batch, html_col)
        for k in range(0, len(pages_of), 256):
            some = [Page(h) for h in pages_of[k : k + 256]]
            features = [p.features() for p in some]
            odds = trees.odds(np.concatenate(features)) if trees else np.ones(sum(map(len, features)))
            at = 0
            for p, f in zip(some, features, strict=True):
                texts.append("\n\n".join(p.decode(odds[at : at + len(f)])))
                chars.append(len(texts[-1]))
                at += len(f)
        return {"text": texts, "n_chars": chars}

    return map_rows(spread(pages.select(*dict.fromkeys([*keep, html_col]))), keep, "text string, n_chars long", run)


def op6_gbt_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of all pages."""
    return main_texts(table(spark, sf_dir, "pages"), ["page_id", "url"])
