"""The operators on pages against independent readings."""

from __future__ import annotations

import hashlib
import random
from html.parser import HTMLParser

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from shoplens.llm import gbt_html, warc
from shoplens.session import work_path


SF_SMALL = "/root/testdata/sf0.001"


class Reader(HTMLParser):
    """Blocks of text inside <article>, by another parser."""

    BLOCK = {"p", "h1", "article", "div", "nav", "footer", "ul", "li"}

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.inside, self.blocks, self.run = False, [], []

    def flush(self):
        text = " ".join("".join(self.run).split())
        self.run = []
        if text:
            self.blocks.append(text)

    def handle_starttag(self, tag, attrs):
        if tag in self.BLOCK:
            self.flush()
        if tag == "br":
            self.run.append(" ")
        self.inside |= tag == "article"

    def handle_endtag(self, tag):
        if tag in self.BLOCK:
            self.flush()
        if tag == "article":
            self.inside = False

    def handle_data(self, data):
        if self.inside:
            self.run.append(data)


def article(html):
    r = Reader()
    r.feed(html or "")
    r.flush()
    return "\n\n".join(r.blocks)


def test_main_texts_of_the_given_pages(spark):
    got = {r.page_id: r for r in gbt_html.op6_gbt_html(spark, SF_SMALL).collect()}
    pages = spark.read.parquet(f"{SF_SMALL}/pages.parquet").collect()
    assert len(got) == len(pages)
    assert sum(got[p.page_id].text == article(p.html) for p in pages) >= 0.97 * len(pages)
    assert all(r.n_chars == len(r.text) for r in got.values())


@pytest.fixture(scope="module")
def trees(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    return gbt_html.train(spark, gbt_html.sample(pages.where("page_id % 2 = 0"))), [r.html for r in pages.where("page_id % 2 = 1").collect()]


def test_held_out_nodes_in_other_templates(trees):
    """Pages that were not sampled, with other tags for layout and article."""
    model, pages = trees
    rng, right, total = random.Random(99), 0, 0
    for html in pages:
        page = gbt_html.Page(gbt_html._reform(html, rng))
        answers = gbt_html._answers(page)
        wanted = [t for node, t in page.blocks if answers[node]]
        got = page.decode(model.odds(page.features()))
        right += len(set(wanted) & set(got)) * 2
        total += len(set(wanted)) + len(set(got))
    assert right / total >= 0.95


def test_no_kept_node_below_a_dropped_one():
    rng = np.random.default_rng(0)
    html = "<div>a<section>b<p>c</p></section><ul><li>d<li>e</ul></div><p>f"
    page = gbt_html.Page(html)
    for _ in range(200):
        odds = rng.normal(size=len(page.parent)) * 2
        n, best = len(page.parent), None
        for mask in range(2 ** (n - 1)):
            keep = [True, *[bool(mask >> k & 1) for k in range(n - 1)]]
            if all(keep[page.parent[v]] or not keep[v] for v in range(1, n)):
                value = sum(odds[v] if keep[v] else -odds[v] for v in range(1, n))
                if best is None or value > best[0]:
                    best = value, keep
        assert page.decode(odds) == [t for node, t in page.blocks if best[1][node]]


def test_parsing_of_odd_pages():
    page = lambda h: [t for _, t in gbt_html.Page(h).blocks]
    assert page("") == [] and page("just text &amp; more") == ["just text & more"]
    assert page('<p><b>One<br>two<p>three <a href="x>y">four</a></p>tail') == ["One two", "three four", "tail"]
    assert page("<script>var a='<p>no</p>'</script><style>p{}</style><!-- <p>no --><p>yes") == ["yes"]
    assert page("<p>&lt;b&gt; &copy; &#233;&nbsp; x</p></div></p>end") == ["<b> © é x", "end"]
    assert page("<ul><li>a<ul><li>b</ul><li>c</ul>") == ["a", "b", "c"]
    assert page("<title>t</title><p>unclosed <b>bold<div>next") == ["unclosed bold", "next"]
    assert len(page("<div>" * 5000 + "deep")) == 1


@settings(max_examples=100, deadline=None)
@given(st.text(alphabet="<>/ab p\"'=!-&;\n", max_size=60))
def test_any_text_parses(text):
    page = gbt_html.Page(text)
    assert page.features().shape[0] == len(page.parent)
    page.decode(np.zeros(len(page.parent)))


CASES = [(1, "http://a/x", "<html lang=en><head><title>T &amp; U</title><meta charset=utf-8></head><body><p>one<p>two <a href='/l'>link</a></body></html>"),
         (2, None, None), (3, "http://b", ""), (4, "http://c", "plain\r\n\r\ntext"), (4, "http://c", "plain\r\n\r\ntext"), (None, "http://d\r\nX: y", "<p>" + "long " * 50_000)]
SCHEMA = "page_id long, url string, html string"


def odd_pages(spark):
    from pyspark.sql import functions as F

    return spark.createDataFrame(CASES, SCHEMA).withColumns({c: F.lit("clash") for c in ("text", "n_chars", "block", "type", "payload", "derived")})


def test_main_texts_of_odd_pages(spark):
    got = gbt_html.main_texts(odd_pages(spark), ["page_id", "url"]).collect()
    assert len(got) == len(CASES)
    by = {r.page_id: r.text for r in got}
    assert by[2] == by[3] == "" and by[4] == "plain text"
    none = spark.createDataFrame([], SCHEMA)
    assert gbt_html.main_texts(none, ["page_id"]).collect() == []


def test_warc_derivatives(spark):
    source = {r.record_id: r for r in warc.responses(odd_pages(spark)).collect()}
    got = warc.derive(warc.responses(odd_pages(spark))).collect()
    assert len(got) == 2 * len(CASES)
    for r in got:
        s = source[r.refers_to]
        assert (r.target_uri, r.date, r.source_digest) == (s.target_uri, s.date, s.payload_digest)
        assert r.source_digest == "sha256:" + hashlib.sha256(s.payload.encode()).hexdigest()
        assert r.block_digest == "sha256:" + hashlib.sha256(r.block.encode()).hexdigest() and r.content_length == len(r.block.encode())
        assert "\n" not in r.target_uri
        if r.type == "metadata":
            assert all(f"source-header: {h}\r\n" in r.block for h in s.http_header.split("\r\n"))
    first = {r.type: r.block for r in got if r.source_row == 1}
    assert first["conversion"] == "one\ntwo link"
    assert first["metadata"].startswith("title: T & U\r\nlanguageOfPage: en\r\ncharset: utf-8\r\noutlink: /l\r\n")
    assert warc.derive(warc.responses(spark.createDataFrame([], SCHEMA))).collect() == []


def test_warc_files_round_trip(spark):
    records = warc.derive(warc.responses(odd_pages(spark)))
    path = work_path(spark, "warc")
    warc.write_warc(records, path)
    got = sorted((r.header["WARC-Record-ID"], r.header["WARC-Refers-To"], r.header["WARC-Type"], r.header["WARC-Block-Digest"], r.block) for r in warc.read_warc(spark, path).collect())
    assert got == sorted((r.record_id, r.refers_to, r.type, r.block_digest, r.block) for r in records.collect())


def test_a_head_without_end(spark):
    page = lambda h: [t for _, t in gbt_html.Page(h).blocks]
    for end in ("<body>", "</head><body>", "", "</HEAD>\n"):
        assert page(f"<html><head>\n<title>T</title> <meta charset=utf-8><link rel=x><style>p{{}}</style>{end}<p>one<p>two") == ["one", "two"]
    assert page("<head><title>T</title>text") == ["text"]
    rows = spark.createDataFrame([(1, "http://a", "<head><title>T</title><body><p>one<p>two")], SCHEMA)
    assert [r.block for r in warc.derive(warc.responses(rows)).collect() if r.type == "conversion"] == ["one\ntwo"]


@pytest.mark.parametrize("misleading", [False, True])
def test_held_out_nodes_without_telling_words(trees, misleading):
    """Pages that were not sampled, with no words of layout, or with wrong ones."""
    model, pages = trees
    rng, right, total = random.Random(98), 0, 0
    for html in pages:
        page = gbt_html.Page(gbt_html._reform(html, rng))
        answers = gbt_html._answers(page)
        gbt_html._disguise(page, answers, rng, misleading)
        wanted = [t for node, t in page.blocks if answers[node]]
        got = page.decode(model.odds(page.features()))
        right += len(set(wanted) & set(got)) * 2
        total += len(set(wanted)) + len(set(got))
    print("F1", misleading, right / total)
    assert right / total >= 0.9


def test_wrappers_named_like_layout(trees):
    model, pages = trees
    some = [h for h in pages if "<article>" in h][:50]
    kept = 0
    for html in some:
        page = gbt_html.Page(html.replace("<body>", "<body class='has-sidebar'><form id='form1'>"))
        kept += bool(page.decode(model.odds(page.features())))
    print("kept", kept, len(some))
    assert kept >= 0.95 * len(some)
