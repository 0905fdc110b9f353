"""The page tree: what is open when, and what counts as text."""

import random

from pyspark.sql import functions as F

from hemeroteca.operators import article
from hemeroteca.operators import outline as ol


def outlined(spark, *pages):
    rows = [(i, f"u{i}", h) for i, h in enumerate(pages)]
    return ol.outline(spark.createDataFrame(rows, "page_id long, url string, html string"))


def tree(spark, page):
    r = outlined(spark, page).first()
    return [(n.tag, n.pos, n.stop, n.ctr, r.texts[n.t0 : n.t1]) for n in r.nodes], r.texts


def test_nesting_and_text(spark):
    nodes, texts = tree(spark, "<div>a<p>b<b>c</b></p></div><li>d</li>")
    assert texts == ["a", "b", "c", "d"]
    assert nodes == [
        ("div", 0, 2, -1, ["a", "b", "c"]),
        ("p", 1, 2, 0, ["b", "c"]),
        ("li", 2, 3, -1, ["d"]),
    ]


def test_an_open_paragraph_holds_the_next_one(spark):
    nodes, _ = tree(spark, "<article><p><b>Uno<br><p>Dos</p></article><p>Tres")
    assert [(t, x) for t, _, _, _, x in nodes] == [
        ("article", ["Uno", "Dos"]), ("p", ["Uno", "Dos"]), ("p", ["Dos"]), ("p", ["Tres"]),
    ]


def test_stray_end_tags_and_void_elements(spark):
    nodes, texts = tree(spark, "<div>a</p><img class=x>b</span></div>c<br/>d")
    assert texts == ["a", "b", "c", "d"]
    assert nodes == [("div", 0, 2, -1, ["a", "b"]), ("img", 1, 2, 0, [])]


def test_silent_text_comments_and_entities(spark):
    nodes, texts = tree(
        spark,
        "<!DOCTYPE html><style>p{}</style><p>x<!-- no --> y <script>var p='</p>';</script>&amp;&eacute; &nbsp;</p>"
        "<template><p>oculto</p></template><![CDATA[z]]>",
    )
    assert texts[:3] == ["x", "y", "&é"]
    assert ("p", ["x", "y", "&é"]) in [(t, x) for t, _, _, _, x in nodes]
    assert "oculto" not in texts


def test_attributes(spark):
    r = outlined(spark, '<A HREF="/x" class="  a   b " rel=next>t</A><em itemprop="author">e</em><b>no</b>').first()
    a, em = r.nodes
    assert (a.tag, a.href, a.cls, a.rel) == ("a", "/x", "a b", "next")
    assert (em.tag, em.itemprop, em.cls) == ("em", "author", None)


def test_many_pages_cross_flush_borders(spark, monkeypatch):
    monkeypatch.setattr(ol, "_FLUSH_CHARS", 50)
    pages = [f"<p>{'x' * (i % 70)}{i}</p><a href='{i}'>{i}</a>" for i in range(300)]
    rows = outlined(spark, *pages).collect()
    assert len(rows) == 300
    assert all(r.nodes[1].href == str(r.page_id) and r.texts[-1] == str(r.page_id) for r in rows)


def test_failures_are_rows_not_crashes(spark, monkeypatch):
    push = ol._PageReader._push

    def broken(self, tag, attrs):
        if tag == "boom":
            raise RuntimeError("no")
        push(self, tag, attrs)

    monkeypatch.setattr(ol._PageReader, "_push", broken)
    out = outlined(spark, "<p>a</p>", "<p>lost<boom>", "<p>b</p>", None)
    got = {r.page_id: (r.error, len(r.nodes), r.texts) for r in out.collect()}
    assert got == {0: (None, 1, ["a"]), 1: ("RuntimeError: no", 0, []), 2: (None, 1, ["b"]), 3: (None, 0, [])}
    counts = {r.outcome: r.n for r in article.extraction_errors(out).collect()}
    assert counts == {"ok": 3, "RuntimeError": 1}
    assert article.article_v2(out).count() == 3


def test_columns_pass_through(spark):
    df = spark.createDataFrame([(7, "<p>a</p>", 1.5)], "k int, html string, w double")
    assert ol.outline(df).columns == ["k", "w", "error", "texts", "nodes"]
    assert ol.outline(df).select("k", "w", F.size("nodes")).first() == (7, 1.5, 1)


MARKUP = (
    """<p>|</p>|<div class="a  B">|</div>|<br>|<br/>|<li>|<a href="/x?a=1&amp;b=2&copy=3" rel=next>|<a href="/y">|</a>|text| |"""
    """&amp;|&eacute|&copy;|<|>|"|'|<!-- c -->|<!---->|<!-->|<!-- a -- b -->|<script>|var a="<p>";|</script>|</SCRIPT >|<style>|"""
    """</style>|<title>|</title>|<textarea>|</textarea>|<xmp>|<b|<p class=x>|<p class='y'>|</p x="1">|<P CLASS="Q" disabled>|"""
    """<!DOCTYPE html>|<?php ?>|<![CDATA[x]]>|<template>|</template>|<em itemprop="author">|</em>|<article>|</article>|<h1>|"""
    """</h1>|</|&|&#233;|\n|<p\n class="z"\n>|<span class="">|</span>|<img src="a" alt="<b>">|<rt>|</rt>|<time datetime="">|"""
    """</time>|<a class="b"href="c">|-->|<script/>|<div/>"""
).split("|")


def read(page, plainly):
    reader = ol._PageReader()
    reader.read(page, plainly)
    return reader.nodes, reader.texts


def test_the_short_way_and_the_library_parser_agree():
    rng, plain = random.Random(3), 0
    for _ in range(15000):
        page = "".join(rng.choice(MARKUP) for _ in range(rng.randint(0, 9)))
        assert read(page, True) == read(page, False), page
        probe = ol._PageReader()
        probe._begin()
        plain += probe._read_plain(page)
    assert 3000 < plain < 12000, "both ways must have been taken"


def test_the_short_way_on_the_given_pages(spark, sf):
    pages = [r.html for r in spark.read.parquet(f"{sf}/pages.parquet").select("html").collect()]
    cut = [p[: len(p) * k // 7] for p in pages[:10] for k in range(1, 7)]
    for page in pages + cut:
        assert read(page, True) == read(page, False)
