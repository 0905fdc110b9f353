"""Listing rows and articles on small pages with known answers."""

import datetime

import pytest
from pyspark.sql import functions as F

from hemeroteca.functions import fixed_values as fv
from hemeroteca.operators import article, listing, prefilter
from hemeroteca.operators.outline import outline
from hemeroteca.plans import workflows

SITE = fv.SITE
LONG = "Título suficientemente largo para pasar"


def search(spark, *pages):
    return outline(spark.createDataFrame([(i + 1, h) for i, h in enumerate(pages)], "page int, html string"))


def rows(df):
    return [r.asDict() for r in df.orderBy("page", "pos").collect()]


CARD = (
    '<div><a href="/economia/2025/11/25/uno/"><h2>La cámara presentó su informe anual</h2></a>'
    '<p class="deck">Resumen breve</p><time datetime="2025-11-25">25 Nov</time></div>'
)


def test_one_card(spark):
    (r,) = rows(listing.listing_rows(search(spark, CARD), "q"))
    assert (r["title"], r["url"]) == ("La cámara presentó su informe anual", SITE + "/economia/2025/11/25/uno/")
    assert (r["description"], r["date"], r["search_query"], r["page"]) == ("Resumen breve", "2025-11-25", "q", 1)
    assert isinstance(r["scraped_at"], datetime.datetime)
    (s,) = rows(listing.section_listing_rows(search(spark, CARD)))
    assert (s["title"], s["date"], s["section"]) == ("La cámara presentó su informe anual", "2025-11-25", "economia")


def test_dates_without_attribute_and_with_an_empty_one(spark):
    for time, want in (("<time>ayer</time>", "ayer"), ('<time datetime="">ayer</time>', ""), ("", "")):
        page = f'<li><a href="/economia/a/">{LONG}</a>{time}</li>'
        assert [r["date"] for r in rows(listing.listing_rows(search(spark, page), "q"))] == [want]


TWO_LINKS = f'<li><a href="/politica/a/">Ver</a></li><li><a href="/politica/a/">{LONG}</a></li>'


def test_the_three_ways_to_dedupe(spark):
    pages = search(spark, TWO_LINKS)
    assert rows(listing.listing_rows(pages, "q", first_link_decides=True)) == []
    assert [r["title"] for r in rows(listing.listing_rows(pages, "q"))] == [LONG]
    assert [r["title"] for r in rows(listing.section_listing_rows(pages))] == ["Ver"]


def test_a_later_page_may_supply_a_lost_url(spark):
    again = f'<li><a href="/politica/a/">{LONG} dos</a></li>'
    got = rows(listing.listing_rows(search(spark, TWO_LINKS, again), "q", first_link_decides=True))
    assert [(r["page"], r["title"]) for r in got] == [(2, LONG + " dos")]


def test_a_link_without_container_claims_nothing(spark):
    page = f'<a href="/politica/a/">Ver</a><li><a href="/politica/a/">{LONG}</a></li>'
    assert len(rows(listing.listing_rows(search(spark, page), "q", first_link_decides=True))) == 1
    assert [r["title"] for r in rows(listing.section_listing_rows(search(spark, page)))] == ["Ver"]


@pytest.mark.parametrize("size,kept", [(19, 0), (20, 1)])
def test_title_length(spark, size, kept):
    page = f'<li><a href="/economia/a/">{"t" * size}</a></li>'
    assert len(rows(listing.listing_rows(search(spark, page), "q"))) == kept


def test_short_heading_gives_way_to_link_text(spark):
    page = f'<li><span>Breve</span><a href="/economia/a/">{LONG}</a><h2>{LONG} en h2</h2></li>'
    assert [r["title"] for r in rows(listing.listing_rows(search(spark, page), "q"))] == [LONG]
    page = '<li><a href="/economia/a/">Ver</a><h3>Corto</h3></li>'
    assert [r["title"] for r in rows(listing.section_listing_rows(search(spark, page)))] == ["Corto"]


def test_links_of_one_big_container_share_its_facts(spark):
    links = "".join(f'<a href="/economia/{i}/">{LONG} {i}</a>' for i in range(50))
    got = rows(listing.listing_rows(search(spark, f"<div>{links}<time>hoy</time></div>"), "q"))
    assert len(got) == 50 and {r["date"] for r in got} == {"hoy"}


def test_paging(spark):
    pages = search(
        spark,
        '<a href="?p=2">Página Siguiente</a>',
        '<a rel="next" href="?p=3">&gt;</a>',
        '<a class="pager-next" href="?p=4">&gt;</a>',
        "<button>Siguiente</button>",
        '<span class="next">fin</span>',
        "<p>nada</p>",
        '<a href="?p=8"><b>Siguiente</b></a>',
        '<a href="?p=9"> <b>x</b> Siguiente</a>',
        '<a href="?p=10"><b>x</b>Siguiente</a>',
    )
    links = {r.page: (r.has_next, r.next_href) for r in listing.next_page(pages, "page").collect()}
    assert links == {
        1: (True, "?p=2"), 2: (True, "?p=3"), 3: (True, "?p=4"), 4: (False, None), 5: (False, None), 6: (False, None),
        7: (False, None), 8: (False, None), 9: (True, "?p=10"),
    }
    buttons = {r.page: r.has_next for r in listing.next_page(pages, "page", with_buttons=True).collect()}
    assert buttons == {1: True, 2: False, 3: True, 4: True, 5: True, 6: False, 7: False, 8: False, 9: True}


def test_cut_at_the_first_empty_page(spark):
    def card(n):
        return f'<li><a href="/economia/{n}/">{LONG}</a></li>'

    pages = spark.createDataFrame(
        [(1, card(1)), (2, card(2)), (3, card(1)), (4, card(4))], "page int, html string"
    )
    got = listing.listing_rows(outline(pages), "q")
    assert sorted(r.page for r in got.collect()) == [1, 2, 4]
    assert sorted(r.page for r in listing.cut_at_empty_page(got, pages).collect()) == [1, 2]
    full = pages.where("page <> 3")
    assert sorted(r.page for r in listing.cut_at_empty_page(got, full).collect()) == [1, 2, 4]


def test_resumed_harvest_keeps_old_rows_and_skips_old_pages(spark):
    def card(n):
        return f'<li><a href="/economia/{n}/">{LONG} {n}</a></li>'

    pages = spark.createDataFrame(
        [(1, card(1) + card(2)), (2, card(3)), (3, card(2) + card(4))], "page int, html string"
    )
    when = F.lit(datetime.datetime(2025, 1, 1)).cast("timestamp_ntz")
    first = workflows.harvest_listing(pages, "q", max_pages=1, scraped_at=when)
    both = workflows.harvest_listing(pages, "q", resume_from=first, scraped_at=when)
    assert sorted((r.page, r.url[-2]) for r in both.collect()) == [(1, "1"), (1, "2"), (2, "3"), (3, "4")]


# --- article pages --------------------------------------------------------------------


def page(spark, html, url="https://h/x"):
    return outline(spark.createDataFrame([(url, html)], "url string, html string"))


def one(df):
    return df.first().asDict()


def para(letter, n=31):
    return letter * n


def test_tight_and_spaced_text(spark):
    html = "<article>" + "<p>El presidente<b>Javier Milei</b>habló ante la sala hoy</p>" * 3 + "</article>"
    assert one(article.article_v1(page(spark, html)))["body"].startswith("El presidenteJavier Mileihabló ante la sala hoy\n\n")
    assert one(article.article_v2(page(spark, html)))["body"].startswith("El presidente Javier Milei habló ante la sala hoy\n\n")


def test_body_cascade(spark):
    p, q, a, b, c = (para(x) for x in "PQABC")
    html = (
        f"<article><p>{p}</p><p>{q}</p></article>"
        f'<div class="texto"><p>{a}</p><p>{b}</p><p>{a}</p><p>{c}</p></div>'
    )
    assert one(article.article_v1(page(spark, html)))["body"] == f"{p}\n\n{q}"
    v2 = one(article.article_v2(page(spark, html)))
    assert (v2["body"], v2["paragraphs_count"], v2["body_length"]) == (f"{a}\n\n{b}\n\n{c}", 3, 97)
    v3 = article.article_v3(page(spark, html))
    assert one(v3)["body"] == "" and article.with_body(v3).count() == 0


def test_nested_content_divs_count_once(spark):
    a, b, c = (para(x) for x in "ABC")
    html = f'<div class="Main-Body"><p>{a}</p><div class="story"><p>{b}</p></div><p>{c}</p></div>'
    assert one(article.article_v2(page(spark, html)))["body"] == f"{a}\n\n{b}\n\n{c}"


def test_skip_list(spark):
    plain = "".join(f"<p>{para(x)}</p>" for x in "ABC")
    html = f'<article><p class="share-box">{para("S")}</p>{plain}</article>'
    assert one(article.article_v1(page(spark, html)))["body"].count("\n\n") == 3
    assert one(article.article_v2(page(spark, html)))["paragraphs_count"] == 3
    assert one(article.article_v3(page(spark, html)))["paragraphs_count"] == 3


def test_metadata_lines_go_in_the_last_step(spark):
    html = "<p>Publicado el 25 de noviembre de 2025</p>" + "".join(f"<p>{para(x)}</p>" for x in "ABC")
    assert one(article.article_v2(page(spark, html)))["body"] == "\n\n".join(para(x) for x in "ABC")


@pytest.mark.parametrize("size,v1,v2_last,v2_article", [(20, 0, 0, 0), (21, 3, 0, 0), (29, 3, 0, 0), (30, 3, 3, 3), (31, 3, 3, 3)])
def test_paragraph_lengths(spark, size, v1, v2_last, v2_article):
    ps = "".join(f"<p>{para(x, size)}</p>" for x in "ABC")
    assert one(article.article_v1(page(spark, ps)))["body"].count("x") == 0
    body = one(article.article_v1(page(spark, ps)))["body"]
    assert len([x for x in body.split("\n\n") if x]) == v1
    assert one(article.article_v2(page(spark, ps)))["paragraphs_count"] == v2_last
    # Inside an article 30 characters are too few; the last step then takes them.
    assert one(article.article_v2(page(spark, f"<article>{ps}</article>")))["paragraphs_count"] == v2_article


def test_authors(spark):
    html = '<span class="author"></span><a class="author">Ana</a>'
    for extract in (article.article_v1, article.article_v2, article.article_v3):
        assert one(extract(page(spark, html)))["author"] == ""
    html = '<a class="nota-AUTOR">Ana<b>Paz</b></a><em itemprop="author">Eva</em><div class="x author y">Luz</div>'
    assert one(article.article_v1(page(spark, html)))["author"] == "AnaPaz"
    assert one(article.article_v2(page(spark, html)))["author"] == "Eva"
    assert one(article.article_v3(page(spark, html)))["author"] == ""


def test_dates(spark):
    html = '<time>hoy</time><time datetime="2024-01-02">x</time><span class="date">s</span>'
    assert one(article.article_v1(page(spark, html)))["date"] == ""
    assert one(article.article_v2(page(spark, html)))["date"] == "2024-01-02"
    assert one(article.article_v2(page(spark, html, "https://h/a/2020/03/04/b/")))["date"] == "2020-03-04"
    assert one(article.article_v2(page(spark, '<time datetime=""></time><div class="date">d</div>')))["date"] == "d"
    assert one(article.article_v2(page(spark, '<b itemprop="datePublished">i</b>')))["date"] == "i"


def test_low_content_border(spark):
    bodies = spark.createDataFrame([("a", "x" * 99), ("b", "x" * 100), ("c", ""), ("d", None)], "url string, body string")
    got = {r.url: r.low_content for r in article.flag_low_content(bodies).collect()}
    assert got == {"a": True, "b": False, "c": True, "d": True}


def test_enrichment_prefers_the_listing(spark):
    found = article.article_v3(page(spark, "<h1>De<b>página</b></h1>", "u1"))
    schema = "url string, title string, date string, description string, section string"
    listed = spark.createDataFrame([("u1", "", "2024-01-02", "d", "economia"), ("u2", "t", None, None, None)], schema)
    got = one(article.enrich(listed, found))
    assert (got["title"], got["date"], got["description"], got["section"]) == ("De página", "2024-01-02", "d", "economia")
    got = one(article.enrich(spark.createDataFrame([("u1", "T", None, None, None)], schema), found))
    assert (got["title"], got["date"], got["section"]) == ("T", "", "")


def test_listed_pages_alone_are_extracted(spark, monkeypatch):
    pages = spark.createDataFrame(
        [(f"https://h/{i}", f"<article><p>{para('x', 40)}</p></article>") for i in range(20)], "url string, html string"
    )
    listed = pages.select("url").limit(7)
    small = workflows.harvest_articles(listed, pages).drop("scraped_at")
    monkeypatch.setattr(prefilter.KeyFilter, "may_hold", lambda self, key: key.isNotNull())
    full = workflows.harvest_articles(listed, pages).drop("scraped_at")  # as with a filter that lets all through
    assert small.exceptAll(full).count() == 0 and small.count() == full.count() == 7
    monkeypatch.undo()
    assert workflows.reextract(listed, pages, done=listed.limit(2)).count() == 5


def test_html_is_filtered_before_python_and_never_shuffled(spark, sf):
    from hemeroteca.plans.catalog import QUERIES

    for name in ("harvest_articles", "reextracted_articles", "enriched_articles"):
        plan = QUERIES[name](spark, sf)._jdf.queryExecution().optimizedPlan().toString()
        below = plan[plan.index("MapInArrow") :]
        assert "getbit" in below.lower() or "bit_get" in below.lower() or "0x" in below
        physical = QUERIES[name](spark, sf)._jdf.queryExecution().executedPlan().toString()
        depth = [(len(line) - len(line.lstrip(" :+-")), line) for line in physical.splitlines()]
        first = next(i for i, (_, line) in enumerate(depth) if "MapInArrow" in line)
        assert not any("Exchange hashpartitioning(url" in line for _, line in depth[first + 1 :] if "html" in line)
