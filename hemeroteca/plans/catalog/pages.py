"""Search pages and article pages."""

from __future__ import annotations

from pyspark.sql import functions as F

from hemeroteca.operators import article, listing
from hemeroteca.operators.outline import inner_text, outline
from hemeroteca.plans import inputs, workflows
from hemeroteca.plans.catalog import page_checks as check
from hemeroteca.plans.catalog.registry import query
from hemeroteca.sources.writers import materialise

_TERM = "uno dos"


def _search(spark, sf):
    return outline(inputs.search_pages(spark, sf))


def _articles(spark, sf):
    return outline(inputs.article_pages(spark, sf))


# --- links ---------------------------------------------------------------------------


@query(check.page_links)
def page_links(spark, sf):
    pages = inputs.spread(inputs.table(spark, sf, "pages").select("page_id", "html"))
    return listing.page_links(outline(pages), "page_id").drop("pos")


@query(
    """SELECT page_id, unnest(regexp_extract_all(html, '(?i)<a\\s[^>]*href="([^"]*)"', 1)) AS href FROM pages"""
)
def page_links_by_pattern(spark, sf):
    return listing.page_links_by_pattern(inputs.table(spark, sf, "pages"), "page_id").drop("pos")


@query(check.link_filter_any)
def link_filter_any(spark, sf):
    links = listing.page_links(_search(spark, sf), "page")
    return listing.article_links(links).select("page", "url", "text")


@query(check.link_filter_rooted)
def link_filter_rooted(spark, sf):
    links = listing.page_links(_search(spark, sf), "page")
    return listing.article_links(links, rooted_only=True).select("page", "url", "text")


# --- listing rows -----------------------------------------------------------------------


def _rows(spark, sf, **options):
    return listing.listing_rows(_search(spark, sf), _TERM, **options)


@query(check.listing_first_qualifying)
def listing_first_qualifying(spark, sf):
    return _rows(spark, sf).drop("pos", "scraped_at")


@query(check.listing_first_link)
def listing_first_link(spark, sf):
    return _rows(spark, sf, first_link_decides=True).drop("pos", "scraped_at")


@query(check.listing_sections)
def listing_sections(spark, sf):
    return listing.section_listing_rows(_search(spark, sf)).drop("pos")


@query(check.listing_resumed)
def listing_resumed(spark, sf):
    pages = inputs.search_pages(spark, sf)
    earlier = materialise(workflows.harvest_listing(pages, _TERM, max_pages=5), "earlier")
    return workflows.harvest_listing(pages, _TERM, resume_from=earlier).select("title", "url", "page")


@query(check.page_yield)
def page_yield(spark, sf):
    return listing.page_yield(_rows(spark, sf))


@query(check.cut_at_empty_page)
def cut_at_empty_page(spark, sf):
    pages = inputs.search_pages(spark, sf)
    rows = materialise(listing.listing_rows(outline(pages), _TERM).select("url", "page"), "rows")
    return listing.cut_at_empty_page(rows, pages)


@query(check.structure_profile)
def structure_profile(spark, sf):
    return listing.structure_profile(_search(spark, sf))


@query(check.structure_samples)
def structure_samples(spark, sf):
    return listing.structure_samples(_search(spark, sf), "page").drop("pos")


@query(check.next_page)
def next_page(spark, sf):
    return listing.next_page(_search(spark, sf), "page")


@query(check.next_page_buttons)
def next_page_buttons(spark, sf):
    return listing.next_page(_search(spark, sf), "page", with_buttons=True)


# --- the given pages, whole -----------------------------------------------------------------


def _given(spark, sf):
    pages = inputs.table(spark, sf, "pages").select(F.col("page_id").alias("page"), "html")
    return outline(inputs.spread(pages))


@query(check.given_structure_profile)
def given_structure_profile(spark, sf):
    return listing.structure_profile(_given(spark, sf), sections=("fr", "de"))


@query(check.given_structure_samples)
def given_structure_samples(spark, sf):
    return listing.structure_samples(_given(spark, sf), "page", sections=("fr", "de")).drop("pos")


@query(check.given_next_page)
def given_next_page(spark, sf):
    return listing.next_page(_given(spark, sf), "page")


@query(check.given_next_page_buttons)
def given_next_page_buttons(spark, sf):
    return listing.next_page(_given(spark, sf), "page", with_buttons=True)


# --- articles ----------------------------------------------------------------------------


@query(check.article_v1)
def article_v1(spark, sf):
    return article.article_v1(_articles(spark, sf)).drop("scraped_at")


@query(check.article_v2)
def article_v2(spark, sf):
    return article.article_v2(_articles(spark, sf)).drop("scraped_at")


@query(check.article_v3)
def article_v3(spark, sf):
    return article.article_v3(_articles(spark, sf)).drop("scraped_at")


@query(check.low_content)
def low_content(spark, sf):
    rows = article.flag_low_content(article.article_v2(_articles(spark, sf)))
    return rows.select("url", "body_length", "low_content")


@query(check.articles_with_body)
def articles_with_body(spark, sf):
    return article.with_body(article.article_v3(_articles(spark, sf))).select("url", "body_length")


@query(check.extraction_errors)
def extraction_errors(spark, sf):
    """Some pages end in markup that can't be read: an unknown section, an endless number."""
    broken = """case page_id % 7 when 3 then '<![foo bar]]>' when 5 then concat('&#', repeat('9', 5000), ';') else '' end"""
    pages = inputs.article_pages(spark, sf).withColumn("html", F.concat("html", F.expr(broken)))
    return article.extraction_errors(outline(pages))


@query(check.text_joining)
def text_joining(spark, sf):
    """Where tight joining glues words that spaced joining keeps apart."""
    wanted = F.filter("nodes", lambda n: n["tag"].isin("p", "h1", "span", "a"))
    both = F.transform(
        wanted, lambda n: F.struct(inner_text(n).alias("tight"), inner_text(n, " ").alias("spaced"))
    )
    return _articles(spark, sf).select("page_id", F.inline(both)).where("tight <> spaced")


# --- whole harvests ---------------------------------------------------------------------------


@query(
    f"""SELECT a.* FROM ({check.article_v1}) a WHERE a.url IN (SELECT url FROM ({check.listing_first_qualifying}))"""
)
def harvest_articles(spark, sf):
    rows = materialise(workflows.harvest_listing(inputs.search_pages(spark, sf), _TERM), "listing")
    return workflows.harvest_articles(rows, inputs.article_pages(spark, sf)).drop("scraped_at")


@query(
    f"""SELECT a.* FROM ({check.article_v2}) a
    WHERE a.url IN (SELECT url FROM ({check.listing_first_qualifying}) WHERE page > 3)"""
)
def reextracted_articles(spark, sf):
    rows = materialise(workflows.harvest_listing(inputs.search_pages(spark, sf), _TERM), "listing")
    done = rows.where("page <= 3")
    return workflows.reextract(rows, inputs.article_pages(spark, sf), done).drop("scraped_at")


@query(
    f"""SELECT a.url, coalesce(nullif(l.title, ''), a.page_title) AS title, a.author, l.date, a.body, l.description,
    l.section, a.body_length, a.paragraphs_count FROM ({check.article_v3}) a JOIN ({check.listing_sections}) l USING (url)
    WHERE a.body <> ''"""
)
def enriched_articles(spark, sf):
    articles = workflows.harvest_enriched(
        inputs.search_pages(spark, sf), inputs.article_pages(spark, sf), target=None
    )
    return articles.drop("scraped_at")
