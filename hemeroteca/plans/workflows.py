"""The reference workflows end to end: harvest, re-extract, clean and report."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hemeroteca.operators import article, cleaning, dedupe, listing, quality
from hemeroteca.operators.outline import outline
from hemeroteca.operators.prefilter import kept_by_keys
from hemeroteca.sources.writers import materialise


def harvest_listing(
    search_pages: DataFrame,
    search_query: str,
    resume_from: DataFrame | None = None,
    max_pages: int | None = None,
    scraped_at: Column | None = None,
    **options,
) -> DataFrame:
    """Stage 1: search pages to listing rows, earlier rows first and never repeated.

    ``resume_from`` holds the rows of an earlier run; pages up to its last one are
    skipped and its URLs are not listed again.
    """
    pages = search_pages
    if max_pages is not None:
        pages = pages.where(F.col("page") <= max_pages)
    if resume_from is None:
        return listing.listing_rows(outline(pages), search_query, scraped_at=scraped_at, **options)
    last_page = resume_from.agg(F.coalesce(F.max("page"), F.lit(0))).scalar()
    rows = listing.listing_rows(
        outline(pages.where(F.col("page") > last_page)),
        search_query,
        scraped_at=scraped_at,
        seen=resume_from,
        **options,
    )
    return dedupe.append_rows(resume_from, rows)


def extract_listed(listed: DataFrame, pages: DataFrame, extract) -> DataFrame:
    """Extract the pages whose URL is listed, without ever shuffling their HTML.

    Bloom filters of bounded size drop pages where they lie, before their HTML reaches
    Python; the few strangers that pass cost a parse, and the exact semi join on the far
    smaller records drops them.  A URL set too long for one filter is met in groups of
    the pages' files, named by their column ``file`` (see ``read_pages``); without that
    column, in groups of URLs, each of which reads all pages.  The URL set is stored first.
    """
    urls = materialise(listed.select("url").distinct(), "urls")
    by = "file" if "file" in pages.columns else None
    kept = kept_by_keys(pages.select("url", "html", *[by] * (by is not None)), urls, "url", by)
    return extract(outline(kept.select("url", "html"))).join(urls, "url", "left_semi")


def harvest_articles(
    listed: DataFrame, pages: DataFrame, done: DataFrame | None = None, scraped_at: Column | None = None
) -> DataFrame:
    """Stage 2, first form: articles for listed URLs that are not finished yet."""
    backlog = listed if done is None else dedupe.resume_backlog(listed, done)
    return extract_listed(backlog, pages, lambda o: article.article_v1(o, scraped_at))


def reextract(
    listed: DataFrame, pages: DataFrame, done: DataFrame | None = None, scraped_at: Column | None = None
) -> DataFrame:
    """Re-extraction form: fresh bodies for listed URLs that are not finished yet."""
    backlog = listed if done is None else dedupe.resume_backlog(listed, done)
    return extract_listed(backlog, pages, lambda o: article.article_v2(o, scraped_at))


def harvest_enriched(
    search_pages: DataFrame,
    pages: DataFrame,
    target: int | None = None,
    scraped_at: Column | None = None,
) -> DataFrame:
    """Both stages, third form: section listing, extraction, and the listing's own fields.

    ``target`` stops after so many listing rows, in crawl order.
    """
    rows = materialise(listing.section_listing_rows(outline(search_pages)), "listing")
    if target is not None:
        rows = listing.take_target(rows, target)
    extracted = extract_listed(rows, pages, lambda o: article.article_v3(o, scraped_at))
    return article.with_body(article.enrich(rows, extracted))


def clean_and_report(
    articles: DataFrame, *sections: str, profile: str = "final", out: str | None = None
) -> dict[str, DataFrame]:
    """Filter by section, clean once, store, and count over what was stored.

    ``out`` is where the cleaned articles go; without it they lie in the scratch folder.
    """
    cleaned = cleaning.clean_articles(cleaning.keep_sections(articles, *sections), profile)
    if out is None:
        cleaned = materialise(cleaned, "cleaned")
    else:
        cleaned.write.parquet(out)
        cleaned = articles.sparkSession.read.schema(cleaned.schema).parquet(out)
    keyed = cleaning.with_section(cleaned)
    return {
        "articles": cleaned,
        "sections": quality.histogram(keyed, F.col("section_key"), "section"),
        "years": quality.year_histogram(cleaned),
    }
