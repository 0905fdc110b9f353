"""Search-result pages: links, listing rows, yields and paging."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hemeroteca.functions import fixed_values as fv
from hemeroteca.functions import text as tx
from hemeroteca.functions import urls
from hemeroteca.operators import outline as ol
from hemeroteca.operators.dedupe import first_seen, resume_backlog

_HEADINGS = ("h1", "h2", "h3", "h4", "h5", "h6", "span")


def page_links(outlines: DataFrame, *keys: str) -> DataFrame:
    """One row per ``<a href>``, in document order: keys, ``pos``, ``href``, ``text``."""
    links = F.filter("nodes", lambda n: (n["tag"] == "a") & n["href"].isNotNull())
    rows = F.transform(
        links, lambda n: F.struct(n["pos"].alias("pos"), n["href"].alias("href"), ol.inner_text(n).alias("text"))
    )
    return outlines.select(*keys, F.inline(rows))


def page_links_by_pattern(pages: DataFrame, *keys: str) -> DataFrame:
    """The JVM-only form for jobs that need no more than hrefs: keys, ``pos``, ``href``.

    It reads tags by pattern, so links inside comments count as links too.
    """
    hrefs = F.regexp_extract_all("html", F.lit(r'(?i)<a\s[^>]*href="([^"]*)"'), F.lit(1))
    return pages.select(*keys, F.posexplode(hrefs).alias("pos", "href"))


def article_links(
    links: DataFrame,
    rooted_only: bool = False,
    site: str = fv.SITE,
    sections: tuple[str, ...] = fv.ARTICLE_SECTIONS,
) -> DataFrame:
    """Absolutise ``href`` into ``url`` and keep article links.

    The default resolves every link and asks for site and section; ``rooted_only``
    drops relative links and asks for a core section on any host.
    """
    if rooted_only:
        return links.withColumn("url", urls.absolute_rooted(F.col("href"), site)).where(
            urls.is_core_article(F.col("url"))
        )
    return links.withColumn("url", urls.absolute_any(F.col("href"), site)).where(
        urls.is_site_article(F.col("url"), site, sections)
    )


def _candidates(
    outlines: DataFrame,
    keys: list[str],
    url: Callable[[Column], Column],
    keep: Callable[[Column], Column],
    facts: Callable[[Column], Column],
    first_of_url: str | None = None,
) -> DataFrame:
    """Rows for the links ``keep`` accepts, each with the facts of its container.

    ``url`` makes a URL of an href, ``keep`` tests it, ``facts`` reads the nodes inside a
    container.  ``first_of_url`` leaves
    one link per URL and page: the first of ``any`` links, or of those ``contained`` in
    an enclosing element.  Facts are worked out once per link-bearing container, not
    once per link, so a page that hangs all its links in one big element is walked once.
    """
    links = F.filter(
        F.transform(
            F.filter("nodes", lambda n: (n["tag"] == "a") & n["href"].isNotNull()),
            # The field order makes array_sort sort by URL, then position.
            lambda n: F.struct(
                url(n["href"]).alias("url"), n["pos"].alias("pos"), n["t0"].alias("t0"),
                n["t1"].alias("t1"), n["box"].alias("box"),
            ),
        ),
        lambda c: keep(c["url"]) & (c["box"].isNotNull() if first_of_url == "contained" else F.lit(True)),
    )
    step = outlines.select(*keys, "texts", "nodes", links.alias("links"))
    if first_of_url is not None:
        # All links of a page sit in one row, so this needs no shuffle.
        step = step.withColumn("links", F.array_sort("links"))
        step = step.withColumn(
            "links",
            F.filter("links", lambda c, i: (i == 0) | (c["url"] != F.get(F.col("links"), i - 1)["url"])),
        )
    # Boxes sorted by number, so that a link finds its facts by index.
    boxes = F.array_sort(
        F.transform(
            F.filter("nodes", lambda n: n["box"].isNotNull() & (n["tag"] != "a")),
            lambda n: F.struct(n["box"].alias("box"), n["pos"].alias("pos"), n["stop"].alias("stop")),
        )
    )

    def box_facts(box: Column) -> Column:
        inner = F.slice(F.col("nodes"), box["pos"] + 2, box["stop"] - box["pos"] - 1)
        return F.get(F.transform(F.array(inner), facts), F.lit(0))

    step = step.withColumn("facts", F.transform(boxes, box_facts))
    rows = F.transform(
        "links",
        lambda c: F.struct(
            c["pos"].alias("pos"),
            c["url"].alias("url"),
            ol.inner_text(c).alias("link_text"),
            F.get(F.col("facts"), c["box"]).alias("ctr"),
        ),
    )
    return step.select(*keys, F.inline(rows))


def _card_facts(inner: Column) -> Column:
    heading = ol.first(inner, lambda n: n["tag"].isin(*_HEADINGS))
    blurb = ol.first(
        inner, lambda n: n["tag"].isin("p", "div") & ol.class_like(n, tx.any_of(fv.DESCRIPTION_CLASSES))
    )
    time = ol.first(inner, lambda n: n["tag"] == "time")
    return F.struct(
        ol.inner_text(heading).alias("heading"),
        F.coalesce(ol.inner_text(blurb), F.lit("")).alias("description"),
        F.coalesce(time["datetime"], ol.inner_text(time), F.lit("")).alias("date"),
    )


def _short_card_facts(inner: Column) -> Column:
    heading = ol.first(inner, lambda n: n["tag"].isin("h1", "h2", "h3", "h4"))
    paragraph = ol.first(inner, lambda n: n["tag"] == "p")
    return F.struct(
        ol.inner_text(heading).alias("heading"),
        ol.inner_text(paragraph).alias("description"),
    )


def _title(heading: Column, link_text: Column) -> Column:
    return F.when(F.length(heading) >= fv.MIN_TITLE, heading).otherwise(link_text)


def listing_rows(
    outlines: DataFrame,
    search_query: str,
    page: str = "page",
    first_link_decides: bool = False,
    site: str = fv.SITE,
    sections: tuple[str, ...] = fv.ARTICLE_SECTIONS,
    scraped_at: Column | None = None,
    seen: DataFrame | None = None,
) -> DataFrame:
    """Listing rows, one per URL, from outlined search pages.

    By default a URL's first link with a long enough title wins.  With
    ``first_link_decides`` a URL's first link on a page claims it for that page
    before the title test; a short title then loses the URL there, though a later
    page may still supply it.  URLs in ``seen`` are left out.  ``pos`` orders rows
    within a page.
    """
    rows = _candidates(
        outlines,
        [page],
        lambda href: urls.absolute_any(href, site),
        lambda url: urls.is_site_article(url, site, sections),
        _card_facts,
        first_of_url="contained" if first_link_decides else None,
    ).where("ctr is not null")
    rows = rows.select(
        _title(F.col("ctr.heading"), F.col("link_text")).alias("title"),
        "url",
        "ctr.description",
        "ctr.date",
        F.lit(search_query).alias("search_query"),
        F.col(page).cast("int").alias("page"),
        (F.current_timestamp().cast("timestamp_ntz") if scraped_at is None else scraped_at).alias("scraped_at"),
        "pos",
    ).where(F.length("title") >= fv.MIN_TITLE)
    once = first_seen(rows)
    # Seen URLs go after the dedupe: one row per URL is left by then, already
    # partitioned by URL for the join.
    return once if seen is None else resume_backlog(once, seen)


def section_listing_rows(outlines: DataFrame, page: str = "page", site: str = fv.SITE) -> DataFrame:
    """Listing rows of the section form: first link wins, no title test, date from the URL."""
    rows = _candidates(
        outlines,
        [page],
        lambda href: urls.absolute_rooted(href, site),
        lambda url: F.coalesce(urls.is_core_article(url), F.lit(False)),
        _short_card_facts,
        first_of_url="any",
    )
    heading, text = F.col("ctr.heading"), F.col("link_text")
    rows = rows.select(
        "url",
        F.when((F.length(text) < fv.MIN_TITLE) & heading.isNotNull(), heading).otherwise(text).alias("title"),
        F.coalesce("ctr.description", F.lit("")).alias("description"),
        urls.url_date(F.col("url")).alias("date"),
        urls.section_label(F.col("url")).alias("section"),
        F.col(page).cast("int").alias("page"),
        "pos",
    )
    return first_seen(rows)


def in_page_range(pages: DataFrame, first_page: int, last_page: int, page: str = "page") -> DataFrame:
    return pages.where(F.col(page).between(first_page, last_page))


#: Ranges that are counted at once in search of a cut.
_RANGES = 1_024


def take_target(rows: DataFrame, n: int) -> DataFrame:
    """The first ``n`` rows in crawl order (the collection target); hand in stored rows.

    Counts of page ranges tell at which page the target is reached, then counts of position
    ranges at which position of it.  All before that is kept as it lies; only rows that tie in
    page and position are ordered, by their text.  Missing pages and positions come first.
    """
    if n <= 0:
        return rows.where("false")
    own = rows.withColumns({"_page": _first_if_missing("page"), "_pos": _first_if_missing("pos")})
    page, before = _cut(own, "_page", n)
    if page is None:
        return rows
    at_page = own.where(F.col("_page") == page)
    pos, within = _cut(at_page, "_pos", n - before)
    if pos is None:
        return own.where(F.col("_page") <= page).drop("_page", "_pos")
    kept = own.where((F.col("_page") < page) | ((F.col("_page") == page) & (F.col("_pos") < pos)))
    ties = at_page.where(F.col("_pos") == pos).orderBy(F.to_json(F.struct(*rows.columns))).limit(n - before - within)
    return kept.union(ties).drop("_page", "_pos")


def _first_if_missing(column: str) -> Column:
    return F.coalesce(F.col(column).cast("long"), F.lit(-1 << 40))


def _cut(rows: DataFrame, column: str, n: int) -> tuple[int | None, int]:
    """(the value of ``column`` that the ``n``-th row in its order has, rows below it); None if there are fewer rows."""
    ends = rows.agg(F.min(column).alias("low"), F.max(column).alias("high"), F.count("*").alias("n")).first()
    if ends["n"] < n:
        return None, 0
    low, high, before = ends["low"], ends["high"], 0
    while True:
        width = -(-(high - low + 1) // _RANGES)
        block = F.expr(f"({column} - {low}L) div {width}L").alias("block")
        counts = rows.where(F.col(column).between(low, high)).groupBy(block).count().collect()  # _RANGES rows at most
        for r in sorted(counts):
            if before + r["count"] >= n:
                break
            before += r["count"]
        low = low + r["block"] * width
        high = min(high, low + width - 1)
        if width == 1:
            return low, before


def page_yield(rows: DataFrame) -> DataFrame:
    """New articles per page."""
    return rows.groupBy("page").agg(F.count("*").alias("n_new"))


def cut_at_empty_page(rows: DataFrame, pages: DataFrame, page: str = "page") -> DataFrame:
    """Rows before the first page that yields nothing new.

    Hand in a stored listing: it is read twice, once for the cut.
    """
    barren = pages.select(F.col(page).cast("int").alias("page")).join(
        rows.select("page").distinct(), "page", "left_anti"
    )
    first_barren = barren.agg(F.min("page")).scalar()
    return rows.where((F.col("page") < first_barren) | first_barren.isNull())


def next_page(outlines: DataFrame, *keys: str, with_buttons: bool = False) -> DataFrame:
    """Whether a page links to a next one, and where to.

    The lookups run in order - the link's own first text, then ``rel``, then class - and
    the first that finds an element decides.  ``with_buttons`` is the other published order:
    link text, button text, then anything with a next-like class.
    """

    def says_next(n: Column) -> Column:
        words = fv.NEXT_WORDS[:1] if with_buttons else fv.NEXT_WORDS
        text = F.when(n["own"] >= 0, F.get(F.col("texts"), n["own"])).otherwise(F.lit(""))
        return reduce(lambda a, b: a | b, [F.contains(text, F.lit(w)) for w in words])

    if with_buttons:
        found = F.coalesce(
            ol.first(F.col("nodes"), lambda n: (n["tag"] == "a") & says_next(n)),
            ol.first(F.col("nodes"), lambda n: (n["tag"] == "button") & says_next(n)),
            ol.first(F.col("nodes"), lambda n: F.coalesce(F.contains(n["cls"], F.lit("next")), F.lit(False))),
        )
    else:
        found = F.coalesce(
            ol.first(F.col("nodes"), lambda n: (n["tag"] == "a") & says_next(n)),
            ol.first(F.col("nodes"), lambda n: (n["tag"] == "a") & (n["rel"] == "next")),
            ol.first(F.col("nodes"), lambda n: (n["tag"] == "a") & ol.class_like(n, "|".join(fv.NEXT_CLASSES))),
        )
    return outlines.select(*keys, found.alias("_n")).select(
        *keys, F.col("_n").isNotNull().alias("has_next"), F.col("_n.href").alias("next_href")
    )


def structure_profile(outlines: DataFrame, sections: tuple[str, ...] = fv.CORE_SECTIONS) -> DataFrame:
    """Totals of the page features an extraction would rest on."""

    def n(wanted) -> Column:
        return F.size(F.filter("nodes", wanted))

    def linked(x: Column) -> Column:
        return (x["tag"] == "a") & x["href"].isNotNull()

    section_path = f"/(?:{'|'.join(sections)})/"
    per_page = outlines.select(
        n(lambda x: x["tag"] == "article").alias("articles"),
        n(lambda x: (x["tag"] == "div") & x["cls"].isNotNull()).alias("class_divs"),
        n(lambda x: (x["tag"] == "div") & ol.class_like(x, tx.any_of(fv.PROFILE_CLASSES))).alias("card_divs"),
        n(linked).alias("links"),
        n(lambda x: linked(x) & x["href"].rlike(section_path)).alias("section_links"),
    )
    names = per_page.columns
    return per_page.agg(F.count("*").alias("pages"), *[F.sum(c).alias(c) for c in names])


def structure_samples(
    outlines: DataFrame, *keys: str, sections: tuple[str, ...] = fv.CORE_SECTIONS, sizes: tuple[int, ...] = (3, 5, 10)
) -> DataFrame:
    """The first few articles, card divs and section links of each page, with class,
    first link and first heading or link text."""

    def linked(x: Column) -> Column:
        return (x["tag"] == "a") & x["href"].isNotNull()

    def block(kind: str):
        def describe(a: Column) -> Column:
            inner = F.slice(F.col("nodes"), a["pos"] + 2, a["stop"] - a["pos"] - 1)
            heading = ol.first(inner, lambda x: x["tag"].isin("h1", "h2", "h3"))
            return sample(kind, a, ol.first(inner, linked)["href"], ol.inner_text(heading))

        return describe

    def sample(kind: str, a: Column, href: Column, text: Column) -> Column:
        return F.struct(
            F.lit(kind).alias("kind"),
            a["pos"].alias("pos"),
            a["cls"].alias("classes"),
            F.substring(href, 1, 100).alias("href"),
            F.substring(text, 1, 100).alias("text"),
        )

    def take(n: int, wanted) -> Column:
        return F.slice(F.filter("nodes", wanted), 1, n)

    section_path = f"/(?:{'|'.join(sections)})/"
    articles = take(sizes[0], lambda x: x["tag"] == "article")
    cards = take(sizes[1], lambda x: (x["tag"] == "div") & ol.class_like(x, tx.any_of(fv.PROFILE_CLASSES)))
    links = take(sizes[2], lambda x: linked(x) & x["href"].rlike(section_path))
    samples = F.concat(
        F.transform(articles, block("article")),
        F.transform(cards, block("card")),
        F.transform(links, lambda a: sample("link", a, a["href"], ol.inner_text(a))),
    )
    return outlines.select(*keys, F.inline(samples))
