"""Article pages: title, date, author and the body cascades, in three forms."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hemeroteca.functions import fixed_values as fv
from hemeroteca.functions import text as tx
from hemeroteca.functions import urls
from hemeroteca.operators import outline as ol

_NODES = "nodes"


def _first_tag(*tags: str) -> Column:
    return ol.first(F.col(_NODES), lambda n: n["tag"].isin(*tags))


def _first_with_class(tag: str, name: str) -> Column:
    return ol.first(F.col(_NODES), lambda n: (n["tag"] == tag) & ol.has_class(n, name))


def _first_itemprop(name: str) -> Column:
    return ol.first(F.col(_NODES), lambda n: n["itemprop"] == name)


def _with_named(outlines: DataFrame, **named: Column) -> DataFrame:
    # One projection of its own, so each lookup runs once however often it is used.
    return outlines.select("*", *[c.alias(k) for k, c in named.items()])


def _paragraphs(sep: str) -> Column:
    return F.transform(
        F.filter(_NODES, lambda n: n["tag"] == "p"),
        lambda n: F.struct(
            n["pos"].alias("pos"),
            F.coalesce(n["cls"], F.lit("")).alias("cls"),
            ol.inner_text(n, sep).alias("text"),
        ),
    )


def _texts_of(paragraphs: Column) -> Column:
    return F.transform(paragraphs, lambda p: p["text"])


def _scraped(scraped_at: Column | None) -> Column:
    return F.current_timestamp().cast("timestamp_ntz") if scraped_at is None else scraped_at


def _without_errors(outlines: DataFrame) -> DataFrame:
    return outlines.where("error is null")


def extraction_errors(outlines: DataFrame) -> DataFrame:
    """How many pages could be read and how many failed, by kind of failure."""
    kind = F.substring_index(F.coalesce("error", F.lit("ok")), ":", 1)
    return outlines.groupBy(kind.alias("outcome")).agg(F.count("*").alias("n"))


def article_v1(outlines: DataFrame, scraped_at: Column | None = None, keep: tuple[str, ...] = ()) -> DataFrame:
    """url, title, author, date, body: tight text, container class first."""
    named = _with_named(
        _without_errors(outlines),
        h1=_first_tag("h1"),
        time=_first_tag("time"),
        byline=ol.first(
            F.col(_NODES), lambda n: n["tag"].isin("span", "a") & ol.class_like(n, tx.any_of(fv.AUTHOR_CLASSES))
        ),
        container=F.coalesce(
            ol.first(
                F.col(_NODES),
                lambda n: n["tag"].isin("div", "article") & ol.class_like(n, tx.any_of(fv.CONTAINER_CLASSES_V1)),
            ),
            _first_tag("article"),
        ),
        ps=_paragraphs(""),
    )
    chosen = F.filter(
        "ps",
        lambda p: (F.length(p["text"]) > fv.MIN_PARAGRAPH_V1)
        & (F.col("container").isNull() | ol.inside(p, F.col("container"))),
    )
    return _with_body_of(named, _texts_of(chosen)).select(
        *keep,
        "url",
        F.coalesce(ol.inner_text(F.col("h1")), F.lit("")).alias("title"),
        F.coalesce(ol.inner_text(F.col("byline")), F.lit("")).alias("author"),
        F.coalesce("time.datetime", F.lit("")).alias("date"),
        "body",
        _scraped(scraped_at).alias("scraped_at"),
    )


def _in_article(p: Column) -> Column:
    return F.col("first_article").isNotNull() & ol.inside(p, F.col("first_article"))


def _in_content_div(p: Column) -> Column:
    return F.exists("content_divs", lambda d: ol.inside(p, d))


def _unlike(p: Column, classes: tuple[str, ...]) -> Column:
    return ~p["cls"].rlike(tx.any_of(classes))


def _long(p: Column) -> Column:
    return F.length(p["text"]) > fv.MIN_PARAGRAPH


def _body_parts(outlines: DataFrame, terms: tuple[str, ...], div_step, last_step=None) -> DataFrame:
    """Add ``body``, ``body_length`` and ``paragraphs_count``.

    Paragraphs are the first article's, else the content divs', else the last step's.
    Each later step sits in the branch of a CASE, so it runs only for pages whose
    earlier steps found too little.  Content divs are visited as one set: a paragraph
    inside any of them counts once, in document order, which is what visiting them
    one by one and dropping repeated texts comes to.
    """
    named = _with_named(
        outlines,
        first_article=_first_tag("article"),
        content_divs=F.filter(_NODES, lambda n: (n["tag"] == "div") & ol.class_like(n, tx.any_of(terms))),
        ps=_paragraphs(" "),
    )
    named = _with_named(
        named,
        step1=_texts_of(
            F.filter("ps", lambda p: _in_article(p) & _unlike(p, fv.SKIPPED_CLASSES) & _long(p))
        ),
    )
    chosen = _or_else(
        F.col("step1"),
        F.array_distinct(_texts_of(F.filter("ps", lambda p: _in_content_div(p) & div_step(p) & _long(p)))),
    )
    if last_step is not None:
        named = _with_named(named, step12=chosen)
        chosen = _or_else(F.col("step12"), F.array_distinct(_texts_of(F.filter("ps", last_step))))
    return _with_body_of(named, chosen)


def _or_else(found: Column, otherwise: Column) -> Column:
    return F.when(F.size(found) >= fv.ENOUGH_PARAGRAPHS, found).otherwise(otherwise)


def _with_body_of(named: DataFrame, paragraphs: Column) -> DataFrame:
    # A one-row generator: the paragraphs are put together once, and a later filter on
    # the body cannot be planned below this point, where it would repeat the cascade.
    def assembled(ps: Column) -> Column:
        body = F.array_join(ps, "\n\n")
        return F.struct(
            body.alias("body"), F.length(body).alias("body_length"), F.size(ps).alias("paragraphs_count")
        )

    return named.select("*", F.inline(F.transform(F.array(paragraphs), assembled)))


def _last_resort(p: Column) -> Column:
    return (
        _unlike(p, fv.SKIPPED_CLASSES_LAST)
        & (F.length(p["text"]) >= fv.MIN_PARAGRAPH)
        & ~tx.metadata_like(p["text"])
    )


def article_v2(outlines: DataFrame, scraped_at: Column | None = None, keep: tuple[str, ...] = ()) -> DataFrame:
    """The re-extraction form: spaced text, three-step body, date from the URL first."""
    date_candidates = F.array(
        ol.first(F.col(_NODES), lambda n: (n["tag"] == "time") & n["datetime"].isNotNull()),
        _first_tag("time"),
        _first_with_class("span", "date"),
        _first_with_class("div", "date"),
        _first_itemprop("datePublished"),
    )
    named = _with_named(
        _without_errors(outlines),
        h1=_first_tag("h1"),
        byline=F.coalesce(
            _first_with_class("span", "author"),
            _first_with_class("a", "author"),
            _first_itemprop("author"),
            _first_with_class("div", "author"),
        ),
        page_date=F.get(
            F.filter(
                F.transform(date_candidates, lambda n: F.coalesce(n["datetime"], ol.inner_text(n))),
                lambda d: d != "",
            ),
            F.lit(0),
        ),
    )
    parts = _body_parts(
        named, fv.CONTENT_CLASSES_V2, lambda p: _unlike(p, fv.SKIPPED_CLASSES), _last_resort
    )
    return parts.select(
        *keep,
        "url",
        F.coalesce(ol.inner_text(F.col("h1")), F.lit("")).alias("title"),
        F.coalesce(ol.inner_text(F.col("byline")), F.lit("")).alias("author"),
        F.coalesce(F.nullif(urls.url_date(F.col("url")), F.lit("")), "page_date", F.lit("")).alias("date"),
        "body",
        "body_length",
        "paragraphs_count",
        _scraped(scraped_at).alias("scraped_at"),
    )


def article_v3(outlines: DataFrame, scraped_at: Column | None = None, keep: tuple[str, ...] = ()) -> DataFrame:
    """What the page itself gives to the third form; see ``enrich`` for the rest."""
    named = _with_named(
        _without_errors(outlines),
        h1=_first_tag("h1"),
        byline=F.coalesce(_first_with_class("span", "author"), _first_with_class("a", "author")),
    )
    parts = _body_parts(named, fv.CONTENT_CLASSES_V3, lambda p: F.lit(True))
    return parts.select(
        *keep,
        "url",
        F.coalesce(ol.inner_text(F.col("h1"), " "), F.lit("")).alias("page_title"),
        F.coalesce(ol.inner_text(F.col("byline"), " "), F.lit("")).alias("author"),
        "body",
        "body_length",
        "paragraphs_count",
        _scraped(scraped_at).alias("scraped_at"),
    )


def enrich(listing: DataFrame, extracted: DataFrame) -> DataFrame:
    """Third-form articles: the listing's title, date, description and section over the page's facts."""
    carried = listing.select("url", *[F.col(c).alias(f"_{c}") for c in ("title", "date", "description", "section")])
    return extracted.join(carried, "url").select(
        "url",
        F.coalesce(F.nullif(F.col("_title"), F.lit("")), "page_title").alias("title"),
        "author",
        F.coalesce("_date", F.lit("")).alias("date"),
        "body",
        F.coalesce("_description", F.lit("")).alias("description"),
        F.coalesce("_section", F.lit("")).alias("section"),
        "body_length",
        "paragraphs_count",
        "scraped_at",
    )


def flag_low_content(articles: DataFrame) -> DataFrame:
    return articles.withColumn("low_content", F.length(F.coalesce("body", F.lit(""))) < fv.LOW_CONTENT)


def with_body(articles: DataFrame) -> DataFrame:
    return articles.where(F.length("body") > 0)
