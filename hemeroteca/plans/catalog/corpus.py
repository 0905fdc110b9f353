"""URLs, dates, sections, duplicates, counts, joins and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from hemeroteca.functions import fixed_values as fv
from hemeroteca.functions import text as tx
from hemeroteca.functions import urls
from hemeroteca.operators import cleaning, dedupe, listing, quality
from hemeroteca.plans import inputs
from hemeroteca.plans.catalog.registry import LISTING_SQL, ORDER_URLS_SQL, articles_sql, query
from hemeroteca.session import scratch_path
from hemeroteca.sources import runs
from hemeroteca.sources.writers import materialise

_URL_DATE = r"replace(regexp_extract(url, '/([0-9]{4}/[0-9]{2}/[0-9]{2})/', 1), '/', '-')"
_ARTICLES = articles_sql()
_BLANK = "(date IS NULL OR trim(date) = '')"

# --- URLs, dates, sections -----------------------------------------------------------


@query(f"SELECT idx, url, {_URL_DATE} AS url_date FROM {ORDER_URLS_SQL}")
def url_date(spark, sf):
    return inputs.order_urls(spark, sf).select("idx", "url", urls.url_date(F.col("url")).alias("url_date"))


@query(
    f"""SELECT idx, url, CASE WHEN {_BLANK} AND {_URL_DATE} <> '' THEN {_URL_DATE} ELSE date END AS date,
    {_BLANK} AND {_URL_DATE} <> '' AS date_filled FROM {_ARTICLES}"""
)
def date_fill(spark, sf):
    return cleaning.fill_dates(inputs.articles(spark, sf).select("idx", "url", "date"))


@query(
    f"""SELECT idx, try_cast(d AS DATE) AS date_d FROM (
    SELECT idx, CASE WHEN {_BLANK} AND {_URL_DATE} <> '' THEN {_URL_DATE} ELSE date END AS d FROM {_ARTICLES})"""
)
def valid_dates(spark, sf):
    filled = cleaning.fill_dates(inputs.articles(spark, sf).select("idx", "url", "date"))
    return cleaning.with_valid_date(filled).select("idx", "date_d")


@query(f"SELECT idx, url FROM {ORDER_URLS_SQL} WHERE split_part(url, '/', 4) IN ('economia', 'politica')")
def section_filter(spark, sf):
    return cleaning.keep_sections(inputs.order_urls(spark, sf).select("idx", "url"))


@query(
    """SELECT split_part(url, '/', 4) AS section, count(*) AS n, min(page_id) AS first_idx,
    CAST(count(*) AS DOUBLE) * 100 / (SELECT count(*) FROM pages) AS pct FROM pages GROUP BY 1"""
)
def section_histogram(spark, sf):
    return quality.section_histogram(inputs.table(spark, sf, "pages").select("page_id", "url"), "page_id")


@query(
    f"""SELECT section, count(*) AS n, min(idx) AS first_idx,
    CAST(count(*) AS DOUBLE) * 100 / (SELECT count(*) FROM documents) AS pct
    FROM (SELECT idx, coalesce(section, nullif(split_part(url, '/', 4), ''), 'unknown') AS section FROM {_ARTICLES})
    GROUP BY 1"""
)
def section_fallback_histogram(spark, sf):
    keyed = cleaning.with_section(inputs.articles(spark, sf).select("idx", "url", "section"))
    return quality.histogram(keyed, F.col("section_key"), "section")


@query(
    f"""SELECT url, CASE WHEN contains(url, '/economia/') THEN 'economia' ELSE 'politica' END AS label
    FROM {ORDER_URLS_SQL} WHERE contains(url, '/economia/') OR contains(url, '/politica/')"""
)
def section_label(spark, sf):
    rows = inputs.order_urls(spark, sf).where(urls.is_core_article(F.col("url")))
    return rows.select("url", urls.section_label(F.col("url")).alias("label"))


@query(
    f"""SELECT idx, upper(split_part(url, '/', 4)) AS section, coalesce(left(title, 70), 'Sin título') AS title,
    left(url, 80) AS url, coalesce(date, 'N/A') AS date, CAST(length(body) AS INT) AS body_length
    FROM {_ARTICLES} ORDER BY idx LIMIT 5"""
)
def article_previews(spark, sf):
    return cleaning.preview_lines(inputs.articles(spark, sf), 5)


@query(
    f"""SELECT left(d, 4) AS year, count(*) AS n FROM (
    SELECT CASE WHEN {_BLANK} AND {_URL_DATE} <> '' THEN {_URL_DATE} ELSE date END AS d FROM {_ARTICLES})
    WHERE regexp_full_match(left(d, 4), '[0-9]+') GROUP BY 1"""
)
def year_histogram(spark, sf):
    return quality.year_histogram(cleaning.fill_dates(inputs.articles(spark, sf).select("url", "date")))


@query(
    f"""SELECT left(date, 4) AS year, count(*) AS n FROM {_ARTICLES} WHERE coalesce(left(date, 4), '') <> '' GROUP BY 1"""
)
def year_histogram_any_text(spark, sf):
    return quality.year_histogram(inputs.articles(spark, sf).select("date"), digits_only=False)


@query(
    """SELECT doc_id, 'https://www.example.com/buscador/?query=' || replace(url_encode(text || '*~'), '%20', '+')
    AS search_url FROM documents"""
)
def search_url(spark, sf):
    term = F.concat("text", F.lit("*~"))
    return inputs.documents(spark, sf).select("doc_id", urls.search_url(term).alias("search_url"))


# --- predicates ----------------------------------------------------------------------


@query(
    f"""SELECT idx, {_BLANK} AS blank_date, length(title) >= 20 AS long_title, length(body) > 20 AS over_20,
    length(body) > 30 AS over_30, length(body) > 100 AS over_100 FROM {_ARTICLES}"""
)
def length_flags(spark, sf):
    body = F.length("body")
    return inputs.articles(spark, sf).select(
        "idx",
        tx.is_blank(F.col("date")).alias("blank_date"),
        (F.length("title") >= fv.MIN_TITLE).alias("long_title"),
        (body > fv.MIN_PARAGRAPH_V1).alias("over_20"),
        (body > fv.MIN_PARAGRAPH).alias("over_30"),
        (body > fv.LOW_CONTENT).alias("over_100"),
    )


_LINES = "(SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents)"


@query(
    f"""SELECT doc_id, count(*) AS n_lines, count(*) FILTER (length(line) - length(replace(line, ',', '')) <= 1
    AND length(line) < 50 AND regexp_matches(line, '{fv.DIGIT}')) AS n_metadata,
    count(*) FILTER (regexp_matches(lower(line), 'author|date|share|social|tags|related')) AS n_keyword
    FROM {_LINES} GROUP BY 1"""
)
def metadata_like_lines(spark, sf):
    lines = F.split("text", "\n")
    return inputs.documents(spark, sf).select(
        "doc_id",
        F.size(lines).cast("long").alias("n_lines"),
        F.size(F.filter(lines, tx.metadata_like)).cast("long").alias("n_metadata"),
        F.size(F.filter(lines, lambda x: x.rlike(tx.any_of(fv.SKIPPED_CLASSES)))).cast("long").alias("n_keyword"),
    )


@query(f"SELECT idx, page FROM {_ARTICLES} WHERE page BETWEEN 11 AND 40")
def page_range(spark, sf):
    return listing.in_page_range(inputs.articles(spark, sf).select("idx", "page"), 11, 40)


# --- duplicates, windows, order ------------------------------------------------------


@query(
    f"""SELECT count(*) AS n_rows, count(DISTINCT url) AS n_urls, count(DISTINCT title) AS n_titles,
    count(*) - count(DISTINCT url) AS dup_urls, count(*) - count(DISTINCT title) AS dup_titles FROM {LISTING_SQL}"""
)
def duplicate_summary(spark, sf):
    return quality.corpus_counts(inputs.listing(spark, sf))


@query(f"SELECT url, count(*) AS n FROM {LISTING_SQL} GROUP BY 1 HAVING count(*) > 1")
def duplicate_groups(spark, sf):
    return dedupe.duplicate_groups(inputs.listing(spark, sf))


@query(f"SELECT title, count(*) AS n FROM {LISTING_SQL} GROUP BY 1 HAVING count(*) > 1")
def duplicate_titles(spark, sf):
    return dedupe.duplicate_groups(inputs.listing(spark, sf), "title")


@query("SELECT text, count(*) AS n FROM documents GROUP BY 1 HAVING count(*) > 1")
def duplicate_texts(spark, sf):
    return dedupe.duplicate_groups(inputs.documents(spark, sf), "text")


@query(
    f"""SELECT url, idx, title, page, n, number FROM (SELECT *, count(*) OVER (PARTITION BY url) AS n,
    row_number() OVER (PARTITION BY url ORDER BY idx) AS number FROM {LISTING_SQL}) WHERE n > 1"""
)
def duplicate_details(spark, sf):
    rows = inputs.listing(spark, sf).drop("pos")
    return dedupe.duplicate_rows(rows, block_rows=200)


@query(f"SELECT page, count(*) AS n FROM {LISTING_SQL} GROUP BY 1")
def page_counts(spark, sf):
    return quality.page_counts(inputs.listing(spark, sf))


@query(
    f"""SELECT idx, url, title, page FROM {LISTING_SQL}
    QUALIFY row_number() OVER (PARTITION BY url ORDER BY page, pos) = 1"""
)
def first_seen_urls(spark, sf):
    return dedupe.first_seen(inputs.listing(spark, sf)).drop("pos")


@query(f"SELECT idx, url, row_number() OVER (PARTITION BY url ORDER BY idx) AS number FROM {LISTING_SQL}")
def numbering_within_url(spark, sf):
    rows = inputs.listing(spark, sf).select("idx", "url")
    return dedupe.number_within(rows, "url", "idx", F.expr("idx div 200"))


@query(
    f"""SELECT idx, url, page FROM (SELECT * FROM {LISTING_SQL}
    QUALIFY row_number() OVER (PARTITION BY url ORDER BY page, pos) = 1) ORDER BY page, pos LIMIT 75"""
)
def article_limit(spark, sf):
    rows = materialise(dedupe.first_seen(inputs.listing(spark, sf)), "listing")
    return listing.take_target(rows, 75).select("idx", "url", "page")


@query(
    f"""SELECT idx, url, page FROM {LISTING_SQL} QUALIFY row_number() OVER (ORDER BY page, pos)
    <= (SELECT count(*) // 2 FROM documents)"""
)
def article_limit_half(spark, sf):
    """A target of half the listing, URLs repeated."""
    rows = inputs.listing(spark, sf)
    return listing.take_target(rows, rows.count() // 2).select("idx", "url", "page")


# --- what runs leave behind ---------------------------------------------------------------


def _appended(spark, sf):
    """Tallies of the articles in two appends, the second one stored again after a failure."""
    path = scratch_path(spark, "tallies")
    rows = inputs.articles(spark, sf)
    for run in (0, 1, 1):
        runs.add_tallies(rows.where(F.col("idx") % 2 == run), path, f"append-{run}")
    return path


@query(
    f"""SELECT section AS key, count(*) AS n, min(idx) AS first_idx, CAST(count(*) AS DOUBLE) * 100 / (SELECT count(*) FROM documents) AS pct
    FROM (SELECT idx, split_part(url, '/', 4) AS section FROM {_ARTICLES}) GROUP BY 1"""
)
def stored_section_histogram(spark, sf):
    return runs.tallied(spark, _appended(spark, sf), "section")


@query(
    f"""SELECT left(date, 4) AS key, count(*) AS n, min(idx) AS first_idx, CAST(count(*) AS DOUBLE) * 100 / (SELECT count(*) FROM documents) AS pct
    FROM {_ARTICLES} WHERE regexp_full_match(left(date, 4), '[0-9]+') GROUP BY 1"""
)
def stored_year_histogram(spark, sf):
    return runs.tallied(spark, _appended(spark, sf), "year")


@query(
    f"""SELECT count(*) AS n_rows, count(*) FILTER (WHERE length(body) > 100) AS with_body,
    count(*) FILTER (WHERE date <> '') AS with_date FROM {_ARTICLES}"""
)
def stored_coverage(spark, sf):
    return runs.tallied_coverage(spark, _appended(spark, sf))


@query(
    f"""SELECT 'distinct url' AS kind, count(DISTINCT url) AS n, true AS within FROM {_ARTICLES}
    UNION ALL SELECT 'distinct title', count(DISTINCT title), true FROM {_ARTICLES}"""
)
def sketched_distinct(spark, sf):
    """Merged sketches of two appends beside the exact counts, and whether they are within the stated bound."""
    counts = quality.corpus_counts(inputs.articles(spark, sf))
    exact = counts.select(F.inline(F.array(
        F.struct(F.lit("distinct url").alias("kind"), F.col("n_urls").alias("n")),
        F.struct(F.lit("distinct title").alias("kind"), F.col("n_titles").alias("n")),
    )))
    both = exact.join(runs.estimated_distinct(spark, _appended(spark, sf)), "kind")
    return both.select("kind", "n", (F.abs(F.col("estimate") - F.col("n")) <= runs.SKETCH_BOUND * F.col("n")).alias("within"))


_UNFINISHED = "doc_id % 7 = 3 OR (doc_id % 5 = 1 AND doc_id % 3 = 0)"


@query(
    f"""SELECT 'gap' AS kind, doc_id AS position FROM documents WHERE {_UNFINISHED}
    UNION ALL SELECT 'row', doc_id FROM documents WHERE {_UNFINISHED}"""
)
def resume_positions(spark, sf):
    """Work that ended out of order, over two runs, the second one noted twice: the backlog is the gaps."""
    path = scratch_path(spark, "positions")
    rows = inputs.listing(spark, sf).select("idx", "url")
    ended = rows.where("not (idx % 7 = 3 or (idx % 5 = 1 and idx % 3 = 0))")
    for run in (0, 1, 1):
        runs.note_finished(ended.where(F.crc32("url") % 2 == run), path, f"run-{run}")
    gaps = runs.gaps(spark, path, rows.count()).select(F.lit("gap").alias("kind"), "position")
    return gaps.union(runs.unfinished_rows(rows, path).select(F.lit("row"), "idx"))


@query(f"SELECT DISTINCT url FROM {LISTING_SQL}")
def distinct_urls(spark, sf):
    return inputs.listing(spark, sf).select("url").distinct()


# --- joins and set operations -----------------------------------------------------------


@query(
    f"""SELECT idx, url FROM {ORDER_URLS_SQL} WHERE url NOT IN (SELECT url FROM {LISTING_SQL})"""
)
def resume_backlog(spark, sf):
    backlog = inputs.order_urls(spark, sf).select("idx", "url")
    return dedupe.resume_backlog(backlog, inputs.listing(spark, sf))


@query(
    f"""SELECT idx, url, title, page FROM {LISTING_SQL} UNION ALL
    SELECT idx, url, NULL, NULL FROM {ORDER_URLS_SQL} WHERE url NOT IN (SELECT url FROM {LISTING_SQL})"""
)
def appended_rows(spark, sf):
    earlier = inputs.listing(spark, sf).drop("pos")
    new = dedupe.resume_backlog(inputs.order_urls(spark, sf).select("idx", "url"), earlier)
    return dedupe.append_rows(earlier, new)


@query(f"SELECT url FROM {LISTING_SQL} UNION SELECT url FROM {ORDER_URLS_SQL}")
def union_seen(spark, sf):
    return dedupe.union_seen(inputs.listing(spark, sf), inputs.order_urls(spark, sf))


@query(
    f"""SELECT o.idx, o.url, l.title, l.page FROM {ORDER_URLS_SQL} o JOIN (SELECT * FROM {LISTING_SQL}
    QUALIFY row_number() OVER (PARTITION BY url ORDER BY page, pos) = 1) l USING (url)"""
)
def listing_enrichment(spark, sf):
    rows = dedupe.first_seen(inputs.listing(spark, sf)).select("url", "title", "page")
    return inputs.order_urls(spark, sf).select("idx", "url").join(rows, "url")


# --- aggregations ---------------------------------------------------------------------------


@query(
    f"""SELECT count(*) AS n_rows, count(*) FILTER (length(body) > 100) AS with_body,
    count(*) FILTER (date <> '') AS with_date FROM {_ARTICLES}"""
)
def body_coverage(spark, sf):
    return quality.body_coverage(inputs.articles(spark, sf))


@query(
    f"""SELECT n_rows, with_date, n_rows - with_date AS without_date, CAST(with_date AS DOUBLE) * 100 / n_rows AS pct_with,
    CAST(n_rows - with_date AS DOUBLE) * 100 / n_rows AS pct_without
    FROM (SELECT count(*) AS n_rows, count(*) FILTER (NOT {_BLANK}) AS with_date FROM {_ARTICLES})"""
)
def date_coverage(spark, sf):
    return quality.date_coverage(inputs.articles(spark, sf))


@query(
    f"""SELECT count(*) AS n_rows, count(*) FILTER ({_BLANK} AND {_URL_DATE} <> '') AS n_changed FROM {_ARTICLES}"""
)
def date_fill_count(spark, sf):
    return quality.change_counts(cleaning.fill_dates(inputs.articles(spark, sf)), "date_filled")


@query(f"SELECT max(page) AS max_page FROM {LISTING_SQL}")
def highest_page(spark, sf):
    return quality.highest_page(inputs.listing(spark, sf))


@query("SELECT DISTINCT unnest(json_keys(props)) AS key FROM events")
def key_union(spark, sf):
    maps = inputs.table(spark, sf, "events").select(F.from_json("props", "map<string,string>").alias("props"))
    return quality.key_union(maps, "props")


_PROGRESS = f"""SELECT n_listing, n_articles, elapsed_s, CAST(n_listing AS DOUBLE) * 100 / 2000 AS pct_listing,
    CAST(n_articles AS DOUBLE) * 100 / n_listing AS pct_articles, CAST(n_articles AS DOUBLE) / elapsed_s AS rate_per_s,
    CAST(floor((n_listing - n_articles) / (CAST(n_articles AS DOUBLE) / elapsed_s)) AS BIGINT) AS eta_s FROM (
    SELECT count(*) AS n_listing, count(*) FILTER (status = 'F') AS n_articles,
    date_diff('second', min(listed_at), max(listed_at)) AS elapsed_s FROM {ORDER_URLS_SQL})"""


@query(
    f"""SELECT *, printf('%02d:%02d:%02d', eta_s // 3600, (eta_s // 60) % 60, eta_s % 60) AS eta FROM ({_PROGRESS})"""
)
def progress_report(spark, sf):
    counts = inputs.order_urls(spark, sf).agg(
        F.count("*").alias("n_listing"),
        F.count_if(F.col("status") == "F").alias("n_articles"),
        F.min("listed_at").alias("started"),
        F.max("listed_at").alias("ended"),
    )
    elapsed = F.timestamp_diff("SECOND", F.col("started"), F.col("ended"))
    return quality.progress(counts, elapsed).drop("started", "ended")
