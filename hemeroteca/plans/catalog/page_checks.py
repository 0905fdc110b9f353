"""Check SQL for the HTML queries: the page tree by a recursive query, then plain SQL over it."""

from __future__ import annotations

from hemeroteca.functions import fixed_values as fv
from hemeroteca.plans import inputs
from hemeroteca.plans.catalog.registry import decoded_sql

_VOID = ", ".join(f"'{t}'" for t in fv.VOID_TAGS)

ARTICLE_PAGES = (
    f"SELECT page_id AS k, {inputs.ARTICLE_PAGE_URL} AS url, {inputs.ARTICLE_PAGE_HTML} AS html FROM pages"
)
SEARCH_PAGES = f"""SELECT page AS k, {inputs.SEARCH_HTML} AS html FROM (
    SELECT page, string_agg(card, '' ORDER BY page_id) AS cards FROM (
        SELECT page_id, {inputs.CARD_HTML} AS card, CAST(page_id // 20 + 1 AS INT) AS page FROM pages
        UNION ALL
        SELECT page_id, {inputs.CARD_HTML}, CAST(page_id // 20 AS INT) FROM pages WHERE page_id % 20 < 4 AND page_id >= 20)
    GROUP BY page)"""
RAW_PAGES = "SELECT page_id AS k, url, html FROM pages"


def _attr(name: str) -> str:
    return f"CASE WHEN regexp_matches(t, '\\s{name}=') THEN regexp_extract(t, '\\s{name}=\"([^\"]*)\"', 1) END"


def tree(source: str) -> str:
    """``el``: elements with their open ancestors; ``inn``: tight and spaced text of each; ``sub``: descendants."""
    trimmed = f"regexp_replace({decoded_sql('t')}, '^{fv.WS_SPELT_OUT}+|{fv.WS_SPELT_OUT}+$', '', 'g')"
    return f"""WITH RECURSIVE src AS ({source}),
toks AS (SELECT k, regexp_extract_all(regexp_replace(html,
    '<!--.*?-->|<script.*?</script>|<style.*?</style>|<!DOCTYPE[^>]*>', '', 'gs'), '<[^>]*>|[^<]+') AS ts FROM src),
tok AS (SELECT k, CAST(unnest(generate_series(1, len(ts))) AS BIGINT) AS i, unnest(ts) AS t FROM toks),
typed AS (SELECT k, i, t, lower(regexp_extract(t, '^</?([a-zA-Z0-9]+)', 1)) AS tag,
    CASE WHEN t LIKE '</%' THEN 'close' WHEN t NOT LIKE '<%' THEN 'text'
        WHEN lower(regexp_extract(t, '^<([a-zA-Z0-9]+)', 1)) IN ({_VOID}) THEN 'void' ELSE 'open' END AS kind FROM tok),
walk AS (SELECT k, CAST(0 AS BIGINT) AS i, CAST([] AS STRUCT(n VARCHAR, j BIGINT)[]) AS st FROM src
    UNION ALL
    SELECT w.k, x.i, CASE
        WHEN x.kind = 'open' THEN list_append(w.st, {{'n': x.tag, 'j': x.i}})
        WHEN x.kind = 'close' AND list_contains(list_transform(w.st, lambda s: s.n), x.tag)
        THEN w.st[1 : len(w.st) - list_position(list_reverse(list_transform(w.st, lambda s: s.n)), x.tag)]
        ELSE w.st END
    FROM walk w JOIN typed x ON x.k = w.k AND x.i = w.i + 1),
placed AS (SELECT x.*, w.st AS anc FROM typed x JOIN walk w ON w.k = x.k AND w.i = x.i - 1),
el AS (SELECT k, i, tag, anc, {_attr('class')} AS cls, {_attr('href')} AS href, {_attr('datetime')} AS dt,
    {_attr('itemprop')} AS itemprop, {_attr('rel')} AS rel,
    list_filter(anc, lambda s: s.n IN ('article', 'div', 'li'))[-1].j AS ctr
    FROM placed WHERE kind IN ('open', 'void')),
txt AS (SELECT k, i, anc, {trimmed} AS s FROM placed WHERE kind = 'text'),
inn0 AS (SELECT k, j AS i, string_agg(s, '' ORDER BY o) AS tight, string_agg(s, ' ' ORDER BY o) AS spaced FROM (
    SELECT k, i AS o, s, unnest(anc).j AS j FROM txt WHERE s <> '') GROUP BY 1, 2),
inn AS (SELECT e.k, e.i, coalesce(n.tight, '') AS tight, coalesce(n.spaced, '') AS spaced
    FROM el e LEFT JOIN inn0 n ON n.k = e.k AND n.i = e.i),
elt AS (SELECT e.*, n.tight, n.spaced FROM el e JOIN inn n ON n.k = e.k AND n.i = e.i),
sub AS (SELECT *, unnest(anc).j AS root FROM elt)"""


_SITE = fv.SITE
_ANY_URL = f"""CASE WHEN href LIKE 'http%' THEN href WHEN href LIKE '/%' THEN '{_SITE}' || href
    WHEN href LIKE '?%' THEN '{_SITE}' || href ELSE '{_SITE}/' || href END"""
_ROOTED_URL = f"CASE WHEN href LIKE 'http%' THEN href WHEN href LIKE '/%' THEN '{_SITE}' || href END"
_IS_SITE = f"""url LIKE '{_SITE}/%' AND regexp_matches(url, '/({'|'.join(fv.ARTICLE_SECTIONS)})/')
    AND NOT contains(url, '/fotos/') AND NOT contains(url, '/buscador/')"""
_IS_CORE = "(contains(url, '/economia/') OR contains(url, '/politica/'))"


def _links(url: str, keep: str) -> str:
    return f"""links AS (SELECT * FROM (SELECT k, i, ctr, tight AS link_text, {url} AS url FROM elt
    WHERE tag = 'a' AND href IS NOT NULL) WHERE {keep})"""


def _first_per_root(name: str, value: str, where: str) -> str:
    return f"{name} AS (SELECT k, root, arg_min({value}, i) AS v, true AS found FROM sub WHERE {where} GROUP BY 1, 2)"


page_links = f"""{tree(RAW_PAGES)} SELECT k AS page_id, href, tight AS text FROM elt WHERE tag = 'a' AND href IS NOT NULL"""

link_filter_any = f"""{tree(SEARCH_PAGES)}, {_links(_ANY_URL, _IS_SITE)} SELECT k AS page, url, link_text AS text FROM links"""
link_filter_rooted = (
    f"""{tree(SEARCH_PAGES)}, {_links(_ROOTED_URL, _IS_CORE)} SELECT k AS page, url, link_text AS text FROM links"""
)


def _cards() -> str:
    classes = "|".join(fv.DESCRIPTION_CLASSES)
    return f"""{tree(SEARCH_PAGES)}, {_links(_ANY_URL, _IS_SITE)},
{_first_per_root('heads', 'tight', "tag IN ('h1', 'h2', 'h3', 'h4', 'h5', 'h6', 'span')")},
{_first_per_root('blurbs', 'tight', f"tag IN ('p', 'div') AND regexp_matches(cls, '(?i){classes}')")},
{_first_per_root('times', 'coalesce(dt, tight)', "tag = 'time'")},
cards AS (SELECT l.k AS page, l.i AS pos, l.url, CASE WHEN length(h.v) >= 20 THEN h.v ELSE l.link_text END AS title,
    coalesce(b.v, '') AS description, coalesce(t.v, '') AS date FROM links l
    LEFT JOIN heads h ON h.k = l.k AND h.root = l.ctr LEFT JOIN blurbs b ON b.k = l.k AND b.root = l.ctr
    LEFT JOIN times t ON t.k = l.k AND t.root = l.ctr WHERE l.ctr IS NOT NULL)"""


_LISTING_OUT = "SELECT title, url, description, date, 'uno dos' AS search_query, page"
listing_first_qualifying = f"""{_cards()} {_LISTING_OUT} FROM cards WHERE length(title) >= 20
QUALIFY row_number() OVER (PARTITION BY url ORDER BY page, pos) = 1"""
listing_first_link = f"""{_cards()}, claimed AS (SELECT * FROM cards
    QUALIFY row_number() OVER (PARTITION BY page, url ORDER BY pos) = 1)
{_LISTING_OUT} FROM claimed WHERE length(title) >= 20
QUALIFY row_number() OVER (PARTITION BY url ORDER BY page, pos) = 1"""

_SECTION_ROWS = f"""{tree(SEARCH_PAGES)}, {_links(_ROOTED_URL, _IS_CORE)},
{_first_per_root('heads', 'tight', "tag IN ('h1', 'h2', 'h3', 'h4')")},
{_first_per_root('paras', 'tight', "tag = 'p'")},
srows AS (SELECT l.url, CASE WHEN length(l.link_text) < 20 AND h.found THEN h.v ELSE l.link_text END AS title,
    coalesce(p.v, '') AS description,
    replace(regexp_extract(l.url, '/([0-9]{{4}}/[0-9]{{2}}/[0-9]{{2}})/', 1), '/', '-') AS date,
    CASE WHEN contains(l.url, '/economia/') THEN 'economia' ELSE 'politica' END AS section, l.k AS page, l.i AS pos
    FROM links l LEFT JOIN heads h ON h.k = l.k AND h.root = l.ctr LEFT JOIN paras p ON p.k = l.k AND p.root = l.ctr
    QUALIFY row_number() OVER (PARTITION BY l.url ORDER BY l.k, l.i) = 1)"""
listing_sections = f"{_SECTION_ROWS} SELECT url, title, description, date, section, page FROM srows"

_NEW_PER_PAGE = f"""{_cards()}, firsts AS (SELECT * FROM cards WHERE length(title) >= 20
    QUALIFY row_number() OVER (PARTITION BY url ORDER BY page, pos) = 1)"""
page_yield = f"{_NEW_PER_PAGE} SELECT page, count(*) AS n_new FROM firsts GROUP BY 1"
cut_at_empty_page = f"""{_NEW_PER_PAGE} SELECT url, page FROM firsts WHERE page < coalesce(
    (SELECT min(k) FROM src WHERE k NOT IN (SELECT page FROM firsts)), 2147483647)"""
listing_resumed = f"""{_NEW_PER_PAGE}, earlier AS (SELECT title, url, page FROM firsts WHERE page <= 5),
later AS (SELECT title, url, page FROM cards WHERE page > 5 AND length(title) >= 20
    AND url NOT IN (SELECT url FROM earlier) QUALIFY row_number() OVER (PARTITION BY url ORDER BY page, pos) = 1)
SELECT * FROM earlier UNION ALL SELECT * FROM later"""

structure_profile = f"""{tree(SEARCH_PAGES)} SELECT (SELECT count(*) FROM src) AS pages,
    count(*) FILTER (tag = 'article') AS articles, count(*) FILTER (tag = 'div' AND cls IS NOT NULL) AS class_divs,
    count(*) FILTER (tag = 'div' AND regexp_matches(cls, '(?i){'|'.join(fv.PROFILE_CLASSES)}')) AS card_divs,
    count(*) FILTER (tag = 'a' AND href IS NOT NULL) AS links,
    count(*) FILTER (tag = 'a' AND regexp_matches(href, '/(economia|politica)/')) AS section_links FROM elt"""
structure_samples = f"""{tree(SEARCH_PAGES)}, arts AS (
    SELECT *, 'article' AS kind FROM elt WHERE tag = 'article' QUALIFY row_number() OVER (PARTITION BY k ORDER BY i) <= 3
    UNION ALL
    SELECT *, 'card' AS kind FROM elt WHERE tag = 'div' AND regexp_matches(cls, '(?i){'|'.join(fv.PROFILE_CLASSES)}')
    QUALIFY row_number() OVER (PARTITION BY k ORDER BY i) <= 5),
heads AS (SELECT k, root, arg_min(tight, i) AS v FROM sub WHERE tag IN ('h1', 'h2', 'h3') GROUP BY 1, 2),
hrefs AS (SELECT k, root, arg_min(href, i) AS v FROM sub WHERE tag = 'a' AND href IS NOT NULL GROUP BY 1, 2)
SELECT a.k AS page, kind, a.cls AS classes, left(r.v, 100) AS href, left(h.v, 100) AS text FROM arts a
LEFT JOIN heads h ON h.k = a.k AND h.root = a.i LEFT JOIN hrefs r ON r.k = a.k AND r.root = a.i
UNION ALL SELECT * FROM (SELECT k, 'link', cls, left(href, 100), left(tight, 100) FROM elt
    WHERE tag = 'a' AND regexp_matches(href, '/(economia|politica)/')
    QUALIFY row_number() OVER (PARTITION BY k ORDER BY i) <= 10)"""

_OWN = """own AS (SELECT k, anc[-1].j AS i, arg_min(s, i) AS own FROM txt WHERE len(anc) > 0 GROUP BY 1, 2),
elo AS (SELECT e.*, coalesce(o.own, '') AS own FROM elt e LEFT JOIN own o ON o.k = e.k AND o.i = e.i)"""
_SAYS_NEXT = "regexp_matches(own, 'Siguiente|siguiente|SIGUIENTE')"
next_page = f"""{tree(SEARCH_PAGES)}, {_OWN}, found AS (SELECT k, href, CASE WHEN {_SAYS_NEXT} THEN 1 WHEN rel = 'next' THEN 2
    WHEN regexp_matches(cls, 'next|siguiente') THEN 3 END AS rank, i FROM elo WHERE tag = 'a'),
best AS (SELECT * FROM found WHERE rank IS NOT NULL QUALIFY row_number() OVER (PARTITION BY k ORDER BY rank, i) = 1)
SELECT src.k AS page, best.k IS NOT NULL AS has_next, best.href AS next_href FROM src LEFT JOIN best ON best.k = src.k"""
next_page_buttons = f"""{tree(SEARCH_PAGES)}, {_OWN}, found AS (SELECT k, href,
    CASE WHEN tag = 'a' AND contains(own, 'Siguiente') THEN 1 WHEN tag = 'button' AND contains(own, 'Siguiente') THEN 2
    WHEN contains(cls, 'next') THEN 3 END AS rank, i FROM elo),
best AS (SELECT * FROM found WHERE rank IS NOT NULL QUALIFY row_number() OVER (PARTITION BY k ORDER BY rank, i) = 1)
SELECT src.k AS page, best.k IS NOT NULL AS has_next, best.href AS next_href FROM src LEFT JOIN best ON best.k = src.k"""


# --- the given pages, whole -----------------------------------------------------------------


def _of_given_pages(sql: str) -> str:
    return sql.replace(tree(SEARCH_PAGES), tree(RAW_PAGES)).replace("(economia|politica)", "(fr|de)")


given_structure_profile = _of_given_pages(structure_profile)
given_structure_samples = _of_given_pages(structure_samples)
given_next_page = _of_given_pages(next_page)
given_next_page_buttons = _of_given_pages(next_page_buttons)


# --- article pages --------------------------------------------------------------------


def _first(name: str, where: str, *columns: str) -> str:
    picks = ", ".join(f"arg_min({c}, i) AS {c}" for c in columns)
    return f"{name} AS (SELECT k, min(i) AS i, {picks} FROM elt WHERE {where} GROUP BY 1)"


_SKIP = "|".join(fv.SKIPPED_CLASSES)
_SKIP_LAST = "|".join(fv.SKIPPED_CLASSES_LAST)
_HAS_AUTHOR = "regexp_matches(cls, '(^| )author( |$)')"
_HAS_DATE = "regexp_matches(cls, '(^| )date( |$)')"
_URL_DATE = "replace(regexp_extract(s.url, '/([0-9]{4}/[0-9]{2}/[0-9]{2})/', 1), '/', '-')"

_V1 = f"""{tree(ARTICLE_PAGES)}, {_first('h1s', "tag = 'h1'", 'tight')}, {_first('times', "tag = 'time'", 'i', 'dt').replace('arg_min(i, i) AS i, ', '')},
{_first('bylines', "tag IN ('span', 'a') AND regexp_matches(cls, '(?i)author|autor')", 'tight')},
boxes AS (SELECT k, coalesce(min(i) FILTER (tag IN ('div', 'article')
    AND regexp_matches(cls, '(?i){'|'.join(fv.CONTAINER_CLASSES_V1)}')), min(i) FILTER (tag = 'article')) AS box FROM elt GROUP BY 1),
bodies AS (SELECT e.k, string_agg(e.tight, chr(10) || chr(10) ORDER BY e.i) AS body FROM elt e JOIN boxes b ON b.k = e.k
    WHERE e.tag = 'p' AND length(e.tight) > 20
    AND (b.box IS NULL OR list_contains(list_transform(e.anc, lambda x: x.j), b.box)) GROUP BY 1)"""
article_v1 = f"""{_V1} SELECT s.url, coalesce(h.tight, '') AS title, coalesce(a.tight, '') AS author,
    coalesce(t.dt, '') AS date, coalesce(b.body, '') AS body FROM src s LEFT JOIN h1s h ON h.k = s.k
    LEFT JOIN bylines a ON a.k = s.k LEFT JOIN (SELECT k, dt FROM elt WHERE tag = 'time'
        QUALIFY row_number() OVER (PARTITION BY k ORDER BY i) = 1) t ON t.k = s.k
    LEFT JOIN bodies b ON b.k = s.k"""


def _cascade(terms: tuple[str, ...], skip_in_divs: bool, last: bool) -> str:
    """``chosen``: the paragraphs of each page, with their order."""
    div_skip = f"AND NOT regexp_matches(c, '{_SKIP}')" if skip_in_divs else ""
    n3 = (
        f"""SELECT k, 3 AS step, min(i) AS i, spaced FROM ps WHERE NOT regexp_matches(c, '{_SKIP_LAST}')
    AND length(spaced) >= 30 AND NOT (length(spaced) - length(replace(spaced, ',', '')) <= 1 AND length(spaced) < 50
    AND regexp_matches(spaced, '{fv.DIGIT}')) GROUP BY k, spaced"""
        if last
        else "SELECT k, 3 AS step, i, spaced FROM ps WHERE false"
    )
    fallback = "ELSE 3" if last else "ELSE 2"
    return f"""{tree(ARTICLE_PAGES)},
firstart AS (SELECT k, min(i) AS a FROM elt WHERE tag = 'article' GROUP BY 1),
divs AS (SELECT k, list(i) AS ds FROM elt WHERE tag = 'div' AND regexp_matches(cls, '(?i){'|'.join(terms)}') GROUP BY 1),
ps AS (SELECT e.k, e.i, e.spaced, lower(coalesce(e.cls, '')) AS c, list_transform(e.anc, lambda x: x.j) AS up,
    f.a, d.ds FROM elt e LEFT JOIN firstart f ON f.k = e.k LEFT JOIN divs d ON d.k = e.k WHERE e.tag = 'p'),
steps AS (
    SELECT k, 1 AS step, i, spaced FROM ps WHERE a IS NOT NULL AND list_contains(up, a)
        AND NOT regexp_matches(c, '{_SKIP}') AND length(spaced) > 30
    UNION ALL
    SELECT k, 2 AS step, min(i) AS i, spaced FROM ps WHERE ds IS NOT NULL AND list_has_any(up, ds) {div_skip}
        AND length(spaced) > 30 GROUP BY k, spaced
    UNION ALL {n3}),
sizes AS (SELECT k, count(*) FILTER (step = 1) AS n1, count(*) FILTER (step = 2) AS n2 FROM steps GROUP BY 1),
chosen AS (SELECT t.* FROM steps t JOIN sizes z ON z.k = t.k
    WHERE t.step = CASE WHEN z.n1 >= 3 THEN 1 WHEN z.n2 >= 3 THEN 2 {fallback} END),
bodies AS (SELECT k, string_agg(spaced, chr(10) || chr(10) ORDER BY i) AS body, count(*) AS n FROM chosen GROUP BY 1)"""


_V2 = f"""{_cascade(fv.CONTENT_CLASSES_V2, True, True)}, {_first('h1s', "tag = 'h1'", 'tight')},
dates AS (SELECT k, coalesce(dt, tight) AS d, CASE WHEN tag = 'time' AND dt IS NOT NULL THEN 1 WHEN tag = 'time' THEN 2
    WHEN tag = 'span' AND {_HAS_DATE} THEN 3 WHEN tag = 'div' AND {_HAS_DATE} THEN 4
    WHEN itemprop = 'datePublished' THEN 5 END AS rank, i FROM elt),
firstdates AS (SELECT k, rank, arg_min(d, i) AS d FROM dates WHERE rank IS NOT NULL GROUP BY 1, 2),
bestdate AS (SELECT k, arg_min(d, rank) AS d FROM firstdates WHERE d <> '' GROUP BY 1),
names AS (SELECT k, tight, CASE WHEN tag = 'span' AND {_HAS_AUTHOR} THEN 1 WHEN tag = 'a' AND {_HAS_AUTHOR} THEN 2
    WHEN itemprop = 'author' THEN 3 WHEN tag = 'div' AND {_HAS_AUTHOR} THEN 4 END AS rank, i FROM elt),
bestname AS (SELECT * FROM names WHERE rank IS NOT NULL QUALIFY row_number() OVER (PARTITION BY k ORDER BY rank, i) = 1),
v2 AS (SELECT s.k, s.url, coalesce(h.tight, '') AS title, coalesce(a.tight, '') AS author,
    CASE WHEN {_URL_DATE} <> '' THEN {_URL_DATE} ELSE coalesce(d.d, '') END AS date, coalesce(b.body, '') AS body,
    CAST(length(coalesce(b.body, '')) AS INT) AS body_length, CAST(coalesce(b.n, 0) AS INT) AS paragraphs_count
    FROM src s LEFT JOIN h1s h ON h.k = s.k LEFT JOIN bestname a ON a.k = s.k LEFT JOIN bestdate d ON d.k = s.k
    LEFT JOIN bodies b ON b.k = s.k)"""
article_v2 = f"{_V2} SELECT url, title, author, date, body, body_length, paragraphs_count FROM v2"
low_content = f"{_V2} SELECT url, body_length, length(body) < 100 AS low_content FROM v2"
extraction_errors = """SELECT CASE page_id % 7 WHEN 3 THEN 'AssertionError' WHEN 5 THEN 'ValueError' ELSE 'ok' END AS outcome,
    count(*) AS n FROM pages GROUP BY 1"""

_V3 = f"""{_cascade(fv.CONTENT_CLASSES_V3, False, False)}, {_first('h1s', "tag = 'h1'", 'spaced')},
names AS (SELECT k, spaced, CASE WHEN tag = 'span' AND {_HAS_AUTHOR} THEN 1 WHEN tag = 'a' AND {_HAS_AUTHOR} THEN 2 END AS rank,
    i FROM elt),
bestname AS (SELECT * FROM names WHERE rank IS NOT NULL QUALIFY row_number() OVER (PARTITION BY k ORDER BY rank, i) = 1),
v3 AS (SELECT s.url, coalesce(h.spaced, '') AS page_title, coalesce(a.spaced, '') AS author, coalesce(b.body, '') AS body,
    CAST(length(coalesce(b.body, '')) AS INT) AS body_length, CAST(coalesce(b.n, 0) AS INT) AS paragraphs_count
    FROM src s LEFT JOIN h1s h ON h.k = s.k LEFT JOIN bestname a ON a.k = s.k LEFT JOIN bodies b ON b.k = s.k)"""
article_v3 = f"{_V3} SELECT * FROM v3"
articles_with_body = f"{_V3} SELECT url, body_length FROM v3 WHERE body <> ''"
text_joining = f"""{tree(ARTICLE_PAGES)} SELECT k AS page_id, tight, spaced FROM elt
    WHERE tag IN ('p', 'h1', 'span', 'a') AND tight <> spaced"""
