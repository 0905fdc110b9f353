"""Everything that is read off, or built into, a URL."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from hemeroteca.functions import fixed_values as fv


def url_date(url: Column) -> Column:
    """``YYYY-MM-DD`` from the first ``/YYYY/MM/DD/``, else ``''``."""
    found = F.regexp_extract(F.coalesce(url, F.lit("")), fv.URL_DATE, 1)
    return F.replace(found, F.lit("/"), F.lit("-"))


def section_or_null(url: Column) -> Column:
    """The fourth ``/``-separated piece, NULL where the URL is shorter."""
    return F.get(F.split(url, "/"), F.lit(3))


def section(url: Column) -> Column:
    """The fourth ``/``-separated piece, ``''`` where there is none."""
    return F.coalesce(F.split_part(url, F.lit("/"), F.lit(4)), F.lit(""))


def section_label(url: Column) -> Column:
    """Two-way label: the first core section wins where a URL holds both."""
    first, second = fv.CORE_SECTIONS
    return F.when(F.contains(url, F.lit(f"/{first}/")), F.lit(first)).otherwise(F.lit(second))


def year(date: Column) -> Column:
    """The first four characters of a date text, ``''`` where it is missing."""
    return F.coalesce(F.substring(date, 1, 4), F.lit(""))


def search_url(term: Column, base: str = fv.SEARCH_URL) -> Column:
    """The search address for a term, form-encoded."""
    encoded = F.url_encode(term)
    # The JVM encoder keeps '*' and escapes '~'; form encoding does the reverse.
    encoded = F.replace(F.replace(encoded, F.lit("*"), F.lit("%2A")), F.lit("%7E"), F.lit("~"))
    return F.concat(F.lit(f"{base}?query="), encoded)


def absolute_any(href: Column, site: str = fv.SITE) -> Column:
    """Resolve any link against the site root."""
    host = site.rstrip("/")
    scheme = host.split(":", 1)[0]
    # Leading control characters and blanks, and line breaks anywhere, do not count.
    href_ = F.regexp_replace(F.regexp_replace(href, r"^[\x00-\x20]+", ""), r"[\t\r\n]", "")
    path = F.regexp_extract(href_, r"^([^?#]*)", 1)
    tail = F.regexp_extract(href_, r"^[^?#]*(.*)$", 1)
    rooted = F.when(path.startswith("/"), path).otherwise(
        F.concat(F.lit("/"), F.regexp_replace(path, "/{2,}", "/"))
    )
    has_dots = rooted.rlike(r"/\.\.?(/|$)")
    return (
        F.when(href.startswith("http"), href)
        .when(href_ == "", F.lit(host))
        .when(href_.startswith("//"), F.concat(F.lit(scheme + ":"), href_))
        .when(href_.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), href_)
        .when(href_.rlike(r"^[?#]"), F.concat(F.lit(host), href_))
        .when(has_dots, F.concat(F.lit(host), _without_dots(rooted), tail))
        .otherwise(F.concat(F.lit(host), rooted, tail))
    )


def _without_dots(path: Column) -> Column:
    """Drop ``.`` pieces and let each ``..`` cancel the piece before it."""
    pieces = F.split(path, "/")
    kept = F.aggregate(
        pieces,
        F.array().cast("array<string>"),
        lambda done, piece: F.when(piece == "..", F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0))))
        .when(piece == ".", done)
        .otherwise(F.array_append(done, piece)),
    )
    closed = F.when(
        F.element_at(pieces, -1).isin(".", ".."), F.array_append(kept, F.lit(""))
    ).otherwise(kept)
    joined = F.array_join(closed, "/")
    return F.when(joined.startswith("/"), joined).otherwise(F.concat(F.lit("/"), joined))


def absolute_rooted(href: Column, site: str = fv.SITE) -> Column:
    """Resolve absolute and root-relative links only; any other link gives NULL."""
    return F.when(href.startswith("http"), href).when(
        href.startswith("/"), F.concat(F.lit(site.rstrip("/")), href)
    )


def is_site_article(
    url: Column, site: str = fv.SITE, sections: tuple[str, ...] = fv.ARTICLE_SECTIONS
) -> Column:
    """On the site, in one of the sections, and not a gallery or search page."""
    wanted = url.startswith(site.rstrip("/") + "/") & url.rlike(f"/(?:{'|'.join(sections)})/")
    for path in fv.EXCLUDED_PATHS:
        wanted = wanted & ~F.contains(url, F.lit(path))
    return wanted


def is_core_article(url: Column) -> Column:
    """In one of the two core sections, on whatever host."""
    first, second = fv.CORE_SECTIONS
    return F.contains(url, F.lit(f"/{first}/")) | F.contains(url, F.lit(f"/{second}/"))
