"""Corpus tables derived from the given ones.

The given tables hold no search pages, bylines, dates or damaged text, so these
expressions put such features into whole tables.  They are plain SQL expressions that
Spark and the checking engine read alike; every operator runs on their result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def spread(rows: DataFrame) -> DataFrame:
    """Give a plain file scan one partition per core before CPU-heavy work.

    Only a scan with fewer partitions than cores is shuffled; a big table has more
    and passes unchanged.
    """
    cores = rows.sparkSession.sparkContext.defaultParallelism
    return rows.repartition(cores) if rows.rdd.getNumPartitions() < cores else rows


def article_url(key: str) -> str:
    """A dated, sectioned article address for a numeric key."""
    return f"""concat('https://www.example.com/',
        case {key} % 4 when 0 then 'economia' when 1 then 'politica' when 2 then 'deportes' else 'opinion' end,
        case when {key} % 7 = 0 then '' else concat('/', cast(2019 + {key} % 6 as string), '/',
            lpad(cast({key} % 12 + 1 as string), 2, '0'), '/', lpad(cast({key} % 28 + 1 as string), 2, '0')) end,
        '/', cast({key} as string), '/')"""


# --- article pages: the given HTML with bylines, dates and content classes -------
_OPENINGS = {
    0: '<article class="nota"><span class="author-name">Por <b>Ana</b> Paz</span>'
       '<span class="author">Ana <i>Paz</i></span><time datetime="2023-05-06">6 may</time>',
    1: '<div class="story-texto"><time>7 may</time><span class="date">2023-06-07</span>'
       '<a class="author" href="/autor/">Luis<b>Gil</b></a>',
    2: '<section><div class="date" itemprop="datePublished">2022-01-02</div><em itemprop="author">Eva <b>Sol</b></em>',
}
_CLOSINGS = {
    0: "</article>",
    1: "</div>",
    2: '<p class="caption">Foto de archivo de la ciudad tomada ayer</p>'
       "<p>Publicado el 25 de noviembre de 2023</p></section>",
}
_SHARE = '</h1><p class="share-box">Compartir esta nota con quien quieras hoy</p>'


def _by_third(key: str, texts: dict[int, str]) -> str:
    return f"case {key} % 3 when 0 then '{texts[0]}' when 1 then '{texts[1]}' else '{texts[2]}' end"


ARTICLE_PAGE_HTML = f"""replace(replace(replace(html, '</article>', {_by_third('page_id', _CLOSINGS)}),
    '<article>', {_by_third('page_id', _OPENINGS)}), '</h1>', '{_SHARE}')"""
ARTICLE_PAGE_URL = article_url("page_id")


def article_pages(spark: SparkSession, sf: str) -> DataFrame:
    pages = spread(table(spark, sf, "pages").select("*", F.col("_metadata.file_path").alias("file")))
    return pages.select(
        "page_id", F.expr(ARTICLE_PAGE_URL).alias("url"), F.expr(ARTICLE_PAGE_HTML).alias("html"), "file"
    )


# --- search pages: 20 article cards each, the next page's first four repeated ------
_HEADLINE = "regexp_extract(html, '<h1>(.*?)</h1>', 1)"
CARD_HREF = f"""case page_id % 5 when 0 then {ARTICLE_PAGE_URL}
    when 1 then substring({ARTICLE_PAGE_URL}, 25) else substring({ARTICLE_PAGE_URL}, 24) end"""
CARD_HTML = f"""concat('<li class="story-card">',
    case when page_id % 3 = 0 then concat('<a href="', {CARD_HREF}, '">Ver</a>') else '' end,
    '<a href="', {CARD_HREF}, '">', case when page_id % 11 = 0 then 'Leer' else {_HEADLINE} end, '</a>',
    case when page_id % 2 = 0 then concat('<h2>', {_HEADLINE}, '</h2>') else '' end,
    case when page_id % 8 = 5 then '<span>Breve</span>' else '' end,
    '<p class="Deck-line">Resumen <b>', cast(page_id as string), '</b></p>',
    case page_id % 6 when 0 then '<time datetime="2024-02-03">ayer</time>' when 1 then '<time>hoy</time>' else '' end,
    '</li>')"""
SEARCH_HEAD = (
    '<html><body><a href="/economia/suelto/">Enlace sin contenedor a toda la economia</a>'
    '<div class="results"><ul>'
)
SEARCH_TAIL = (
    '</ul></div><article class="Destacada"><h2>Destacada</h2><a href="/">Inicio</a></article><div class="ranking"><a href="/economia/portada/">Lo mas leido de la semana en economia</a>'
    '<a href="/economia/fotos/1/">Galeria de fotos de la semana en economia</a>'
    '<a href="https://otro.example.org/politica/x/">Una nota ajena de politica nacional</a></div>'
)
SEARCH_NEXT = """case page % 5 when 4 then '<a href="?page=s"><b>Siguiente</b></a>' when 0 then '' when 1 then '<a href="?page=n">Siguiente</a>'
    when 2 then '<a rel="next" href="?page=n">&gt;</a>' else '<button class="next">Siguiente</button>' end"""
#: Every ninth page but one is empty of cards.
SEARCH_HTML = f"""concat('{SEARCH_HEAD}', case when page % 9 = 8 then '' else cards end, '{SEARCH_TAIL}',
    {SEARCH_NEXT}, '</body></html>')"""


def search_pages(spark: SparkSession, sf: str) -> DataFrame:
    cards = table(spark, sf, "pages").select("page_id", F.expr(CARD_HTML).alias("card"))
    own = (F.expr("page_id div 20") + 1).cast("int")
    placed = cards.select(
        "page_id",
        "card",
        F.explode(F.when((F.col("page_id") % 20 < 4) & (own > 1), F.array(own, own - 1)).otherwise(F.array(own))).alias(
            "page"
        ),
    )
    # At most 24 cards meet in one group.
    joined = placed.groupBy("page").agg(F.sort_array(F.collect_list(F.struct("page_id", "card"))).alias("cs"))
    return joined.select("page", F.array_join(F.transform("cs", lambda c: c["card"]), "").alias("cards")).select(
        "page", F.expr(SEARCH_HTML).alias("html")
    )


# --- corpus: documents as article records ------------------------------------------
#: A quarter of all rows share one URL; the others come in pairs.
LISTING_KEY = "case when doc_id % 4 = 0 then 0 else doc_id - doc_id % 2 end"
ARTICLE_COLUMNS = {
    "idx": "doc_id",
    "title": "split_part(text, '\n', 1)",
    "url": article_url("doc_id"),
    "description": "split_part(text, '\n', 2)",
    "author": "case doc_id % 5 when 0 then '' when 1 then null else concat('Redaccion', upper(source)) end",
    "date": """case doc_id % 5 when 0 then '' when 1 then '   ' when 2 then null when 3 then '9999/99/99'
        else concat('20', lpad(cast(doc_id % 24 as string), 2, '0'), '-05-06') end""",
    "section": "case doc_id % 6 when 0 then '' when 1 then 'economia' else null end",
    "page": "cast(doc_id % 105 + 1 as int)",
}
#: Full stops lose the blank behind them; some blanks give way to 'y' and digits.
GLUED_TEXT = "replace(replace(replace({t}, '. ', ''), '.\n', ''), 'que ', 'quey7')"
MOJIBAKE_TEXT = (
    "replace(replace(replace(replace(replace(replace({t}, 'é', 'Ã©'), 'ó', 'Ã³'), 'ñ', 'Ã±'), 'ç', 'Ã§'), 'ü', 'Ã¼'), ' en ', ' â€œenâ€ ')"
)
ENTITY_TEXT = (
    "replace(replace(replace(replace({t}, 'é', '&eacute;'), ' de ', '&nbsp;de &#100;e '), ' and ', ' &amp; '), 'ó', 'ó')"
)


def documents(spark: SparkSession, sf: str) -> DataFrame:
    return spread(table(spark, sf, "documents"))


def articles(spark: SparkSession, sf: str, body: str = GLUED_TEXT) -> DataFrame:
    """Article records over whole documents; ``body`` damages the text."""
    return documents(spark, sf).select(
        *[F.expr(e).alias(c) for c, e in ARTICLE_COLUMNS.items()], F.expr(body.format(t="text")).alias("body")
    )


def listing(spark: SparkSession, sf: str) -> DataFrame:
    """Listing rows with repeated URLs, one of them very often."""
    return table(spark, sf, "documents").select(
        F.col("doc_id").alias("idx"),
        F.expr(article_url(f"({LISTING_KEY})")).alias("url"),
        F.expr(ARTICLE_COLUMNS["title"]).alias("title"),
        F.expr(ARTICLE_COLUMNS["page"]).alias("page"),
        F.expr("cast(doc_id as int)").alias("pos"),
    )


def order_urls(spark: SparkSession, sf: str) -> DataFrame:
    """A long thin URL table."""
    return table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("idx"),
        F.expr(article_url("o_orderkey")).alias("url"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_orderdate").alias("listed_at"),
        F.expr("case when o_orderkey % 3 = 0 then '' else null end").alias("date"),
    )
