"""Cleaning whole records, and counting what changed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hemeroteca.functions import fixed_values as fv
from hemeroteca.functions import text as tx
from hemeroteca.functions import urls
from hemeroteca.session import bound_batches


def clean_articles(articles: DataFrame, profile: str = "final", refresh_length: bool = False) -> DataFrame:
    """Clean title, body, description and author where present.

    Missing stays missing.  Length columns keep describing the uncleaned body unless
    ``refresh_length`` asks for a new ``body_length``.  Texts go to Python in batches of
    bounded size, a setting that stays with the session.
    """
    bound_batches(articles.sparkSession)
    fields = [c for c in fv.CLEANED_FIELDS if c in articles.columns]
    table, _, rules = tx.PROFILES[profile]
    # Three projections, so that each stage's text is made once however often the next
    # stage looks at it.
    out = articles
    for step in (
        lambda c: tx.fix_mojibake(c, table),
        lambda c: tx.decode_step(c, profile),
        lambda c: tx.unglue(c, rules),
    ):
        out = out.withColumns({c: step(F.col(c)) for c in fields})
    if refresh_length:
        out = out.withColumn("body_length", F.length("body"))
    return out


def unglue_articles(articles: DataFrame, rules: str = "aggressive") -> DataFrame:
    """Separate glued words in title, body and description; ``n_fixed`` counts changed
    titles and bodies (descriptions change silently)."""
    fields = [c for c in fv.UNGLUED_FIELDS if c in articles.columns]
    fixed = articles.withColumns({f"_{c}": tx.unglue(F.col(c), rules) for c in fields})
    changed = [
        (~F.col(c).eqNullSafe(F.col(f"_{c}"))).cast("int") for c in fv.COUNTED_FIELDS if c in fields
    ]
    return fixed.select(
        *[F.col(f"_{c}").alias(c) if c in fields else F.col(c) for c in articles.columns],
        sum(changed, F.lit(0)).alias("n_fixed"),
    )


def fill_dates(articles: DataFrame) -> DataFrame:
    """Take the date from the URL where it is missing or blank; ``date_filled`` tells where."""
    from_url = urls.url_date(F.col("url"))
    fill = tx.is_blank(F.col("date")) & (from_url != "")
    return articles.withColumns({"date": F.when(fill, from_url).otherwise(F.col("date")), "date_filled": fill})


def with_valid_date(articles: DataFrame) -> DataFrame:
    """Add ``date_d``, a real date; impossible or free-text dates give NULL."""
    return articles.withColumn("date_d", F.try_to_date("date", "yyyy-MM-dd"))


def keep_sections(articles: DataFrame, *sections: str) -> DataFrame:
    """Rows whose URL section is listed; URLs too short to have one are dropped."""
    wanted = sections or fv.CORE_SECTIONS
    return articles.where(urls.section_or_null(F.col("url")).isin(*wanted))


def with_section(articles: DataFrame, name: str = "section_key") -> DataFrame:
    """The ``section`` field where the row has one (even empty), else the URL's, else ``unknown``."""
    own = [F.col("section")] if "section" in articles.columns else []
    return articles.withColumn(
        name, F.coalesce(*own, urls.section_or_null(F.col("url")), F.lit("unknown"))
    )


def preview_lines(articles: DataFrame, n: int = 5, order: str = "idx") -> DataFrame:
    """The first ``n`` articles with section, cut title, date and body length."""
    return (
        articles.orderBy(order)
        .limit(n)
        .select(
            order,
            F.upper(F.coalesce(urls.section_or_null(F.col("url")), F.lit("N/A"))).alias("section"),
            tx.preview(F.col("title"), 70, "Sin título").alias("title"),
            tx.preview(F.col("url"), 80).alias("url"),
            F.coalesce("date", F.lit("N/A")).alias("date"),
            F.length(F.coalesce("body", F.lit(""))).alias("body_length"),
        )
    )
