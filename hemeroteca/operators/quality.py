"""Counts, histograms and reports over a corpus."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hemeroteca.functions import fixed_values as fv
from hemeroteca.functions import text as tx
from hemeroteca.functions import urls


def corpus_counts(articles: DataFrame) -> DataFrame:
    """Rows, distinct URLs and titles, and the surplus over each."""
    counts = articles.agg(
        F.count("*").alias("n_rows"),
        F.count_distinct("url").alias("n_urls"),
        F.count_distinct("title").alias("n_titles"),
    )
    return counts.select(
        "*",
        (F.col("n_rows") - F.col("n_urls")).alias("dup_urls"),
        (F.col("n_rows") - F.col("n_titles")).alias("dup_titles"),
    )


def page_counts(articles: DataFrame) -> DataFrame:
    return articles.groupBy("page").agg(F.count("*").alias("n")).orderBy("page")


def histogram(rows: DataFrame, key: Column, name: str, order: str = "idx") -> DataFrame:
    """Rows per key with percentage of the total; largest first, ties in first-seen order.

    The total is a scalar subquery over the same groups, whose shuffle it shares, so rows
    are read once and no task has to hold all groups the way a window without partitions would.
    """
    groups = rows.groupBy(key.alias(name)).agg(F.count("*").alias("n"), F.min(order).alias("first_idx"))
    total = groups.agg(F.sum("n")).scalar()
    return groups.withColumn("pct", F.col("n") * 100.0 / total).orderBy(F.desc("n"), "first_idx")


def section_histogram(articles: DataFrame, order: str = "idx") -> DataFrame:
    return histogram(articles, urls.section(F.col("url")), "section", order)


def year_histogram(articles: DataFrame, digits_only: bool = True) -> DataFrame:
    """Articles per year, newest first; ``digits_only`` drops years that are not all digits."""
    years = articles.select(urls.year(F.col("date")).alias("year"))
    wanted = F.col("year").rlike(f"^{fv.DIGIT}+$") if digits_only else F.col("year") != ""
    return years.where(wanted).groupBy("year").agg(F.count("*").alias("n")).orderBy(F.desc("year"))


def _share(n: Column, total: Column) -> Column:
    return F.try_divide(n * F.lit(100.0), total)


def body_coverage(articles: DataFrame) -> DataFrame:
    """How many articles have a real body, and how many a date."""
    return articles.agg(
        F.count("*").alias("n_rows"),
        F.count_if(F.length("body") > fv.LOW_CONTENT).alias("with_body"),
        F.count_if(F.col("date") != "").alias("with_date"),
    )


def date_coverage(articles: DataFrame) -> DataFrame:
    """With and without a date, with percentages (NULL for an empty table)."""
    counts = articles.agg(
        F.count("*").alias("n_rows"), F.count_if(~tx.is_blank(F.col("date"))).alias("with_date")
    )
    without = F.col("n_rows") - F.col("with_date")
    return counts.select(
        "*",
        without.alias("without_date"),
        _share(F.col("with_date"), F.col("n_rows")).alias("pct_with"),
        _share(without, F.col("n_rows")).alias("pct_without"),
    )


def glued_report(articles: DataFrame, order: str = "idx") -> DataFrame:
    """Articles with glued-word suspects: position, cut title, URL and the first five."""
    suspects = F.slice(tx.glued_suspects(F.coalesce("body", F.lit(""))), 1, 5)
    # Exploding a list of at most one list drops articles without suspects and, unlike a
    # filter on the column, cannot be planned so that bodies are searched twice.
    found = F.explode(F.filter(F.array(suspects), lambda words: F.size(words) > 0))
    return articles.select(
        F.col(order).alias("index"),
        tx.preview(F.col("title"), 80).alias("title"),
        F.coalesce("url", F.lit("")).alias("url"),
        found.alias("merged_words"),
    )


def issue_rate(articles: DataFrame) -> DataFrame:
    """Articles with suspects, and their share."""
    flagged = articles.select(
        (F.size(tx.glued_suspects(F.coalesce("body", F.lit("")))) > 0).alias("has_issue")
    )
    return flagged.agg(
        F.count("*").alias("n_rows"), F.count_if("has_issue").alias("n_issues")
    ).select("*", _share(F.col("n_issues"), F.col("n_rows")).alias("pct_issues"))


def change_counts(changed: DataFrame, counter: str) -> DataFrame:
    """Sum of a per-row change counter or flag."""
    return changed.agg(F.count("*").alias("n_rows"), F.sum(F.col(counter).cast("long")).alias("n_changed"))


def highest_page(articles: DataFrame) -> DataFrame:
    return articles.agg(F.coalesce(F.max(F.coalesce("page", F.lit(0))), F.lit(0)).alias("max_page"))


def key_union(maps: DataFrame, column: str) -> DataFrame:
    """All keys that occur in a map column, sorted: the header of a ragged table."""
    keys = maps.select(F.explode(F.map_keys(column)).alias("key")).distinct()
    return keys.orderBy("key")


def progress(counts: DataFrame, elapsed_seconds: Column, target: int = fv.TARGET_ARTICLES) -> DataFrame:
    """Progress of both phases from ``n_listing``, ``n_articles`` and the time taken.

    Phase one aims at ``target``; phase two at whatever phase one has found.  Rate and
    remaining time need at least one article and one second.
    """
    rate = F.when(
        (F.col("n_articles") > 0) & (F.col("n_listing") > 0) & (elapsed_seconds > 0),
        F.col("n_articles") / elapsed_seconds,
    )
    eta = F.floor((F.col("n_listing") - F.col("n_articles")) / rate)
    return counts.select(
        "*",
        elapsed_seconds.cast("long").alias("elapsed_s"),
        _share(F.col("n_listing"), F.lit(target)).alias("pct_listing"),
        _share(F.col("n_articles"), F.nullif(F.col("n_listing"), F.lit(0))).alias("pct_articles"),
        rate.alias("rate_per_s"),
        eta.alias("eta_s"),
    ).withColumn(
        "eta",
        F.format_string(
            "%02d:%02d:%02d",
            F.floor(F.col("eta_s") / 3600),
            F.floor(F.col("eta_s") / 60) % 60,
            F.col("eta_s") % 60,
        ),
    ).withColumn("eta", F.when(F.col("eta_s").isNotNull(), F.col("eta")))
