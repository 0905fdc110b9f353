"""Counts, reports and record cleaning on small tables with known answers."""

import pytest
from pyspark.sql import functions as F

from hemeroteca.operators import cleaning, quality

ARTICLES = [
    # idx, url, title, date, section, page, body
    (0, "https://h/economia/2024/01/02/a/", "A", "", None, 1, ("ab " * 40)[:100]),
    (1, "https://h/economia/b/", "B", "  ", "", 1, ("ab " * 40)[:101]),
    (2, "https://h/politica/2023/05/06/c/", "A", None, "cultura", 2, ""),
    (3, "https://h/otra/9999/99/99/d/", None, "2022-03-04", None, None, None),
    (4, "https://h", "E", "abcd-ef", None, 7, "presidenteJavier"),
    (5, "https://h/economia/2024/01/02/a/", "F", "2022", None, 2, "sano"),
]
SCHEMA = "idx long, url string, title string, date string, section string, page int, body string"


@pytest.fixture(scope="module")
def articles(spark):
    return spark.createDataFrame(ARTICLES, SCHEMA)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


def by(df, key, value):
    return {r[key]: r[value] for r in df.collect()}


def test_dates_are_filled_only_where_blank(articles):
    filled = cleaning.fill_dates(articles)
    assert by(filled, "idx", "date") == {0: "2024-01-02", 1: "  ", 2: "2023-05-06", 3: "2022-03-04", 4: "abcd-ef", 5: "2022"}
    assert quality.change_counts(filled, "date_filled").first()[:] == (6, 2)
    valid = by(cleaning.with_valid_date(filled), "idx", "date_d")
    assert [str(valid[i]) for i in range(5)] == ["2024-01-02", "None", "2023-05-06", "2022-03-04", "None"]


def test_sections(articles):
    assert [r.idx for r in cleaning.keep_sections(articles).orderBy("idx").collect()] == [0, 1, 2, 5]
    assert [r.idx for r in cleaning.keep_sections(articles, "otra").collect()] == [3]
    keyed = by(cleaning.with_section(articles), "idx", "section_key")
    assert keyed == {0: "economia", 1: "", 2: "cultura", 3: "otra", 4: "unknown", 5: "economia"}


def test_histogram_order_and_share(articles):
    got = [(r.section, r.n, r.first_idx) for r in quality.section_histogram(articles).collect()]
    assert got == [("economia", 3, 0), ("politica", 1, 2), ("otra", 1, 3), ("", 1, 4)]
    assert sum(r.pct for r in quality.section_histogram(articles).collect()) == pytest.approx(100)


def test_years(articles):
    filled = cleaning.fill_dates(articles)
    assert [(r.year, r.n) for r in quality.year_histogram(filled).collect()] == [("2024", 1), ("2023", 1), ("2022", 2)]
    loose = [(r.year, r.n) for r in quality.year_histogram(articles, digits_only=False).collect()]
    assert loose == [("abcd", 1), ("2022", 2), ("  ", 1)]


def test_counts(articles, nothing):
    # The missing title counts as no title, as the distinct count leaves it out.
    assert quality.corpus_counts(articles).first()[:] == (6, 5, 4, 1, 2)
    assert quality.body_coverage(articles).first()[:] == (6, 1, 4)
    assert quality.date_coverage(articles).first()[:3] == (6, 3, 3)
    assert quality.date_coverage(nothing).first()[:] == (0, 0, 0, None, None)
    assert quality.highest_page(articles).first()[0] == 7
    assert quality.highest_page(nothing).first()[0] == 0
    assert [(r.page, r.n) for r in quality.page_counts(articles).collect()] == [(None, 1), (1, 2), (2, 2), (7, 1)]


def test_glued_report(articles, nothing):
    (r,) = quality.glued_report(articles).collect()
    assert (r["index"], r.title, r.url, r.merged_words) == (4, "E", "https://h", ["presidenteJavier"])
    assert quality.issue_rate(articles).first()[:] == (6, 1, pytest.approx(100 / 6))
    assert quality.issue_rate(nothing).first()[:] == (0, 0, None)


def test_report_cuts_title_and_words(spark):
    df = spark.createDataFrame([(0, "t" * 90, "u", "aBc " * 9)], "idx long, title string, url string, body string")
    (r,) = quality.glued_report(df).collect()
    assert len(r.title) == 80 and r.merged_words == ["aBc"] * 5


def test_bodies_are_searched_once(articles):
    text = quality.glued_report(articles)._jdf.queryExecution().executedPlan().toString()
    assert text.count("regexp_extract_all") == 2


def test_previews(articles):
    got = [tuple(r) for r in cleaning.preview_lines(articles, 10).collect()]
    assert got[3] == (3, "OTRA", "Sin título", "https://h/otra/9999/99/99/d/", "2022-03-04", 0)
    assert got[4][1:3] == ("N/A", "E") and got[2][4] == "N/A"


def test_cleaning_records(spark):
    df = spark.createDataFrame(
        [(0, "u", "TÃ­tuloNuevo &amp; bueno", "", None, "uno\n\ndosÂ°  tres", 17)],
        "idx int, url string, title string, description string, author string, body string, body_length int",
    )
    r = cleaning.clean_articles(df).first()
    assert (r.title, r.description, r.author, r.body) == ("Título Nuevo & bueno", "", None, "uno dos° tres")
    assert r.body_length == 17, "lengths go stale unless asked for"
    assert cleaning.clean_articles(df, "final", refresh_length=True).first().body_length == 13
    assert cleaning.clean_articles(df, "conservative").first().title == "Título Nuevo & bueno"
    assert cleaning.clean_articles(df, "repair").first().title == "Título Nuevo & bueno"
    assert cleaning.clean_articles(df).columns == df.columns


def test_change_counter_counts_title_and_body_only(spark):
    df = spark.createDataFrame(
        [("aB", "aB", "aB"), ("a", "b", "aB"), (None, "aB", ""), ("a", None, None)],
        "title string, body string, description string",
    )
    fixed = cleaning.unglue_articles(df)
    assert [r.n_fixed for r in fixed.collect()] == [2, 0, 1, 0]
    assert fixed.columns == ["title", "body", "description", "n_fixed"]
    assert quality.change_counts(fixed, "n_fixed").first()[:] == (4, 3)


@pytest.mark.parametrize(
    "n_listing,n_articles,elapsed,want",
    [
        (1000, 250, 3600 * 30, (50.0, 25.0, "90:00:00")),
        (0, 0, 10, (0.0, None, None)),
        (10, 0, 10, (0.5, 0.0, None)),
        (10, 5, 0, (0.5, 50.0, None)),
    ],
)
def test_progress(spark, n_listing, n_articles, elapsed, want):
    counts = spark.createDataFrame([(n_listing, n_articles)], "n_listing long, n_articles long")
    r = quality.progress(counts, F.lit(elapsed)).first()
    assert (r.pct_listing, r.pct_articles, r.eta) == want


def test_key_union(spark):
    df = spark.sql("select map('b', 1, 'a', 2) m union all select map('c', 3) union all select map()")
    assert [r.key for r in quality.key_union(df.selectExpr("cast(m as map<string,int>) m"), "m").collect()] == ["a", "b", "c"]
