"""Text repair, cleaning profiles and glued-word reports, over whole documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from hemeroteca.functions import fixed_values as fv
from hemeroteca.functions import text as tx
from hemeroteca.operators import cleaning, quality
from hemeroteca.plans import inputs, workflows
from hemeroteca.plans.catalog.registry import (
    SUSPECTS_SQL,
    articles_sql,
    decoded_sql,
    query,
    replaced_sql,
    squeeze_sql,
    unglue_sql,
)
from hemeroteca.session import bound_batches

_GLUED = inputs.GLUED_TEXT.format(t="text")
_BAD = inputs.MOJIBAKE_TEXT.format(t="text")
_ENTITIES = inputs.ENTITY_TEXT.format(t="text")
_BOTH = inputs.MOJIBAKE_TEXT.format(t=inputs.ENTITY_TEXT.format(t=_GLUED))
_REPAIR_PAIRS = sorted(tx.REPAIR_TABLE.items(), key=lambda kv: -len(kv[0]))


def _over_documents(spark, sf, damage: str, name: str, fix):
    bound_batches(spark)
    return inputs.documents(spark, sf).select("doc_id", fix(F.expr(damage)).alias(name))


@query(f"SELECT doc_id, {replaced_sql(_BAD, fv.MOJIBAKE['A'])} AS fixed FROM documents")
def mojibake_a(spark, sf):
    return _over_documents(spark, sf, _BAD, "fixed", lambda c: tx.fix_mojibake(c, "A"))


@query(f"SELECT doc_id, {replaced_sql(_BAD, fv.MOJIBAKE['B'])} AS fixed FROM documents")
def mojibake_b(spark, sf):
    return _over_documents(spark, sf, _BAD, "fixed", lambda c: tx.fix_mojibake(c, "B"))


@query(f"SELECT doc_id, {replaced_sql(_BAD, _REPAIR_PAIRS)} AS fixed FROM documents")
def mojibake_repair(spark, sf):
    return _over_documents(spark, sf, _BAD, "fixed", lambda c: tx.fix_mojibake(c, "repair"))


@query(f"SELECT doc_id, {decoded_sql(_ENTITIES)} AS decoded FROM documents")
def entities(spark, sf):
    return _over_documents(spark, sf, _ENTITIES, "decoded", tx.decode_entities)


@query(f"SELECT doc_id, nfc_normalize({_ENTITIES}) AS composed FROM documents")
def composed_form(spark, sf):
    return _over_documents(spark, sf, _ENTITIES, "composed", tx.compose)


@query(f"SELECT doc_id, {squeeze_sql('text')} AS squeezed FROM documents")
def squeezed_space(spark, sf):
    return _over_documents(spark, sf, "text", "squeezed", tx.squeeze)


@query("SELECT doc_id, lower(text) AS lowered, upper(lang) AS lang FROM documents")
def letter_case(spark, sf):
    return inputs.documents(spark, sf).select("doc_id", F.lower("text").alias("lowered"), F.upper("lang").alias("lang"))


@query(f"SELECT doc_id, {unglue_sql(_GLUED, 'aggressive')} AS split FROM documents")
def unglue_aggressive(spark, sf):
    return _over_documents(spark, sf, _GLUED, "split", lambda c: tx.unglue(c, "aggressive"))


@query(f"SELECT doc_id, {unglue_sql(_GLUED, 'conservative')} AS split FROM documents")
def unglue_conservative(spark, sf):
    return _over_documents(spark, sf, _GLUED, "split", lambda c: tx.unglue(c, "conservative"))


@query(f"SELECT doc_id, {unglue_sql(_GLUED, 'final')} AS split FROM documents")
def unglue_final(spark, sf):
    return _over_documents(spark, sf, _GLUED, "split", lambda c: tx.unglue(c, "final"))


@query(
    f"""SELECT idx AS index, left(title, 80) AS title, url, array_to_string(s[1:5], '|') AS merged_words
    FROM (SELECT *, {SUSPECTS_SQL} AS s FROM {articles_sql()}) WHERE len(s) > 0"""
)
def glued_report(spark, sf):
    report = quality.glued_report(inputs.articles(spark, sf))
    return report.withColumn("merged_words", F.array_join("merged_words", "|"))


@query(
    f"""SELECT count(*) AS n_rows, count(*) FILTER (len(s) > 0) AS n_issues,
    CAST(count(*) FILTER (len(s) > 0) AS DOUBLE) * 100 / count(*) AS pct_issues
    FROM (SELECT {SUSPECTS_SQL} AS s FROM {articles_sql()})"""
)
def issue_rate(spark, sf):
    return quality.issue_rate(inputs.articles(spark, sf))


# --- whole records ----------------------------------------------------------------------------


def _final_sql(x: str) -> str:
    decoded = decoded_sql(replaced_sql(x, fv.MOJIBAKE["B"]))
    return unglue_sql(squeeze_sql(f"nfc_normalize({decoded})"), "final")


def _conservative_sql(x: str) -> str:
    return unglue_sql(decoded_sql(replaced_sql(x, fv.MOJIBAKE["A"])), "conservative")


def _cleaned_sql(clean, source: str, where: str = "") -> str:
    fields = ", ".join(f"{clean(c)} AS {c}" for c in fv.CLEANED_FIELDS)
    others = ", ".join(c for c in inputs.ARTICLE_COLUMNS if c not in fv.CLEANED_FIELDS)
    return f"SELECT {others}, {fields} FROM {source} {where}"


_DAMAGED = articles_sql(inputs.MOJIBAKE_TEXT.format(t=inputs.ENTITY_TEXT.format(t=inputs.GLUED_TEXT)))
_CORE = "WHERE split_part(url, '/', 4) IN ('economia', 'politica')"


def _damaged(spark, sf):
    return inputs.articles(
        spark, sf, inputs.MOJIBAKE_TEXT.format(t=inputs.ENTITY_TEXT.format(t=inputs.GLUED_TEXT))
    )


@query(_cleaned_sql(_final_sql, _DAMAGED))
def clean_final(spark, sf):
    return cleaning.clean_articles(_damaged(spark, sf), "final")


@query(_cleaned_sql(_conservative_sql, _DAMAGED))
def clean_conservative(spark, sf):
    return cleaning.clean_articles(_damaged(spark, sf), "conservative")


@query(
    f"""SELECT idx, {unglue_sql('title', 'aggressive')} AS title, {unglue_sql('body', 'aggressive')} AS body,
    CAST({unglue_sql('title', 'aggressive')} <> title AS INT) + CAST({unglue_sql('body', 'aggressive')} <> body AS INT) AS n_fixed
    FROM {articles_sql()}"""
)
def unglue_articles(spark, sf):
    return cleaning.unglue_articles(inputs.articles(spark, sf).select("idx", "title", "body"))


@query(
    f"""SELECT count(*) AS n_rows, CAST(sum(CAST({unglue_sql('title', 'aggressive')} <> title AS INT)
    + CAST({unglue_sql('body', 'aggressive')} <> body AS INT)) AS BIGINT) AS n_changed FROM {articles_sql()}"""
)
def unglue_change_count(spark, sf):
    fixed = cleaning.unglue_articles(inputs.articles(spark, sf).select("title", "body"))
    return quality.change_counts(fixed, "n_fixed")


@query(_cleaned_sql(_final_sql, _DAMAGED, _CORE))
def clean_and_report_articles(spark, sf):
    return workflows.clean_and_report(_damaged(spark, sf))["articles"]


@query(
    f"""SELECT coalesce(section, split_part(url, '/', 4)) AS section, count(*) AS n, min(idx) AS first_idx,
    CAST(count(*) AS DOUBLE) * 100 / sum(count(*)) OVER () AS pct FROM {_DAMAGED} {_CORE} GROUP BY 1"""
)
def clean_and_report_sections(spark, sf):
    return workflows.clean_and_report(_damaged(spark, sf))["sections"]


@query(
    f"""SELECT left(date, 4) AS year, count(*) AS n FROM {_DAMAGED} {_CORE} AND regexp_full_match(left(date, 4), '[0-9]+')
    GROUP BY 1"""
)
def clean_and_report_years(spark, sf):
    return workflows.clean_and_report(_damaged(spark, sf))["years"]
