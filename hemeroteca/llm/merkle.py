"""Document fingerprints: a Merkle tree over sections, paragraphs and runs of words.

A paragraph is a line; its leaves are runs of a few words, so that an edit inside a long paragraph stays local.
A section ends after a paragraph whose hash says so, so a paragraph put in shifts no later section. Every hash is
the SHA-256 of the hashes below it. Equal roots mean equal texts; where roots differ, the branches that differ
show where.

The fingerprint spells the tree out: the root, then ``;`` before each section, ``,`` before each paragraph and
``-`` before each leaf, these three cut to eight digits.
"""

from __future__ import annotations

from math import isqrt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hemeroteca.llm.batches import fresh

LEAF_WORDS = 8
#: One paragraph in so many ends a section.
SECTION_PARAGRAPHS = 4
DIGITS = 8
LEAF = f"(?: *[^ ]++){{1,{LEAF_WORDS}}}+ *+| ++"


def _digest(text: Column) -> Column:
    return F.sha2(text, 256)


def _once(value: Column, use) -> Column:
    """``use(value)`` with the value computed once; inside a lambda Spark doesn't share common parts."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _paragraph(line: Column) -> Column:
    return _once(F.transform(F.regexp_extract_all(line, F.lit(LEAF), F.lit(0)), _digest), _told)


def _told(leaves: Column) -> Column:
    return F.struct(
        _digest(F.concat(F.lit("p"), F.array_join(leaves, ""))).alias("hash"),
        F.array_join(F.transform(leaves, lambda h: F.concat(F.lit("-"), F.left(h, F.lit(DIGITS)))), "").alias("leaves"),
    )


def _branch(mark: str, digest: Column) -> Column:
    return F.concat(F.lit(mark), F.left(digest, F.lit(DIGITS)))


def fingerprint(text: Column) -> Column:
    """The fingerprint of a text; null counts as empty. Equal texts, and only they, have equal ones."""
    paragraphs = F.transform(F.split(F.coalesce(text, F.lit("")), "\n", -1), _paragraph)

    def close(state: Column) -> Column:
        digest = _digest(F.concat(F.lit("s"), state["hashes"]))
        return F.struct(
            F.concat(state["done"], digest).alias("done"),
            F.concat(state["told"], _branch(";", digest), state["branches"]).alias("told"),
            F.lit("").alias("hashes"),
            F.lit("").alias("branches"),
        )

    def add(state: Column, own: Column) -> Column:
        grown = F.struct(
            state["done"].alias("done"),
            state["told"].alias("told"),
            F.concat(state["hashes"], own["hash"]).alias("hashes"),
            F.concat(state["branches"], _branch(",", own["hash"]), own["leaves"]).alias("branches"),
        )
        ends = F.conv(F.left(own["hash"], F.lit(4)), 16, 10).cast("int") % SECTION_PARAGRAPHS == 0
        return F.when(ends, close(grown)).otherwise(grown)

    start = F.struct(*[F.lit("").alias(name) for name in ("done", "told", "hashes", "branches")])

    def finish(state: Column) -> Column:
        whole = F.when(state["hashes"] == "", state).otherwise(close(state))
        return F.concat(_digest(whole["done"]), whole["told"])

    return F.aggregate(paragraphs, start, add, finish)


def leaves(fingerprint: Column) -> Column:
    return F.regexp_extract_all(fingerprint, F.lit(f"-([0-9a-f]{{{DIGITS}}})"), F.lit(1))


def root(fingerprint: Column) -> Column:
    return F.left(fingerprint, F.lit(64))


def likeness(one: Column, other: Column) -> Column:
    """1 for equal roots, else the share of different leaves that both trees have (Dice), 0 where there are none."""
    a, b = F.array_distinct(leaves(one)), F.array_distinct(leaves(other))
    both, total = F.size(F.array_intersect(a, b)), F.size(a) + F.size(b)
    return F.when(root(one) == root(other), 1.0).when(total == 0, 0.0).otherwise(2.0 * both / total)


def differing_paragraphs(one: Column, other: Column) -> Column:
    """Numbers, from 0, of the paragraphs of ``one`` that ``other`` doesn't have."""

    def listed(whole: Column) -> Column:
        return F.regexp_extract_all(whole, F.lit(f",[0-9a-f]{{{DIGITS}}}[-0-9a-f]*"), F.lit(0))

    numbered = F.transform(listed(one), lambda p, i: F.struct(i.alias("i"), p.alias("p")))
    theirs = listed(other)
    return F.transform(F.filter(numbered, lambda x: ~F.array_contains(theirs, x["p"])), lambda x: x["i"])


def with_next(rows: DataFrame, key: str, columns: list[str], parts: int) -> DataFrame:
    """Add ``next_<column>`` of the row with the next larger key; after the last row comes the first.

    The key must be a number. Null keys come first; rows of one key follow each other in the order of ``columns``.
    Rows go to ``parts`` ranges of the key with bounds that are keys of the table, and the first row of each range
    goes to the range before it too, so each range finds its rows' followers alone.
    """
    shares = [n / parts for n in range(1, parts)]
    found = rows.agg(F.percentile_approx(key, shares, 10_000).alias("bounds"), F.min(key).alias("least"), F.max(F.col(key).isNull()).alias("nulls")).first()
    bounds = sorted(set(found["bounds"] or []))
    width = isqrt(len(bounds)) + 1
    groups = [bounds[i : i + width] for i in range(0, len(bounds), width)] or [[]]
    value = F.col(key)

    def array(items: list) -> Column:
        return F.array(*map(F.lit, items)).cast("array<bigint>")

    group, coarse = fresh(rows, "group"), array([g[0] for g in groups[1:]])
    placed = rows.withColumn(group, F.size(F.filter(coarse, lambda b: b <= value)))
    own = F.get(F.array(*map(array, groups)), F.col(group))
    below = F.size(F.filter(own, lambda b: b <= value))
    part = F.col(group) * width + below
    is_bound = F.get(own, below - 1) == value
    is_first = value.isNull() if found["nulls"] else value == F.lit(found["least"])

    def copy(part: Column, ghost: int, wrapped: int) -> Column:
        return F.struct(part.cast("int").alias("part"), F.lit(ghost).alias("ghost"), F.lit(wrapped).alias("wrapped"))

    none = F.array().cast("array<struct<part:int,ghost:int,wrapped:int>>")
    copies = F.concat(
        F.array(copy(part, 0, 0)),
        F.when(is_bound, F.array(copy(part - 1, 1, 0))).otherwise(none),
        F.when(is_first, F.array(copy(F.lit(len(bounds)), 1, 1))).otherwise(none),
    )
    at = fresh(rows, "at")
    dealt = placed.withColumn(at, F.explode(copies)).drop(group)
    order = Window.partitionBy(f"{at}.part").orderBy(F.col(f"{at}.wrapped"), F.col(key).asc_nulls_first(), *columns)
    led = {f"next_{c}": F.lead(c).over(order) for c in columns}
    return dealt.withColumns(led).where(F.col(f"{at}.ghost") == 0).drop(at)


def compare_with_edit(docs: DataFrame, parts: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprint each document and its edited text, whose second half gives way to the next document's start.

    Columns: the key, ``n_chars``, ``edited_text``, ``fingerprint``, ``edited_fingerprint``, ``near_edited`` and
    ``near_next``. A null text is an empty one. A single document is its own next one. Repeated rows come back
    each, with each other as next ones. Other columns are left out; an empty table gives no rows.
    """
    own = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    rows = with_next(own.withColumn("fingerprint", fingerprint(F.col("text"))), "key", ["text", "fingerprint"], parts)
    half = F.floor(F.col("n_chars") / 2).cast("int")
    kept = (F.col("n_chars") - half).cast("int")
    edited = F.concat(F.substr("text", F.lit(1), kept), F.substr("next_text", F.lit(1), half))
    made = rows.withColumn("n_chars", F.length("text").cast("long")).withColumn("edited_text", edited)
    return made.withColumn("edited_fingerprint", fingerprint(F.col("edited_text"))).select(
        F.col("key").alias(key),
        "n_chars",
        "edited_text",
        "fingerprint",
        "edited_fingerprint",
        likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
        likeness(F.col("fingerprint"), F.col("next_fingerprint")).alias("near_next"),
    )
