"""The corpus pipeline: quality rules, line dedup, near-dedup, pseudonyms, packing.

Each stage takes the documents that the one before has left, as read back from Parquet.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hemeroteca.llm import line_dedup, line_rules, near, packing, pii
from hemeroteca.llm.batches import split_by_keys
from hemeroteca.llm.queries import PSEUDONYM_KEY, table
from hemeroteca.sources.writers import materialise


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    field = line_rules.fit(docs, table(spark, sf_dir, "labels"))
    return line_rules.judge(docs, field).where("kept").select(docs.columns)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without passages of several lines that stand earlier."""
    left = line_dedup.drop_repeats(docs)
    return left.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate component, the one with the smallest id.

    What goes is listed by id, and a row with a null id stays.
    """
    gone = materialise(near.classes(docs).where("not kept").select("doc_id").distinct(), "gone")
    touched, rest = split_by_keys(docs, "doc_id", gone, "doc_id")
    return touched.join(gone, "doc_id", "left_anti").select(docs.columns).union(rest)


def pseudonyms(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with pseudonyms for personal data."""
    new = pii.pseudonymise(docs, PSEUDONYM_KEY)
    return new.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of 2048 tokens."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), end_id=1, capacity=2048)


STAGES = [
    ("quality rules", quality),
    ("line dedup", lines),
    ("near-dedup", near_duplicates),
    ("pseudonyms", pseudonyms),
    ("packing", pack),
]
#: The fitted field, the pseudonyms and the tokens are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order, over the documents of ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
