"""A bounded sample of labelled documents, for fitting."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


#: Lines of a text in the sample at most, as some features are held by line.
MOST_LINES = 1_000


def labelled_texts(docs: DataFrame, labels: DataFrame, label: str, rows: int, longest: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(text, label) of at most ``rows`` labelled documents of at most ``longest`` characters and ``MOST_LINES`` lines.

    The first ones by a hash of the key, so the choice is the same at each call. Only the chosen keys, a bounded
    number, are sent to the documents. Other columns, whatever their names, are left out.
    """
    marked = labels.select(F.col(key).alias("own"), F.col(label).alias("label")).where("label is not null and own is not null")
    chosen = marked.orderBy(F.xxhash64("own"), "own", "label").limit(rows)
    texts = docs.select(F.col(key).alias("doc"), F.col(text).alias("text"))
    found = texts.join(F.broadcast(chosen), F.col("doc") == F.col("own"))
    lines = F.length("text") - F.length(F.translate("text", "\n", "")) + 1
    return found.where((F.length("text") <= longest) & (lines <= MOST_LINES)).select("text", F.col("label").cast("int").alias("label"))
