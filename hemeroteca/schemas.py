"""Record types of the corpus as explicit Spark schemas."""

from __future__ import annotations

from pyspark.sql import types as T


def _strings(*names: str) -> list[T.StructField]:
    return [T.StructField(n, T.StringType()) for n in names]


_SCRAPED_AT = T.StructField("scraped_at", T.TimestampNTZType())

#: A search-result row.
LISTING = T.StructType(
    _strings("title", "url", "description", "date", "search_query")
    + [T.StructField("page", T.IntegerType()), _SCRAPED_AT]
)

#: A search-result row of the form that carries a section label instead of a page.
LISTING_SECTION = T.StructType(_strings("url", "title", "description", "date", "section"))

#: Article records, in three growing forms.
ARTICLE_V1 = T.StructType(_strings("url", "title", "author", "date", "body") + [_SCRAPED_AT])
_LENGTHS = [
    T.StructField("body_length", T.IntegerType()),
    T.StructField("paragraphs_count", T.IntegerType()),
]
ARTICLE_V2 = T.StructType(ARTICLE_V1.fields[:-1] + _LENGTHS + [_SCRAPED_AT])
ARTICLE_V3 = T.StructType(
    ARTICLE_V1.fields[:-1] + _strings("description", "section") + _LENGTHS + [_SCRAPED_AT]
)

#: Progress checkpoints: a whole harvest so far, and where it stopped.
CHECKPOINT_LISTING = T.StructType(
    [
        T.StructField("page", T.IntegerType()),
        T.StructField("articles", T.ArrayType(LISTING)),
        T.StructField("timestamp", T.TimestampNTZType()),
        T.StructField("total", T.IntegerType()),
    ]
)
CHECKPOINT_BODIES = T.StructType(
    [
        T.StructField("articles", T.ArrayType(ARTICLE_V3)),
        T.StructField("last_index", T.IntegerType()),
        T.StructField("timestamp", T.TimestampNTZType()),
        T.StructField("total_processed", T.IntegerType()),
    ]
)

#: One row of the glued-word report.
ISSUE = T.StructType(
    [
        T.StructField("index", T.LongType()),
        *_strings("title", "url"),
        T.StructField("merged_words", T.ArrayType(T.StringType())),
    ]
)

#: Fetched HTML.
PAGE = T.StructType([T.StructField("page_id", T.LongType()), *_strings("url", "html")])
