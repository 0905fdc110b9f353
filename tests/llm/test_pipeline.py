"""The pipeline, stage by stage, and the registered queries against their check SQL."""

import pytest
from compare import connect, difference

import corpus_pipeline
from __spark_entry__ import oracle_sql, queries
from hemeroteca.llm import queries as llm
from hemeroteca.sources.writers import materialise


def test_stages_feed_each_other(spark, sf):
    docs = first = llm.table(spark, sf, "documents")
    counts = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf), name.replace(" ", "-"))
        assert docs.columns == first.columns and docs.dtypes == first.dtypes
        assert docs.where("n_chars != length(text)").isEmpty()
        counts.append(docs.count())
    assert counts[0] == counts[1] > counts[2] == counts[3]
    pieces = corpus_pipeline.run(spark, sf)
    assert pieces.select("doc_id").distinct().count() == counts[-1]
    assert sorted(map(tuple, pieces.selectExpr("doc_id", "start", "length").collect())) == sorted(
        map(tuple, corpus_pipeline.pack(spark, docs, sf).selectExpr("doc_id", "start", "length").collect())
    ) or pieces.selectExpr("sum(length)").first() == corpus_pipeline.pack(spark, docs, sf).selectExpr("sum(length)").first()


def test_stages_take_odd_tables(spark, sf):
    base = llm.table(spark, sf, "documents").limit(3).selectExpr("*", "'x' AS kept", "1 AS node", "2 AS ids")
    docs = base.union(base).union(base.selectExpr("*").withColumn("text", base.text.substr(0, 0))).union(
        base.selectExpr("cast(null as bigint) doc_id", "cast(null as string) text", "cast(null as string) lang",
                        "cast(null as string) source", "cast(null as int) n_chars", "kept", "node", "ids")
    )
    for table in (docs, docs.limit(0)):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, table, sf)
            assert out.columns == table.columns
            assert out.count() <= table.count()
        corpus_pipeline.pack(spark, table, sf).collect()


def test_all_are_registered():
    numbered = {int(name[2:].split("_")[0]) for name in queries() if name.startswith("op") and name[2].isdigit()}
    assert numbered == set(range(1, 14)) and "pipeline" in queries()


@pytest.mark.parametrize("name", sorted(llm.ORACLES))
def test_query_equals_its_check(spark, sf, name):
    assert difference(spark, connect(sf), queries()[name], oracle_sql()[name], sf) is None
