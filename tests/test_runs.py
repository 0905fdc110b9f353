"""What runs leave behind, and the cut at a target, against plain Python."""

import random

import pytest
from pyspark.sql import functions as F

from hemeroteca.operators import listing, quality
from hemeroteca.plans import inputs
from hemeroteca.sources import runs


def test_gaps_of_work_that_ended_out_of_order(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "positions")
    n = 70_000  # three bitmaps
    done = {i for i in range(n) if i % 1000 not in (3, 4, 999)} - set(range(40_000, 40_010))
    assert runs.gaps(spark, path, 5).count() == 5
    rows = spark.range(n).withColumnRenamed("id", "idx")
    ended = rows.where("idx % 1000 not in (3, 4, 999) and idx not between 40000 and 40009")
    extra = spark.createDataFrame([(None,), (-1,), (-40_000,)], "idx long")
    runs.note_finished(ended.where("crc32(string(idx)) % 2 = 0").union(extra), path, "a")
    for _ in range(2):  # noted twice
        runs.note_finished(ended.where("crc32(string(idx)) % 2 = 1"), path, "b")
    want = [i for i in range(n) if i not in done]
    assert sorted(r.position for r in runs.gaps(spark, path, n).collect()) == want
    assert sorted(r.position for r in runs.gaps(spark, path, 40_005).collect()) == [i for i in want if i < 40_005]
    left = runs.unfinished_rows(rows.union(extra), path)
    assert sorted((r.idx for r in left.collect()), key=lambda i: (i is not None, i)) == [None, -40_000, -1, *want]
    plan = runs.gaps(spark, path, n)._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan and "Python" not in plan


def test_tallies_count_nothing_twice(spark, sf, tmp_path):
    path = str(tmp_path / "tallies")
    rows = inputs.articles(spark, sf)
    for run in (0, 1, 2, 1, 0):
        runs.add_tallies(rows.where(F.col("idx") % 3 == run), path, f"r{run}")
    runs.add_tallies(rows.where("false"), path, "empty")
    want = {(r.section, r.n, r.first_idx) for r in quality.section_histogram(rows).collect()}
    got = runs.tallied(spark, path, "section").collect()
    assert {(r.key, r.n, r.first_idx) for r in got} == want
    assert [r.n for r in got] == sorted((r.n for r in got), reverse=True)
    assert abs(sum(r.pct for r in got) - 100) < 1e-6
    assert {(r.key, r.n) for r in runs.tallied(spark, path, "year").collect()} == {(r.year, r.n) for r in quality.year_histogram(rows).collect()}
    assert runs.tallied_coverage(spark, path).first() == quality.body_coverage(rows).first()
    exact = quality.corpus_counts(rows).first()
    for r in runs.estimated_distinct(spark, path).collect():
        n = exact.n_urls if r.kind == "distinct url" else exact.n_titles
        assert abs(r.estimate - n) <= runs.SKETCH_BOUND * n


def test_merged_sketches_stay_within_their_bound(spark, tmp_path):
    path = str(tmp_path / "many")
    rows = spark.range(120_000).selectExpr("id AS idx", "concat('https://h/s/', id) AS url", "concat('t', id % 30000) AS title", "'' AS date", "'' AS body")
    for run in range(3):
        runs.add_tallies(rows.where(f"idx % 4 in ({run}, {run + 1})"), path, f"r{run}")
    found = {r.kind: r.estimate for r in runs.estimated_distinct(spark, path).collect()}
    assert abs(found["distinct url"] - 120_000) <= runs.SKETCH_BOUND * 120_000
    assert abs(found["distinct title"] - 30_000) <= runs.SKETCH_BOUND * 30_000


@pytest.mark.parametrize("ranges", [3, 1024])
def test_the_cut_at_a_target(spark, tmp_path, monkeypatch, ranges):
    monkeypatch.setattr(listing, "_RANGES", ranges)
    rnd = random.Random(ranges)
    data = [(rnd.choice([None, 1, 2, 2, 2, 7, 400]), rnd.choice([None, *range(9)]), f"u{i}") for i in range(300)]
    path = str(tmp_path / "rows")
    spark.createDataFrame(data, "page int, pos int, url string").repartition(5).write.parquet(path)
    rows = spark.read.parquet(path)
    order = sorted((-1 if p is None else p, -1 if q is None else q) for p, q, _ in data)
    for n in (0, 1, 2, 37, 150, 299, 300, 301):
        got = listing.take_target(rows, n)
        found = sorted((-1 if r.page is None else r.page, -1 if r.pos is None else r.pos) for r in got.collect())
        assert found == order[:n]
        assert got.columns == rows.columns
    assert listing.take_target(rows.limit(0), 4).count() == 0
    first = sorted(r.url for r in listing.take_target(rows, 150).collect())
    assert first == sorted(r.url for r in listing.take_target(rows.repartition(3), 150).collect())


def test_a_large_target_orders_only_ties(spark, tmp_path):
    path = str(tmp_path / "rows")
    spark.range(20_000).selectExpr("cast(id div 20 as int) page", "cast(id % 20 as int) pos", "id").write.parquet(path)
    got = listing.take_target(spark.read.parquet(path), 10_007)
    assert got.agg(F.max("id"), F.count("*")).first()[:] == (10_006, 10_007)
    text = got._jdf.queryExecution().executedPlan().toString()
    for line in text.splitlines():
        assert "SinglePartition" not in line and "Exchange rangepartitioning" not in line
