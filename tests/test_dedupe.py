"""First-seen, duplicates and numbering against brute force, with hot keys; and their plans."""

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from hemeroteca.operators import dedupe


def crawl(n=3000, seed=1):
    """(idx, url, page, pos, title): a third of the rows share one URL, some URLs are NULL."""
    rng = random.Random(seed)
    out = []
    for i in range(n):
        url = "hot" if rng.random() < 0.34 else rng.choice([None, *[f"u{k}" for k in range(400)]])
        out.append((i, url, rng.randint(1, 30), i, f"t{rng.randint(0, 900)}"))
    rng.shuffle(out)
    return out


SCHEMA = "idx long, url string, page int, pos int, title string"


@pytest.fixture(scope="module")
def rows(spark):
    return spark.createDataFrame(crawl(), SCHEMA).repartition(8)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_first_seen(rows):
    best = {}
    for r in crawl():
        if r[1] not in best or (r[2], r[3]) < (best[r[1]][2], best[r[1]][3]):
            best[r[1]] = r
    once = dedupe.first_seen(rows)
    assert sorted(map(tuple, once.collect()), key=str) == sorted(best.values(), key=str)
    assert dedupe.first_seen(once).count() == once.count()


def test_first_seen_keeps_one_row_per_key_before_the_shuffle(rows):
    text = plan(dedupe.first_seen(rows))
    partial, shuffle = text.index("row_number(), 1, Partial"), text.index("Exchange")
    assert partial > shuffle, "the partial limit must sit below the exchange"


def test_duplicates_and_their_numbers(rows):
    groups = defaultdict(list)
    for r in sorted(crawl()):
        groups[r[1]].append(r[0])
    want = {
        (url, idx, len(ids), k)
        for url, ids in groups.items()
        if len(ids) > 1
        for k, idx in enumerate(ids, 1)
    }
    got = dedupe.duplicate_rows(rows, block_rows=64)
    assert {(r.url, r.idx, r.n, r.number) for r in got.collect()} == want
    counts = {r.url: r.n for r in dedupe.duplicate_groups(rows).collect()}
    assert counts == {u: len(ids) for u, ids in groups.items() if len(ids) > 1}


def test_missing_keys_are_numbered_too(rows):
    groups = defaultdict(int)
    want = set()
    for r in sorted(crawl()):
        groups[r[1]] += 1
        want.add((r[0], groups[r[1]]))
    got = dedupe.number_within(rows, "url", "idx", F.expr("idx div 50"))
    assert {(r.idx, r.number) for r in got.collect()} == want


def test_hot_keys_do_not_meet_in_one_window(rows):
    for df in (
        dedupe.duplicate_rows(rows, block_rows=64),
        dedupe.number_within(rows, "url", "idx", F.expr("idx div 50")),
    ):
        row_windows = [x for x in plan(df).splitlines() if "row_number()" in x]
        assert row_windows and all("_kb" in x for x in row_windows)


def test_backlog_is_what_is_not_done(rows):
    done = rows.where("page <= 10")
    left = dedupe.resume_backlog(rows, done)
    seen = {r[1] for r in crawl() if r[2] <= 10}
    # A missing URL never equals another, so such rows stay in the backlog.
    assert sorted(r.idx for r in left.collect()) == sorted(r[0] for r in crawl() if r[1] is None or r[1] not in seen)


def test_appending_and_union(spark, rows):
    extra = spark.createDataFrame([("new",), ("hot",)], "url string")
    both = dedupe.append_rows(rows, extra)
    assert both.columns == rows.columns and both.count() == rows.count() + 2
    urls = {r.url for r in dedupe.union_seen(rows, extra).collect()}
    assert urls == {r[1] for r in crawl()} | {"new"}


def test_no_cross_joins_or_single_task_windows(spark, sf, monkeypatch):
    """Over the whole catalogue: every plan that is written on the way, streams included, and the one that is returned."""
    from pyspark.sql.readwriter import DataFrameWriter

    from hemeroteca.plans.catalog import QUERIES

    seen = []

    def noted(write):
        def save(self, *args, **options):
            seen.append(plan(self._df))
            return write(self, *args, **options)

        return save

    for way in ("parquet", "json", "csv", "text", "save"):
        monkeypatch.setattr(DataFrameWriter, way, noted(getattr(DataFrameWriter, way)))
    written = 0
    for name, run in QUERIES.items():
        seen.clear()
        seen.append(plan(run(spark, sf)))
        written += len(seen) - 1
        for text in seen:
            for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "windowspecdefinition(specifiedwindowframe"):
                assert bad not in text, (name, bad)
    assert written > 40


def test_finished_keys_are_made_distinct_before_the_shuffle(rows):
    text = plan(dedupe.resume_backlog(rows, rows.where("page <= 10")))
    right = text[text.index("LeftAnti") :]
    assert "partial" in right or "HashAggregate(keys=[url" in right
