"""Streams over several files, restarts, and agreement with the batch answers."""

import datetime

import pytest
from pyspark.sql import functions as F

from hemeroteca.operators import article, dedupe
from hemeroteca.operators.outline import outline
from hemeroteca.sources.readers import stream_folder
from hemeroteca.streaming import harvest

SCHEMA = "url string, page int, scraped_at timestamp"


def drop_file(spark, folder, rows, schema=SCHEMA):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(folder))


def at(minute):
    return datetime.datetime(2025, 1, 1, 0, minute)


@pytest.fixture
def places(tmp_path):
    return {k: str(tmp_path / k) for k in ("listing", "articles", "out", "state")}


def listing_stream(spark, places, files=1):
    schema = spark.createDataFrame([], SCHEMA).schema
    return stream_folder(spark, places["listing"], schema, maxFilesPerTrigger=files)


def test_progress_over_ticks(spark, places):
    drop_file(spark, places["listing"], [(f"u{i}", i % 3 + 1, at(0)) for i in range(40)])
    drop_file(spark, places["listing"], [("v", 9, at(1))])
    drop_file(spark, places["articles"], [(f"u{i}", None, at(2)) for i in range(10)])
    schema = spark.createDataFrame([], SCHEMA).schema
    articles = stream_folder(spark, places["articles"], schema)
    harvest.run_to_end(
        harvest.watch_progress(listing_stream(spark, places), articles, places["out"], places["state"], every=None, target=50)
    )
    (r,) = harvest.latest_progress(spark, places["out"]).collect()
    assert (r.n_listing, r.n_articles, r.max_page, r.pct_listing) == (41, 10, 9, 82.0)
    assert r.tick == 1, "two files of listing rows make two ticks"


@pytest.mark.parametrize("thin", [True, False])
def test_first_seen_across_files_and_restarts(spark, places, thin):
    def run():
        rows = harvest.first_seen_stream(listing_stream(spark, places), thin=thin)
        harvest.run_to_end(harvest.append_stream(rows, places["out"], places["state"], every=None))

    for n in range(3):
        drop_file(spark, places["listing"], [(f"u{i % 4 + n}", n, at(n)) for i in range(30)])
    run()
    drop_file(spark, places["listing"], [("u0", 9, at(9)), ("new", 9, at(9))])
    run()
    urls = [r.url for r in harvest.latest(spark, places["out"]).collect()]
    assert sorted(urls) == sorted([*(f"u{i}" for i in range(6)), "new"])


def test_horizon_forgets_and_the_batch_form_settles(spark, places):
    def run():
        rows = harvest.first_seen_stream(listing_stream(spark, places), "5 minutes")
        harvest.run_to_end(harvest.append_stream(rows, places["out"], places["state"], every=None))

    for rows in ([("a", 1, at(0)), ("a", 1, at(1))], [("b", 2, at(30))], [("c", 3, at(31))], [("a", 4, at(40)), ("b", 4, at(32))]):
        drop_file(spark, places["listing"], rows)
        run()
    got = sorted((r.url, r.page) for r in harvest.latest(spark, places["out"]).collect())
    assert got == [("a", 1), ("a", 4), ("b", 2), ("c", 3)]
    settled = dedupe.first_seen(harvest.latest(spark, places["out"]), "url", ("scraped_at",))
    assert sorted(r.url for r in settled.collect()) == ["a", "b", "c"]


def test_state_on_disk(spark, places):
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    harvest.use_disk_state(spark)
    try:
        drop_file(spark, places["listing"], [("a", 1, at(0)), ("a", 2, at(1)), ("b", 1, at(2))])
        rows = harvest.first_seen_stream(listing_stream(spark, places), thin=False)
        harvest.run_to_end(harvest.append_stream(rows, places["out"], places["state"], every=None))
        assert harvest.latest(spark, places["out"]).count() == 2
    finally:
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", before)


def test_extraction_equals_the_batch_answer(spark, places, sf):
    pages = spark.read.parquet(f"{sf}/pages.parquet").select("url", "html")
    pages.repartition(5).write.parquet(places["listing"])
    arriving = stream_folder(spark, places["listing"], pages.schema, maxFilesPerTrigger=2)
    for form, batch in (("v1", article.article_v1), ("v2", article.article_v2)):
        out = f"{places['out']}-{form}"
        harvest.run_to_end(
            harvest.append_stream(harvest.extract_stream(arriving, form), out, f"{places['state']}-{form}", every=None)
        )
        got = harvest.latest(spark, out).drop("scraped_at")
        want = batch(outline(pages)).drop("scraped_at")
        assert got.count() == pages.count() and got.exceptAll(want).count() == 0


def test_snapshots_per_tick(spark, places):
    for n in range(3):
        drop_file(spark, places["listing"], [(f"u{n}{i}", n, at(n)) for i in range(5)])
    harvest.run_to_end(
        harvest.snapshot_stream(listing_stream(spark, places), places["out"], places["state"], every=None)
    )
    counts = harvest.latest(spark, places["out"]).groupBy("batch_id").agg(F.count("*").alias("n")).collect()
    assert sorted((r.batch_id, r.n) for r in counts) == [(0, 5), (1, 5), (2, 5)]
