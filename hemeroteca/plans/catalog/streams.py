"""Streaming queries, worked off to the end and read back as tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from hemeroteca.plans import inputs
from hemeroteca.plans.catalog import page_checks as check
from hemeroteca.plans.catalog.registry import LISTING_SQL, query
from hemeroteca.session import scratch_path
from hemeroteca.sources import writers
from hemeroteca.sources.readers import stream_folder
from hemeroteca.streaming import harvest, poll


def _stream(spark, sf, name):
    """The given table as a file stream; the pattern matches one file or a folder of files."""
    path = f"{sf}/{name}.parque[t]"
    return stream_folder(spark, path, inputs.table(spark, sf, name).schema, maxFilesPerTrigger=1000)


def _listing_stream(spark, sf):
    return _stream(spark, sf, "documents").select(
        F.col("doc_id").alias("idx"),
        F.expr(inputs.article_url(f"({inputs.LISTING_KEY})")).alias("url"),
        F.expr(inputs.ARTICLE_COLUMNS["page"]).alias("page"),
    )


@query(
    f"""SELECT *, CAST(n_listing AS DOUBLE) * 100 / 2000 AS pct_listing, CAST(n_articles AS DOUBLE) / elapsed_s AS rate_per_s,
    CAST(floor((n_listing - n_articles) / (CAST(n_articles AS DOUBLE) / elapsed_s)) AS BIGINT) AS eta_s FROM (
    SELECT (SELECT count(*) FROM orders) AS n_listing, (SELECT count(*) FROM documents) AS n_articles,
    (SELECT max(o_orderkey % 105 + 1)::INT FROM orders) AS max_page, CAST(1500 AS BIGINT) AS elapsed_s, 1 AS tick)"""
)
def stream_progress(spark, sf):
    """All orders are listed, and the documents are the articles so far: there is time left.

    Listing rows come in two parts, with a restart between them: ticks at 1,000 and 1,500 seconds.
    """
    listed = inputs.order_urls(spark, sf).select("idx", F.expr("cast(idx % 105 + 1 as int)").alias("page"))
    return _progress(spark, listed, _stream(spark, sf, "documents"))


def _progress(spark, rows, articles):
    folder, out, state = (scratch_path(spark, f"progress-{k}") for k in ("in", "out", "state"))
    for part, moments in enumerate(((0, 1000), (1500,))):
        rows.where(F.col("idx") % 2 == part).write.mode("append").parquet(folder)
        listing = stream_folder(spark, folder, rows.schema, maxFilesPerTrigger=1000)
        clock = iter(moments).__next__
        harvest.run_to_end(harvest.watch_progress(listing, articles, out, state, every=None, clock=clock))
    return harvest.latest_progress(spark, out).select(
        "n_listing", "n_articles", "max_page", "elapsed_s", "tick", "pct_listing", "rate_per_s", "eta_s"
    )


@query(
    f"""SELECT *, CAST(n_listing AS DOUBLE) * 100 / 2000 AS pct_listing, CAST(n_articles AS DOUBLE) / elapsed_s AS rate_per_s,
    CAST(floor((n_listing - n_articles) / (CAST(n_articles AS DOUBLE) / elapsed_s)) AS BIGINT) AS eta_s FROM (
    SELECT (SELECT count(*) FROM {LISTING_SQL}) AS n_listing, (SELECT count(*) FROM orders) AS n_articles,
    (SELECT max(page) FROM {LISTING_SQL}) AS max_page, CAST(1500 AS BIGINT) AS elapsed_s, 1 AS tick)"""
)
def stream_progress_whole(spark, sf):
    """As ``stream_progress``, the other way round: more articles than are listed, so the time left is below zero."""
    return _progress(spark, inputs.listing(spark, sf).select("idx", "page"), _stream(spark, sf, "orders"))


@query(f"""SELECT idx, url, page, pos FROM {LISTING_SQL} QUALIFY row_number() OVER (PARTITION BY url ORDER BY page, pos) = 1""")
def stream_first_seen(spark, sf):
    """Whole rows, from several files and triggers, stopped and started again between them."""
    folder, out, state = (scratch_path(spark, f"seen-{k}") for k in ("in", "out", "state"))
    rows = inputs.listing(spark, sf).select("idx", "url", "page", "pos")
    for part in range(2):
        rows.where(F.col("idx") % 2 == part).repartition(2, "idx").write.mode("append").parquet(folder)
        arriving = stream_folder(spark, folder, rows.schema, maxFilesPerTrigger=1)
        harvest.run_to_end(harvest.first_seen_batches(arriving, out, state, every=None))
    return harvest.settled(spark, out)


@query(f"""SELECT idx, url, page, pos FROM {LISTING_SQL} QUALIFY row_number() OVER (PARTITION BY url ORDER BY page, pos) = 1""")
def stream_first_rows(spark, sf):
    """As ``stream_first_seen``, with each URL's place in state: later files hold rows that come before stored ones."""
    folder, out, state = (scratch_path(spark, f"first-{k}") for k in ("in", "out", "state"))
    rows = inputs.listing(spark, sf).select("idx", "url", "page", "pos", F.timestamp_seconds(F.col("idx") + 1).alias("scraped_at"))
    for part in (1, 0):
        rows.where(F.col("idx") % 2 == part).repartition(2, "idx").write.mode("append").parquet(folder)
        arriving = stream_folder(spark, folder, rows.schema)
        harvest.run_to_end(harvest.first_row_stream(arriving, out, state, every=None, horizon_days=3650))
    return harvest.first_rows(spark, out).drop("scraped_at")


@query(
    """SELECT * FROM (VALUES (0, NULL, 'waiting', NULL), (1, 'cut.json', 'growing', NULL), (1, 'late.json', 'growing', NULL),
    (2, 'cut.json', 'half written', NULL), (2, 'late.json', 'growing', NULL), (3, 'cut.json', 'taken', NULL)) AS t(tick, file, state, n)
    UNION ALL SELECT 3, 'late.json', 'read', count(*) FROM documents
    UNION ALL SELECT 100, lang, 'record', doc_id FROM documents"""
)
def guarded_poll(spark, sf):
    """A folder that isn't there yet, then a file cut short for good, and one that is half written, then whole."""
    folder, out = scratch_path(spark, "polled"), scratch_path(spark, "poll")
    rows = inputs.table(spark, sf, "documents").select("doc_id", "lang")
    whole = scratch_path(spark, "whole")
    writers.write_json_array(rows, whole, "doc_id")
    text = spark.read.text(whole, wholetext=True)
    poll.look(spark, folder, rows.schema, out, 0)
    for name, part in (("cut", "left(value, length(value) - 2)"), ("late", "left(value, cast(length(value) / 2 as int))")):
        writers.write_one_file(text.select(F.expr(part).alias("value")), f"{folder}/{name}.json")
    poll.look(spark, folder, rows.schema, out, 1)
    writers.write_one_file(text, f"{folder}/late.json")
    for tick in (2, 3):
        poll.look(spark, folder, rows.schema, out, tick)
    name = F.substring_index("file", "/", -1).alias("file")
    states = poll.states(spark, out).select(F.col("tick").cast("int").alias("tick"), name, "state", "n")
    found = poll.records(spark, out, rows.schema)
    return states.union(found.select(F.lit(100), "lang", F.lit("record"), "doc_id"))


@query("SELECT DISTINCT user_id AS url FROM events")
def stream_first_seen_within_horizon(spark, sf):
    """Event keys within a watermark horizon that spans the table."""
    out, state = scratch_path(spark, "horizon"), scratch_path(spark, "horizon-state")
    events = _stream(spark, sf, "events").select(F.col("user_id").alias("url"), F.col("ts").cast("timestamp").alias("scraped_at"))
    rows = harvest.first_seen_stream(events, "3650 days").select("url")
    harvest.run_to_end(harvest.append_stream(rows, out, state, every=None))
    return harvest.latest(spark, out)


@query(check.article_v2)
def stream_extract(spark, sf):
    out, state = scratch_path(spark, "extracted"), scratch_path(spark, "extracted-state")
    pages = _stream(spark, sf, "pages").select(
        F.expr(inputs.ARTICLE_PAGE_URL).alias("url"), F.expr(inputs.ARTICLE_PAGE_HTML).alias("html")
    )
    harvest.run_to_end(harvest.append_stream(harvest.extract_stream(pages), out, state, every=None))
    return harvest.latest(spark, out).drop("scraped_at")


@query(f"SELECT idx, url, page FROM {LISTING_SQL}")
def stream_snapshots(spark, sf):
    out, state = scratch_path(spark, "ticks"), scratch_path(spark, "ticks-state")
    harvest.run_to_end(harvest.snapshot_stream(_listing_stream(spark, sf), out, state, every=None))
    return harvest.latest(spark, out).drop("batch_id")


@query(f"SELECT DISTINCT url FROM {LISTING_SQL}")
def stream_resumed(spark, sf):
    """Started twice over one checkpoint: the second run finds nothing left to add. State goes behind the horizon."""
    out, state = scratch_path(spark, "resumed"), scratch_path(spark, "resumed-state")
    for _ in range(2):
        arriving = _listing_stream(spark, sf).select("url", F.timestamp_seconds(F.col("idx") + 1).alias("scraped_at"))
        rows = harvest.first_seen_stream(arriving, "3650 days").select("url")
        harvest.run_to_end(harvest.append_stream(rows, out, state, every=None))
    return harvest.latest(spark, out)

