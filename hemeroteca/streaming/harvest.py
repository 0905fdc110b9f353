"""Watching, deduping and extracting while files arrive."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from datetime import UTC
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery
from pyspark.sql.types import LongType, StructField, StructType

from hemeroteca.functions import fixed_values as fv
from hemeroteca.operators import article, dedupe, outline, quality
from hemeroteca.sources.readers import exists

#: How long a URL is remembered, by default.
HORIZON = "30 days"
#: Keeps the state of long harvests on executor disks instead of the JVM heap.
STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def use_disk_state(spark: SparkSession) -> None:
    """Set once per session, before the first stateful query starts."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)


def _start(writer, checkpoint: str, every: str | None) -> StreamingQuery:
    """``every`` is a processing interval; None works off what is there and stops."""
    trigger = {"availableNow": True} if every is None else {"processingTime": every}
    return writer.option("checkpointLocation", checkpoint).trigger(**trigger).start()


def phase_counts(listing: DataFrame, articles: DataFrame) -> DataFrame:
    """Running row count and highest page of both growing tables: two rows of state."""
    both = listing.select(F.lit("listing").alias("phase"), F.coalesce("page", F.lit(0)).alias("page")).unionByName(
        articles.select(F.lit("articles").alias("phase"), F.lit(0).alias("page"))
    )
    return both.groupBy("phase").agg(F.count("*").alias("n"), F.max("page").alias("max_page"))


def as_progress(counts: DataFrame, elapsed_seconds, target: int = fv.TARGET_ARTICLES) -> DataFrame:
    """One progress row from the two phase rows."""
    wide = counts.agg(
        F.coalesce(F.sum(F.when(F.col("phase") == "listing", F.col("n"))), F.lit(0)).alias("n_listing"),
        F.coalesce(F.sum(F.when(F.col("phase") == "articles", F.col("n"))), F.lit(0)).alias("n_articles"),
        F.coalesce(F.max("max_page"), F.lit(0)).alias("max_page"),
    )
    return quality.progress(wide, elapsed_seconds, target)


def watch_progress(
    listing: DataFrame,
    articles: DataFrame,
    out: str,
    checkpoint: str,
    every: str | None = "5 seconds",
    target: int = fv.TARGET_ARTICLES,
    clock: Callable[[], float] = time.time,
) -> StreamingQuery:
    """Add a progress row to ``out`` at each tick; ``latest_progress`` reads the newest.

    Elapsed time runs from the first start over this checkpoint, also after a restart, and
    does not wrap at a day.  ``clock`` gives the seconds now.
    """
    spark = listing.sparkSession
    noted = f"{checkpoint.rstrip('/')}-started"
    if not exists(spark, noted):
        spark.range(1).select(F.lit(clock()).cast("double").alias("started")).write.mode("overwrite").parquet(noted)
    started = spark.read.parquet(noted).first()["started"]

    def tick(counts: DataFrame, batch_id: int) -> None:
        elapsed = F.lit(int(clock() - started))
        # A replayed tick replaces its own folder only, so there is always a finished one to read.
        as_progress(counts, elapsed, target).coalesce(1).write.mode("overwrite").parquet(f"{out}/tick={batch_id}")

    writer = phase_counts(listing, articles).writeStream.outputMode("complete").foreachBatch(tick)
    return _start(writer, checkpoint, every)


def _drop_repeats(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        repeated = batch.column(key).to_pandas().duplicated().to_numpy()
        yield batch.filter(pa.array(~repeated))


def first_seen_stream(
    rows: DataFrame, horizon: str | None = HORIZON, event_time: str = "scraped_at", thin: bool = True
) -> DataFrame:
    """One row per URL across all arrivals, any one of a URL's rows; ``first_seen_batches`` keeps the first.

    State lies on executor disks and is dropped behind the horizon's watermark: a repeat
    arriving later passes again, and a row older than the watermark is lost, so choose it
    longer than the harvest's re-listing gap and let the batch ``first_seen`` settle the
    stored table.  Without a horizon (None) every URL ever seen stays in state.

    Streaming dedupe has no map-side half of its own, so a URL that fills a third of a
    batch would meet in one task.  ``thin`` drops repeats within each Arrow batch
    before the shuffle; what is left is exact all the same.
    """
    use_disk_state(rows.sparkSession)
    if horizon is not None:
        rows = rows.withWatermark(event_time, horizon)
    if thin:
        rows = rows.mapInArrow(lambda it: _drop_repeats(it, "url"), rows.schema)
    return rows.dropDuplicates(["url"]) if horizon is None else rows.dropDuplicatesWithinWatermark(["url"])


def first_seen_batches(
    rows: DataFrame, out: str, checkpoint: str, every: str | None = "5 seconds", order: tuple[str, ...] = ("page", "pos")
) -> StreamingQuery:
    """Store each micro-batch's first row per URL; ``settled`` reads the first one over all of them.

    Nothing is kept in state, so any row may turn out to be the first, however late it comes.
    """

    def tick(batch: DataFrame, batch_id: int) -> None:
        dedupe.first_seen(batch, "url", order).write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")

    return _start(rows.writeStream.foreachBatch(tick), checkpoint, every)


def settled(spark: SparkSession, out: str, order: tuple[str, ...] = ("page", "pos")) -> DataFrame:
    """One row per URL, the first in ``order``; rows that tie in it are told apart by batch."""
    return dedupe.first_seen(spark.read.parquet(out), "url", (*order, "batch_id")).drop("batch_id")


def _thinned(batches: Iterator[pa.RecordBatch], order: tuple[str, ...]) -> Iterator[pa.RecordBatch]:
    """Of each URL in an Arrow batch, the first row."""
    for batch in batches:
        rows = pa.Table.from_batches([batch]).append_column("_at", pa.array(range(batch.num_rows), pa.int64()))
        rows = rows.sort_by([("url", "ascending"), *[(c, "ascending") for c in order], ("_at", "ascending")])
        repeated = rows.column("url").to_pandas().duplicated().to_numpy()
        yield batch.take(rows.column("_at").filter(pa.array(~repeated)).combine_chunks())


class LeastRow(StatefulProcessor):
    """Keeps the place of each URL's first row so far, and lets a row pass that comes before it.

    With an event time, a timer forgets the place ``horizon_ms`` after the row that was last kept.
    """

    def __init__(self, order: tuple[str, ...], event_time: str | None, horizon_ms: int):
        self.order, self.event_time, self.horizon_ms = order, event_time, horizon_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.place = handle.getValueState("place", StructType([StructField(c, LongType()) for c in (*self.order, "due")]))

    def handleInputRows(self, key, rows, timerValues):  # noqa: N802, N803
        best = min(rows, key=lambda row: tuple(row[c] for c in self.order))
        place = tuple(int(best[c]) for c in self.order)
        known = tuple(self.place.get()) if self.place.exists() else None
        if known is not None and place >= known[:-1]:
            return
        due = 0
        if self.event_time is not None:
            at = best[self.event_time]
            at = at if at.tzinfo is not None else at.replace(tzinfo=UTC)
            due = int(at.timestamp() * 1000) + self.horizon_ms
            if known is not None:
                self.handle.deleteTimer(known[-1])
            self.handle.registerTimer(due)
        self.place.update((*place, due))
        replaced = dict(zip([f"replaced_{c}" for c in self.order], known or (None,) * len(self.order), strict=False))
        yield Row(**best.asDict(), **replaced)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):  # noqa: N802, N803
        self.place.clear()
        return iter(())

    def close(self) -> None:
        pass


def first_row_stream(
    rows: DataFrame, out: str, checkpoint: str, every: str | None = "5 seconds", order: tuple[str, ...] = ("page", "pos"),
    event_time: str | None = "scraped_at", horizon_days: int = 30,
) -> StreamingQuery:
    """Store a URL's first row as soon as it is seen, and again whenever one turns up that comes before it.

    State holds three numbers a URL, on executor disks; a timer drops them ``horizon_days`` of event time after the row
    that was last kept (without an event time: never).  What a stored row replaces stands beside it, so ``first_rows``
    needn't look through all rows again.  Rows without a URL, place or time are left out.  Repeats within an Arrow
    batch are dropped before the shuffle.
    """
    use_disk_state(rows.sparkSession)
    needed = ["url", *order, *[event_time] * (event_time is not None)]
    placed = rows.where(reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in needed]))
    if event_time is not None:
        placed = placed.withWatermark(event_time, f"{horizon_days} days")
    thin = placed.mapInArrow(lambda it: _thinned(it, order), rows.schema)
    schema = StructType([*rows.schema.fields, *[StructField(f"replaced_{c}", LongType()) for c in order]])
    keeper = LeastRow(order, event_time, horizon_days * 86_400_000)
    # Plain rows: a pandas frame for each URL costs several times what its state does.
    kept = thin.groupBy("url").transformWithState(keeper, schema, "Update", "None" if event_time is None else "EventTime")

    def tick(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")

    return _start(kept.writeStream.outputMode("update").foreachBatch(tick), checkpoint, every)


def first_rows(spark: SparkSession, out: str, order: tuple[str, ...] = ("page", "pos")) -> DataFrame:
    """One row per URL, the first in ``order``: what ``first_row_stream`` stored, less what later ticks have replaced.

    Only the replaced places, which are few, are looked up.
    """
    stored = spark.read.parquet(out)
    gone = stored.where(F.col(f"replaced_{order[0]}").isNotNull()).select("url", *[F.col(f"replaced_{c}").alias(f"_{c}") for c in order])
    same = reduce(lambda a, b: a & b, [F.col(c) == F.col(f"_{c}") for c in order], F.col("url") == F.col("_url"))
    left = stored.join(gone.withColumnRenamed("url", "_url"), same, "left_anti")
    return left.drop("batch_id", *[f"replaced_{c}" for c in order])


def append_stream(rows: DataFrame, out: str, checkpoint: str, every: str | None = "5 seconds") -> StreamingQuery:
    """Append to a parquet folder, exactly once; restart with the same checkpoint to resume."""
    return _start(rows.writeStream.format("parquet").option("path", out), checkpoint, every)


def extract_stream(pages: DataFrame, form: str = "v2") -> DataFrame:
    """The batch extraction over arriving pages: narrow, so nothing is held back."""
    extract = {"v1": article.article_v1, "v2": article.article_v2, "v3": article.article_v3}[form]
    return extract(outline.outline(pages))


def snapshot_stream(rows: DataFrame, out: str, checkpoint: str, every: str | None = "5 seconds") -> StreamingQuery:
    """One folder per micro-batch; a replayed batch replaces its own folder only."""

    def tick(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")

    return _start(rows.writeStream.foreachBatch(tick), checkpoint, every)


def run_to_end(query: StreamingQuery) -> None:
    """Wait for an availableNow query."""
    query.awaitTermination()


def latest_progress(spark: SparkSession, out: str) -> DataFrame:
    """The newest finished progress row, with its ``tick``."""
    rows = spark.read.parquet(out)
    return rows.where(F.col("tick") == rows.agg(F.max("tick")).scalar())


def latest(spark: SparkSession, out: str) -> DataFrame:
    return spark.read.parquet(out)
