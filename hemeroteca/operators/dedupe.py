"""First-seen rows, anti joins against finished work, and per-key numbering."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_seen(rows: DataFrame, key: str = "url", order: tuple[str, ...] = ("page", "pos")) -> DataFrame:
    """Keep the first row of each key.

    A ``row_number() = 1`` filter lets Spark keep one row per key in every map task
    before the shuffle (WindowGroupLimit), so a key that fills a third of the table
    reaches its reducer as one row per map task.
    """
    w = Window.partitionBy(key).orderBy(*order)
    return rows.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def resume_backlog(backlog: DataFrame, done: DataFrame, key: str = "url") -> DataFrame:
    """Rows whose key is not finished yet.

    The finished keys are made distinct first: a left anti join cannot be split on its right side, and a key
    finished very often would meet in one task.
    """
    return backlog.join(done.select(key).distinct(), key, "left_anti")


def append_rows(*parts: DataFrame) -> DataFrame:
    """One table after the other; columns missing from a part become NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def union_seen(*parts: DataFrame, key: str = "url") -> DataFrame:
    """The set of keys seen in any part."""
    return append_rows(*[p.select(key) for p in parts]).distinct()


def _numbered(rows: DataFrame, key: str, order: str, block: Column, name: str, repeated_only: bool) -> DataFrame:
    """Number each key's rows in ``order``; ``n`` is the key's row count.

    Rows shuffle on (key, block), so the rows of one hot key spread over many tasks;
    only block sizes are ever gathered per key.  A row's number is its place in its
    block plus the rows in the key's earlier blocks.  Key and block travel as one
    struct, in which a missing key equals a missing key, and which join and window
    can share one shuffle on.
    """
    keyed = rows.withColumn("_kb", F.struct(F.col(key).alias("k"), block.alias("b")))
    per_key = Window.partitionBy("_kb.k")
    earlier = per_key.orderBy("_kb.b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        keyed.groupBy("_kb")
        .agg(F.count("*").alias("_n"))
        .select(
            "_kb",
            F.sum("_n").over(per_key).alias("n"),
            F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_offset"),
        )
    )
    if repeated_only:
        offsets = offsets.where("n > 1")
    within = Window.partitionBy("_kb").orderBy(order)
    return (
        keyed.join(offsets, "_kb")
        .withColumn(name, F.row_number().over(within) + F.col("_offset"))
        .drop("_kb", "_offset")
    )


def number_within(rows: DataFrame, key: str, order: str, block: Column, name: str = "number") -> DataFrame:
    """1-based numbering of each key's rows in ``order``, safe for huge keys.

    ``block`` must not decrease along ``order``: an index divided by a constant, a page
    number.
    """
    return _numbered(rows, key, order, block, name, repeated_only=False).drop("n")


def duplicate_groups(rows: DataFrame, key: str = "url") -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    return rows.groupBy(key).agg(F.count("*").alias("n")).where("n > 1")


def duplicate_rows(rows: DataFrame, key: str = "url", order: str = "idx", block_rows: int = 1_000_000) -> DataFrame:
    """Every row of every repeated key, with the key's row count and the row's number in it."""
    return _numbered(rows, key, order, F.expr(f"`{order}` div {block_rows}"), "number", repeated_only=True)
