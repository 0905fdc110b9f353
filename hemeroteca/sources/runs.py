"""What runs leave behind: finished positions, counts and sketches, stored by run and merged on read.

Each run writes its own folder, and a run that is repeated writes it anew, so nothing is counted twice and nothing
that earlier runs have counted is read again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hemeroteca.functions import fixed_values as fv
from hemeroteca.functions import urls
from hemeroteca.sources.readers import exists

#: Positions in a bitmap of Spark's bitmap functions.
BITMAP = 32_768
#: Of the sketches: 2 to the 14 registers, so estimates are off by 0.8 % as a rule, and by 3 % hardly ever.
SKETCH_BITS, SKETCH_BOUND = 14, 0.03


def _write(rows: DataFrame, path: str, run: str) -> None:
    rows.coalesce(1).write.mode("overwrite").parquet(f"{path.rstrip('/')}/run={run}")


# --- finished positions --------------------------------------------------------------------------


def note_finished(rows: DataFrame, path: str, run: str, order: str = "idx") -> None:
    """Note the positions that ``run`` has finished, in whatever order it did.

    A bitmap of 4 KB holds 32,768 of them.  Negative and missing positions are none.
    """
    at = rows.where(F.col(order) >= 0).select(F.expr(f"`{order}` div {BITMAP}").alias("block"), F.expr(f"`{order}` % {BITMAP}").alias("bit"))
    made = at.groupBy("block").agg(F.bitmap_construct_agg("bit").alias("bits"))
    made.write.mode("overwrite").parquet(f"{path.rstrip('/')}/run={run}")


def finished(spark: SparkSession, path: str) -> DataFrame:
    """(block, bits): the positions finished in any run."""
    if not exists(spark, path):
        return spark.createDataFrame([], "block long, bits binary")
    return spark.read.schema("block long, bits binary").parquet(path).groupBy("block").agg(F.bitmap_or_agg("bits").alias("bits"))


def _is_set(bits: Column, bit: Column) -> Column:
    byte = F.conv(F.hex(F.substr(bits, (F.shiftright(bit.cast("int"), 3) + 1), F.lit(1))), 16, 10)
    return F.getbit(byte.cast("int"), (bit % 8).cast("int")) == 1


def gaps(spark: SparkSession, path: str, n: int) -> DataFrame:
    """The positions below ``n`` that no run has finished: the backlog, found from the bitmaps alone."""
    blocks = spark.range(-(-n // BITMAP)).withColumnRenamed("id", "block")
    known = blocks.join(finished(spark, path), "block", "left")
    places = F.sequence(F.lit(0), F.least(F.lit(BITMAP), F.lit(n) - F.col("block") * BITMAP).cast("int") - 1)
    left = F.when(F.col("bits").isNull(), places).otherwise(F.filter(places, lambda p: ~_is_set(F.col("bits"), p)))
    return known.select("block", F.explode(left).alias("place")).select((F.col("block") * BITMAP + F.col("place")).alias("position"))


def unfinished_rows(rows: DataFrame, path: str, order: str = "idx") -> DataFrame:
    """The rows whose position no run has finished; rows without a position are never finished.

    Rows meet one bitmap for each block of positions, so no list of finished keys is joined.
    """
    known = finished(rows.sparkSession, path).select(F.col("block").alias("_block"), F.col("bits").alias("_bits"))
    found = rows.withColumn("_block", F.when(F.col(order) >= 0, F.expr(f"`{order}` div {BITMAP}"))).join(known, "_block", "left")
    done = F.coalesce(_is_set(F.col("_bits"), F.expr(f"`{order}` % {BITMAP}")), F.lit(False))
    return found.where(~done).drop("_block", "_bits")


# --- counts and sketches ---------------------------------------------------------------------------

_TALLIES = "kind string, key string, n long, first_idx long, sketch binary"


def add_tallies(articles: DataFrame, path: str, run: str, order: str = "idx") -> None:
    """Count the rows that ``run`` has appended: sections, years, bodies and dates, and sketches of URLs and titles.

    One pass over these rows; what is stored are a few rows a section and year.
    """
    section = F.coalesce(urls.section(F.col("url")), F.lit(""))
    facts = F.array(
        _fact("rows", F.lit("")),
        _fact("section", section),
        _fact("year", F.when(urls.year(F.col("date")).rlike(f"^{fv.DIGIT}+$"), urls.year(F.col("date")))),
        _fact("body", F.when(F.length("body") > fv.LOW_CONTENT, "")),
        _fact("date", F.when(F.col("date") != "", "")),
    )
    counted = articles.select(F.col(order).alias("idx"), F.inline(F.filter(facts, lambda f: f["key"].isNotNull())))
    counted = counted.groupBy("kind", "key").agg(F.count("*").alias("n"), F.min("idx").alias("first_idx"), F.lit(None).cast("binary").alias("sketch"))
    sketches = articles.agg(*[F.hll_sketch_agg(c, SKETCH_BITS).alias(c) for c in ("url", "title")])
    sketches = sketches.select(F.inline(F.array(*[_sketch(c) for c in ("url", "title")])))
    _write(counted.unionByName(sketches.select("kind", "key", "n", "first_idx", "sketch")), path, run)


def _fact(kind: str, key: Column) -> Column:
    return F.struct(F.lit(kind).alias("kind"), key.alias("key"))


def _sketch(column: str) -> Column:
    none = F.lit(None).cast("long")
    return F.struct(F.lit(f"distinct {column}").alias("kind"), F.lit("").alias("key"), none.alias("n"), none.alias("first_idx"), F.col(column).alias("sketch"))


def tallies(spark: SparkSession, path: str) -> DataFrame:
    """(run, kind, key, n, first_idx, sketch) of all runs."""
    return spark.read.schema(f"{_TALLIES}, run string").parquet(path)


def tallied(spark: SparkSession, path: str, kind: str) -> DataFrame:
    """(key, n, first_idx, pct) over all runs, most frequent first; ``pct`` is the share of all rows."""
    own = tallies(spark, path)
    total = own.where("kind = 'rows'").agg(F.sum("n")).scalar()
    merged = own.where(F.col("kind") == kind).groupBy("key").agg(F.sum("n").alias("n"), F.min("first_idx").alias("first_idx"))
    return merged.withColumn("pct", F.col("n") * 100.0 / total).orderBy(F.desc("n"), "first_idx")


def tallied_coverage(spark: SparkSession, path: str) -> DataFrame:
    """(n_rows, with_body, with_date) over all runs."""
    kinds = {"n_rows": "rows", "with_body": "body", "with_date": "date"}
    return tallies(spark, path).agg(*[F.coalesce(F.sum(F.when(F.col("kind") == k, F.col("n"))), F.lit(0)).alias(name) for name, k in kinds.items()])


def estimated_distinct(spark: SparkSession, path: str) -> DataFrame:
    """(kind, estimate): different URLs and titles over all runs, within ``SKETCH_BOUND``."""
    sketches = tallies(spark, path).where("sketch is not null")
    return sketches.groupBy("kind").agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("estimate"))
