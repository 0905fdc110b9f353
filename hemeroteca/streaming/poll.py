"""Watching a folder whose writers don't rename finished files into it.

At each tick every file's size and time are compared with those of the tick before. A file that has just come or
changed is still being written and is left alone; one that has settled is read once, whole, in place of what was read
of it before. A folder that isn't there and a file whose text is cut short are told as rows, and tried again later.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from hemeroteca.sources.readers import exists, split_json_arrays

_SIZES = "file string, length long, modified timestamp, taken boolean, tick long"


def look(spark: SparkSession, folder: str, schema: T.StructType, out: str, tick: int) -> None:
    """One tick: note the files' states under ``out``, and store the records of those that have settled.

    Files hold one JSON array each. A tick that is repeated replaces what it has stored.
    """
    out = out.rstrip("/")
    if not exists(spark, folder):
        _note(spark.createDataFrame([(None, "waiting", None)], "file string, state string, n long"), out, tick)
        return
    found = spark.read.format("binaryFile").load(folder)  # sizes only: the content isn't asked for
    found = found.select(F.col("_metadata.file_path").alias("file"), "length", F.col("modificationTime").alias("modified"))
    last = _sizes(spark, out, tick - 1).select("file", "length", "modified", "taken")
    same = found.join(last, ["file", "length", "modified"], "left")
    settled = same.select("file", "length", "modified", F.col("taken").isNotNull().alias("settled"), F.coalesce("taken", F.lit(False)).alias("was_taken"))
    path = f"{out}/sizes/tick={tick}"
    settled.select("file", "length", "modified", F.col("settled").alias("taken"), "was_taken").write.mode("overwrite").parquet(path)
    sizes = spark.read.parquet(path)
    fresh = [r["file"] for r in sizes.where("taken and not was_taken").select("file").collect()]  # the files of a tick
    states = sizes.select("file", F.when(~F.col("taken"), "growing").when(F.col("was_taken"), "taken").alias("state"))
    told = states.where("state is not null").select("file", "state", F.lit(None).cast("long").alias("n"))
    if fresh:
        rows, rejects = split_json_arrays(spark, fresh, schema)
        rows.write.mode("overwrite").parquet(f"{out}/records/tick={tick}")
        stored = spark.read.schema(T.StructType([T.StructField("file", T.StringType())])).parquet(f"{out}/records/tick={tick}")
        broken = rejects.where("idx is null").select("file", F.lit("half written").alias("state"), F.lit(None).cast("long").alias("n"))
        sound = sizes.where("taken and not was_taken").select("file").join(broken.select("file"), "file", "left_anti")
        counts = sound.join(stored.groupBy("file").agg(F.count("*").alias("n")), "file", "left")
        told = told.union(broken).union(counts.select("file", F.lit("read"), F.coalesce("n", F.lit(0))))
    _note(told, out, tick)


def _note(states: DataFrame, out: str, tick: int) -> None:
    states.write.mode("overwrite").parquet(f"{out}/states/tick={tick}")


def _sizes(spark: SparkSession, out: str, tick: int) -> DataFrame:
    rows = spark.read.schema(_SIZES).parquet(f"{out}/sizes") if exists(spark, f"{out}/sizes") else spark.createDataFrame([], _SIZES)
    return rows.where(F.col("tick") == tick)


def states(spark: SparkSession, out: str) -> DataFrame:
    """(tick, file, state, n): ``waiting``, ``growing``, ``half written``, ``read`` with its records, ``taken`` earlier."""
    return spark.read.schema("file string, state string, n long, tick long").parquet(f"{out.rstrip('/')}/states")


def records(spark: SparkSession, out: str, schema: T.StructType) -> DataFrame:
    """The records of every file, as it was when it was last read."""
    kept = T.StructType([T.StructField("file", T.StringType()), T.StructField("idx", T.LongType()), *schema.fields, T.StructField("tick", T.LongType())])
    rows = spark.read.schema(kept).parquet(f"{out.rstrip('/')}/records")
    last = rows.groupBy("file").agg(F.max("tick").alias("tick"))  # a row a file
    return rows.join(last, ["file", "tick"], "left_semi").drop("tick")


def watch_folder(spark: SparkSession, folder: str, schema: T.StructType, out: str, checkpoint: str, every: str = "5 seconds") -> StreamingQuery:
    """Look at the folder at every tick, numbered on over restarts, until the query is stopped."""
    clock = spark.readStream.format("rate").option("rowsPerSecond", 1).load()
    ticks = clock.writeStream.foreachBatch(lambda _, tick: look(spark, folder, schema, out, tick))
    return ticks.option("checkpointLocation", checkpoint).trigger(processingTime=every).start()
