"""Readers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hemeroteca.operators.dedupe import first_seen
from hemeroteca.session import scratch_path
from hemeroteca.sources.arrays import array_records

CSV_OPTIONS = {
    "header": "true",
    "escape": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
    "nullValue": "",
    "emptyValue": "",
}


def read_json_array(spark: SparkSession, path: str | list[str], schema: T.StructType) -> DataFrame:
    """Files holding one JSON array of records each, with 0-based ``idx`` and ``file``.

    A big file is read in splits, many tasks at once.  A file that is no such array, or a
    record that does not fit the schema, fails the query; see ``split_json_arrays``.
    """
    rows = array_records(spark, path)
    stop = F.raise_error(F.concat_ws(": ", F.lit("not an array of records"), "file", "fault"))
    text = F.when(F.col("fault").isNotNull(), stop.cast("string")).otherwise(F.col("record"))
    parsed = rows.select("file", "idx", F.from_json(text, schema, {"mode": "FAILFAST"}).alias("r"))
    return parsed.select("file", "idx", "r.*")


def split_json_arrays(spark: SparkSession, path: str | list[str], schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """(records as ``read_json_array`` gives them, rejects: ``file``, ``idx``, ``text``).

    A record that does not fit the schema is a reject with its place and text.  Of a file
    that is no array of records, nothing is read; it is one reject, with what is wrong with it.
    """
    path_of = scratch_path(spark, "array-records")
    array_records(spark, path).write.parquet(path_of)
    rows = spark.read.parquet(path_of)
    faults = rows.where("fault is not null").groupBy("file").agg(F.min(F.struct("idx", "fault")).alias("f"))
    kept = T.StructType([*schema.fields, T.StructField("_text", T.StringType())])
    sound = rows.where("fault is null").join(faults.select("file"), "file", "left_anti")
    parsed = sound.select("file", "idx", F.from_json("record", kept, {"columnNameOfCorruptRecord": "_text"}).alias("r")).select("file", "idx", "r.*")
    bad = F.col("_text").isNotNull()
    rejects = parsed.where(bad).select("file", "idx", F.col("_text").alias("text"))
    whole = faults.select("file", F.lit(None).cast("long").alias("idx"), F.col("f.fault").alias("text"))
    return parsed.where(~bad).drop("_text"), rejects.union(whole)


def read_json_folder(
    spark: SparkSession, folder: str, schema: T.StructType | None = None, multi_line: bool = True
) -> DataFrame:
    """Every JSON file or JSON table of a folder whose name does not speak of a checkpoint.

    Without a schema the columns are the sorted union of keys; name one for big
    folders, since inferring reads everything once more.  Broken text, or a file of
    lines read with ``multi_line``, fails the query.
    """
    # Chosen by name before reading, so checkpoints are not even opened.
    names = json_names(spark, folder)
    if not names:
        return spark.createDataFrame([], schema or T.StructType([]))
    paths = [f"{folder.rstrip('/')}/{n}" for n in names]
    reader = spark.read.option("multiLine", multi_line).option("recursiveFileLookup", True).option("mode", "FAILFAST")
    if schema is not None:
        reader = reader.schema(schema)
    rows = reader.json(paths)
    return rows if not multi_line else _with_whole_files(spark, paths, rows)


def _with_whole_files(spark: SparkSession, paths: list[str], rows: DataFrame) -> DataFrame:
    """The rows, or an error where a file goes on after its first JSON value, of which alone ``multiLine`` reads."""
    sizes = spark.read.option("recursiveFileLookup", True).text(paths, wholetext=True)
    more = F.col("value").rlike("^\\s*\\{[^\\n]*\\}\\s*\\n\\s*\\{")
    stop = F.raise_error(F.concat(F.lit("a file of lines, to be read with multi_line=False: "), "_metadata.file_path"))
    checked = sizes.where(F.when(more, stop.cast("boolean")).otherwise(F.lit(False)))
    nothing = checked.select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in rows.schema])
    return rows.unionByName(nothing)


def json_names(spark: SparkSession, folder: str) -> list[str]:
    """Names ending in ``.json`` that do not speak of a checkpoint."""
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(folder)
    fs = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = [s.getPath().getName() for s in fs.listStatus(where)] if fs.exists(where) else []
    return sorted(n for n in names if n.endswith(".json") and "checkpoint" not in n)


def read_records(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """One JSON record per line: splittable, the form ``write_records`` writes.

    A line that is no record fails the query; see ``split_records``.
    """
    return spark.read.schema(schema).json(path, mode="FAILFAST")


def split_records(spark: SparkSession, path: str, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """The records that can be read, and the text (``line``) of each other line."""
    lines = spark.read.text(path).where("trim(value) != ''")
    kept = T.StructType([*schema.fields, T.StructField("_line", T.StringType())])
    parsed = lines.select(F.from_json("value", kept, {"columnNameOfCorruptRecord": "_line"}).alias("r")).select("r.*")
    bad = F.col("_line").isNotNull()
    return parsed.where(~bad).drop("_line"), parsed.where(bad).select(F.col("_line").alias("line"))


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """CSV as ``write_csv`` writes it.

    Bodies hold line breaks, so a file is read whole by one task; the writer's many
    part files keep that parallel.  A row that does not fit the schema fails the query.
    """
    return spark.read.schema(schema).options(**CSV_OPTIONS).option("multiLine", True).csv(path, mode="FAILFAST")


def read_checkpoint(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The articles of a progress checkpoint, with its ``page`` or ``last_index``.

    A missing file gives no rows; an unreadable one gives no rows either, and leaves
    its text in no output: resuming then starts from nothing.
    """
    empty = spark.createDataFrame([], schema)
    if exists(spark, path):
        empty = spark.read.schema(schema).json(path, multiLine=True, mode="DROPMALFORMED")
    mark = "page" if "page" in schema.names else "last_index"
    return empty.select(F.col(mark).alias(f"checkpoint_{mark}"), F.inline("articles"))


def read_finished(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The append-only output of earlier runs, one row per URL; no rows where it does not exist yet.

    The earliest row counts.  All rows of a run may bear one time, so a hash of the whole
    row, then the row, decides between them: the same one at every read.
    """
    if not exists(spark, path):
        return spark.createDataFrame([], schema)
    rows = spark.read.schema(schema).parquet(path).withColumn("_row", F.to_json(F.struct("*")))
    return first_seen(rows.withColumn("_tie", F.xxhash64("_row")), "url", ("scraped_at", "_tie", "_row")).drop("_row", "_tie")


def exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where)


def stream_folder(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet", **options) -> DataFrame:
    """A folder that other jobs keep adding files to.

    A folder that is still empty gives empty ticks.  Writers must rename finished
    files into it; half-written ones are then never seen.
    """
    return spark.readStream.schema(schema).format(fmt).options(**options).load(path)
