"""Writers."""

from __future__ import annotations

import time
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hemeroteca.session import scratch_path
from hemeroteca.sources.readers import CSV_OPTIONS, exists, json_names


def write_records(rows: DataFrame, path: str, mode: str = "error") -> None:
    """JSON, one record per line, UTF-8, every field present."""
    rows.write.mode(mode).option("ignoreNullFields", False).json(path)


def write_json_array(rows: DataFrame, path: str, order: str) -> None:
    """One JSON array, ``path``, of all rows in ``order``; null fields are kept.

    Tasks write sorted parts, each record behind a comma, and Spark commits them; then the
    file system client lays them end to end, byte by byte and without parsing, so the
    file's size is no matter of memory.  A failed call leaves no file under ``path``, and
    rows that tie in ``order`` go by their text.
    """
    spark = rows.sparkSession
    record = F.to_json(F.struct(*[F.col(f"`{c}`") for c in rows.columns]), {"ignoreNullFields": "false"})
    lines = rows.select(F.col(f"`{order}`").alias("own"), F.concat(F.lit(","), record).alias("value")).orderBy("own", "value")
    parts = scratch_path(spark, "array-parts")
    lines.select("value").write.text(parts)
    _join_records(spark, parts, path)


def _join_records(spark: SparkSession, parts: str, path: str) -> None:
    """The lines of a folder's part files, in the order of their names, as one array.

    Every line begins with a comma; the first one's is left out.
    """
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    folder, target = jvm.org.apache.hadoop.fs.Path(parts), jvm.org.apache.hadoop.fs.Path(path)
    source_fs, fs = folder.getFileSystem(conf), target.getFileSystem(conf)
    if fs.exists(target):
        raise FileExistsError(path)
    unfinished = jvm.org.apache.hadoop.fs.Path(f"{path}.unfinished")
    listed = sorted((s for s in source_fs.listStatus(folder) if s.getLen()), key=lambda s: s.getPath().getName())
    listed = [s.getPath() for s in listed if s.getPath().getName().startswith("part-")]
    out = fs.create(unfinished, True)
    try:
        out.write(ord("["))
        for number, part in enumerate(listed):
            stream = source_fs.open(part)
            try:
                stream.seek(int(number == 0))
                jvm.org.apache.hadoop.io.IOUtils.copyBytes(stream, out, 1 << 20, False)
            finally:
                stream.close()
        out.write(ord("]"))
    finally:
        out.close()
    if not fs.rename(unfinished, target):
        raise OSError(f"{path}: could not be put in place")


def write_one_file(text: DataFrame, path: str) -> None:
    """The single row of ``text`` as one file, in place of what is there."""
    spark = text.sparkSession
    parts = scratch_path(spark, "one-file")
    text.coalesce(1).write.text(parts)
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    folder, target = jvm.org.apache.hadoop.fs.Path(parts), jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(conf)
    part = next(s.getPath() for s in fs.listStatus(folder) if s.getPath().getName().startswith("part-"))
    jvm.org.apache.hadoop.fs.FileUtil.copy(fs, part, target.getFileSystem(conf), target, False, True, conf)


def write_csv(
    rows: DataFrame, path: str, columns: list[str] | None = None, mode: str = "error", skip_empty: bool = False
) -> bool:
    """CSV with a header in column order, or in the order given.

    ``skip_empty`` writes nothing for an empty table.  The test looks for one row, so
    hand in stored rows with it.
    """
    if skip_empty and rows.isEmpty():
        return False
    kinds = {f.name: f.dataType for f in rows.schema.fields}
    out = rows.select(*[as_csv_text(c, kinds[c]) for c in columns or rows.columns])
    # Empty text is written as nothing, not as a quoted blank.
    out.write.mode(mode).options(**CSV_OPTIONS).csv(path)
    return True


def json_to_csv(spark: SparkSession, json_path: str, csv_path: str | None = None, multi_line: bool = True):
    """JSON records to CSV under the sorted union of their keys.

    Returns (csv path, records, columns), or None for an input without records.
    The records are counted by the job that writes them.  Broken input raises.
    """
    rows = spark.read.json(json_path, multiLine=multi_line, mode="FAILFAST")
    if not rows.columns or rows.isEmpty():
        return None
    if csv_path is None:
        csv_path = json_path.replace(".json", ".csv")
    seen = Observation("json_to_csv")
    write_csv(rows.observe(seen, F.count(F.lit(1)).alias("n")), csv_path, sorted(rows.columns))
    return csv_path, seen.get["n"], len(rows.columns)


def json_folder_to_csv(spark: SparkSession, folder: str, multi_line: bool = True) -> dict[str, tuple | None | Exception]:
    """``json_to_csv`` for every JSON file of a folder that is not a checkpoint.

    By file name: what ``json_to_csv`` returns, or the error that stopped this one file.
    """
    out: dict[str, tuple | None | Exception] = {}
    for name in json_names(spark, folder):
        try:
            out[name] = json_to_csv(spark, f"{folder.rstrip('/')}/{name}", multi_line=multi_line)
        except (PySparkException, Py4JJavaError) as failure:  # the inference reports a broken line in the JVM's way
            out[name] = failure
    return out


def as_csv_text(name: str, kind: T.DataType) -> Column:
    """A column as CSV can hold it: a list as ``['a', 'b']``, the way the published reports have it."""
    if isinstance(kind, T.ArrayType):
        return listed_text(F.col(f"`{name}`"), kind.elementType).alias(name)
    if isinstance(kind, T.StructType | T.MapType):
        return F.to_json(F.col(f"`{name}`")).alias(name)
    return F.col(f"`{name}`")


def listed_text(values: Column, kind: T.DataType) -> Column:
    """Python's text of a list: quoted strings, ``True``, ``None``; records inside are JSON."""

    def element(v: Column) -> Column:
        if isinstance(kind, T.StringType):
            plain = F.replace(v, F.lit("\\"), F.lit("\\\\"))
            for bad, spelled in (("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t")):
                plain = F.replace(plain, F.lit(bad), F.lit(spelled))
            double = F.contains(v, F.lit("'")) & ~F.contains(v, F.lit('"'))
            single = F.concat(F.lit("'"), F.replace(plain, F.lit("'"), F.lit("\\'")), F.lit("'"))
            text = F.when(double, F.concat(F.lit('"'), plain, F.lit('"'))).otherwise(single)
        elif isinstance(kind, T.ArrayType):
            text = listed_text(v, kind.elementType)
        elif isinstance(kind, T.StructType | T.MapType):
            text = F.to_json(v)
        elif isinstance(kind, T.BooleanType):
            text = F.initcap(v.cast("string"))
        else:
            text = v.cast("string")
        return F.coalesce(text, F.lit("None"))

    return F.concat(F.lit("["), F.array_join(F.transform(values, element), ", "), F.lit("]"))


def write_report(issues: DataFrame, path: str) -> bool:
    """The glued-word report, written only when there is something in it."""
    if issues.isEmpty():
        return False
    write_records(issues, path)
    return True


def snapshot_no(order: str, every: int):
    """1-based number of the snapshot a row first appears in."""
    return (F.expr(f"`{order}` div {every}") + 1).cast("int")


def write_snapshots(rows: DataFrame, path: str, every: int, order: str = "idx", together: int = 1) -> None:
    """Rows in folders ``snapshot=1, 2, ...`` of ``every`` rows each.

    A snapshot is all rows up to its number, so each row is written once, not once per
    snapshot.  With ``together`` above 1, so many snapshots share a folder ``snapshots=0, 1,
    ...`` and bear their number as a column: choose it so that a folder is worth a file.
    """
    numbered = rows.withColumn("snapshot", snapshot_no(order, every))
    folder = "snapshot"
    if together > 1:
        numbered, folder = numbered.withColumn("snapshots", F.expr(f"(snapshot - 1) div {together}")), "snapshots"
    # A folder is of bounded size, so one task may write it, and into one file.
    numbered.repartition(folder).write.mode("error").partitionBy(folder).options(**CSV_OPTIONS).csv(path)


def append_finished(rows: DataFrame, path: str) -> None:
    """Add finished rows to the output that resuming reads; nothing is rewritten."""
    rows.write.mode("append").parquet(path)


def materialise(rows: DataFrame, purpose: str) -> DataFrame:
    """Store rows in the shared scratch folder and read them back.

    Cuts the lineage between pipeline stages, and survives the loss of executors.
    """
    spark = rows.sparkSession
    path = scratch_path(spark, purpose)
    rows.write.parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def rewrite(spark: SparkSession, rows: DataFrame, path: str) -> str:
    """A new version of the table ``path`` beside the old one, made current once it is whole.

    A lazy plan cannot overwrite the files it still reads, so "in place" becomes a version
    named by time and chance, which no other writer takes, and a pointer to it that is
    replaced in one step.  Readers ask ``current_version``; of two writers, the later wins.
    """
    base = path.rstrip("/")
    target = f"{base}.v{time.time_ns() // 1_000_000:013d}-{uuid.uuid4().hex[:8]}"
    rows.write.parquet(target)
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    Path = jvm.org.apache.hadoop.fs.Path  # noqa: N806
    pointer, fresh = Path(f"{base}.current"), Path(f"{base}.current.{uuid.uuid4().hex}")
    files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(pointer.toUri(), conf) if pointer.toUri().getScheme() else jvm.org.apache.hadoop.fs.FileContext.getFileContext(conf)
    out = fresh.getFileSystem(conf).create(fresh, True)
    try:
        out.write(bytearray(target.encode()))
    finally:
        out.close()
    overwrite = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    overwrite[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    files.rename(fresh, pointer, overwrite)
    return target


def current_version(spark: SparkSession, path: str) -> str:
    """Where the table ``path`` lies now: its last whole rewrite, or ``path`` itself."""
    pointer = f"{path.rstrip('/')}.current"
    if not exists(spark, pointer):
        return path
    return spark.read.text(pointer, wholetext=True).first()["value"]
