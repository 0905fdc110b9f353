"""JSON array files as many tasks each.

A file is cut after every ``}``, which Spark's text reader does from any byte on, so a big file is read in splits.
Whether a ``}`` ends a record depends on all that stands before it: quotes and brackets. Both add up. A split tells
whether it leaves a string open, by how much it changes the depth, and how many brackets it closes at which depth,
once as if it began inside a string and once as if outside; sums over the splits before it say which of the two is so.
Only these few numbers a split go through a window. Then each split cuts its records alone, and a record that lies in
several of them is put together.

The text goes through one shuffle, on (file, split), so that a split meets what is known of its beginning.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from hemeroteca.session import scratch_path

_CUT = "}"
#: Characters of records that are handed on at once.
_FLUSH = 8 << 20


class Cutter:
    """Follows quotes and brackets through the chunks of an array file, each ended by a ``}``."""

    def __init__(self, inside: bool, depth: int):
        self.inside, self.depth = inside, depth

    def closes(self, chunk: str) -> bool:
        """Go on over a chunk; whether the ``}`` after it closes a bracket."""
        if "\\" in chunk:
            chunk = unescaped(chunk)
        parts = chunk.split('"')
        spoken = parts[1::2] if self.inside else parts[::2]
        self.inside ^= len(parts) % 2 == 0
        for part in spoken:
            self.depth += part.count("{") + part.count("[") - part.count("]")
        self.depth -= not self.inside
        return not self.inside


def unescaped(chunk: str) -> str:
    """The chunk without escaped characters."""
    parts, start, at = [], 0, chunk.find("\\")
    while at >= 0:
        parts.append(chunk[start:at])
        start = at + 2
        at = chunk.find("\\", start)
    return "".join([*parts, chunk[start:]])


def _chunks(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(file, start, n, chunk): what stands before each ``}``, in splits of a file, numbered in each."""
    rows = spark.read.option("lineSep", _CUT).text(path)
    return rows.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("start"),
        F.col("_metadata.file_size").alias("size"),
        F.monotonically_increasing_id().alias("n"),
        F.col("value").alias("chunk"),
    )


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(column.to_pylist() for column in batch.columns), strict=True)


def _table(held: list[tuple], names: list[str], kinds: list[pa.DataType]) -> pa.RecordBatch:
    columns = list(zip(*held, strict=True))
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)


def _changes(chunks: DataFrame) -> DataFrame:
    """A row for each split: what it changes if it begins outside of strings, and if inside."""
    names = ["file", "start", "size", "bytes", "opens", "out", "within", "ends_out", "ends_within"]
    numbers = pa.map_(pa.int64(), pa.int64())
    kinds = [pa.string(), *[pa.int64()] * 6, numbers, numbers]

    def run(batches):
        made, own, held = [], None, None

        def row():
            (out, within), ends = held["cutters"], held["ends"]
            return *own, held["bytes"], int(out.inside), out.depth, within.depth, *(list(e.items()) for e in ends)

        for file, start, size, chunk, length in _rows(batches):
            if (file, start, size) != own:
                if own:
                    made.append(row())
                own = (file, start, size)
                held = {"cutters": (Cutter(False, 0), Cutter(True, 0)), "ends": (Counter(), Counter()), "bytes": 0}
            held["bytes"] += length + 1
            for cutter, ends in zip(held["cutters"], held["ends"], strict=True):
                # The array's depth is 1, so only the first split can close a record deeper than it began.
                if cutter.closes(chunk) and cutter.depth <= 1:
                    ends[cutter.depth] += 1
        if own:
            made.append(row())
        if made:
            yield _table(made, names, kinds)

    ddl = "file string, start long, size long, bytes long, opens long, out long, within long, ends_out map<long,long>, ends_within map<long,long>"
    return chunks.select("file", "start", "size", "chunk", F.octet_length("chunk").cast("long")).mapInArrow(run, ddl)


def _beginnings(chunks: DataFrame) -> DataFrame:
    """(file, start, inside, depth, first, ended): how each split begins, the number of its first record, and whether
    the file's last bracket, and no quote, closes the array."""
    file = W.partitionBy("file")
    earlier = file.orderBy("start").rowsBetween(W.unboundedPreceding, -1)

    def before(column):
        return F.coalesce(F.sum(column).over(earlier), F.lit(0))

    rows = _changes(chunks).withColumn("inside", before("opens") % 2 == 1)
    rows = rows.withColumn("depth", before(F.when(F.col("inside"), F.col("within")).otherwise(F.col("out"))))
    ends = F.when(F.col("inside"), F.col("ends_within")).otherwise(F.col("ends_out"))
    rows = rows.withColumn("ends", F.coalesce(F.try_element_at(ends, 1 - F.col("depth")), F.lit(0)))
    # The ``}`` that the last chunk is taken to end with isn't there: after the array's end, depth is -1.
    total = F.sum(F.when(F.col("inside"), F.col("within")).otherwise(F.col("out"))).over(file)
    ended = (F.sum("bytes").over(file) - 1 == F.col("size")) & (F.sum("opens").over(file) % 2 == 0) & (total == -1)
    return rows.select("file", "start", "inside", "depth", before("ends").alias("first"), ended.alias("ended"))


#: A part of a record that goes on, a whole record, and the end of a record that began in an earlier split.
_OPEN, _WHOLE, _END_OF = 0, 1, 2


def _parts(chunks: DataFrame, known: DataFrame) -> DataFrame:
    """(file, start, idx, kind, text): records, and the parts of those that lie in several splits.

    A text begins with what stands between the last record and its own.
    """
    nothing = [F.lit(None).cast(kind) for kind in ("boolean", "long", "long")]
    marks = known.select("file", "start", F.lit(-1).cast("long").alias("n"), F.lit(None).cast("string").alias("chunk"), "inside", "depth", "first")
    dealt = marks.union(chunks.select("file", "start", "n", "chunk", *nothing))
    dealt = dealt.repartition("file", "start").sortWithinPartitions("file", "start", "n")
    names = ["file", "start", "idx", "kind", "text"]
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.string()]

    def parts(batches):
        place, held, cutter, idx, kind = None, [], None, 0, _WHOLE
        for file, start, n, chunk, inside, depth, first in _rows(batches):
            if n < 0:
                if held:
                    yield *place, idx, _OPEN, _CUT.join([*held, ""])
                place, held, cutter, idx = (file, start), [], Cutter(inside, depth), first
                kind = _END_OF if depth > 1 else _WHOLE
                continue
            held.append(chunk)
            if cutter.closes(chunk) and cutter.depth == 1:
                yield *place, idx, kind, _CUT.join([*held, ""])
                held, idx, kind = [], idx + 1, _WHOLE
        if held:
            yield *place, idx, _OPEN, _CUT.join([*held, ""])

    def run(batches):
        held, size = [], 0
        for row in parts(batches):
            held.append(row)
            size += len(row[-1])
            if size > _FLUSH:
                yield _table(held, names, kinds)
                held, size = [], 0
        if held:
            yield _table(held, names, kinds)

    return dealt.mapInArrow(run, "file string, start long, idx long, kind int, text string")


def array_records(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(file, idx, record, fault) of the array files under ``path``.

    ``record`` is a record's text, ``idx`` its place. A row with a ``fault`` says what is wrong with a file that is no
    array of records: what stands before a record or after the last one, or that the array has no end, as in a file
    without a byte. The files are read once at the call, to learn how each split begins, and once by the result.
    """
    chunks, stored = _chunks(spark, path), scratch_path(spark, "splits")
    _beginnings(chunks).write.parquet(stored)
    known = spark.read.parquet(stored)
    parts = _parts(chunks, known)
    whole = parts.where(F.col("kind") == _WHOLE).select("file", "idx", F.lit(True).alias("whole"), "text")
    pieces = F.sort_array(F.collect_list(F.struct("start", "text")))  # of one record
    joined = parts.where(F.col("kind") != _WHOLE).groupBy("file", "idx").agg((F.max("kind") == _END_OF).alias("whole"), pieces.alias("parts"))
    texts = whole.union(joined.select("file", "idx", "whole", F.array_join(F.transform("parts", lambda p: p["text"]), "").alias("text")))
    first = F.col("idx") == 0
    fits = F.when(F.col("whole"), F.when(first, F.col("text").rlike(_FIRST_LEAD)).otherwise(F.col("text").rlike(_LEAD)))
    fits = F.coalesce(fits, F.when(first, F.col("text").rlike(_EMPTY)).otherwise(F.col("text").rlike(_END)))
    fault = F.concat(F.when(F.col("whole"), "before a record: ").otherwise("after the last record: "), F.left("text", F.lit(80)))
    rows = texts.select(
        "file",
        "idx",
        F.when(F.col("whole") & fits, F.regexp_replace("text", _STRIP, "{")).alias("record"),
        F.when(~fits, fault).alias("fault"),
    ).where("record is not null or fault is not null")
    # The names that Spark's own listing, which the driver holds, gives: readers leave out files without a byte.
    names = [re.sub("^([A-Za-z0-9+.-]+):///", r"\1:/", name) for name in spark.read.text(path).inputFiles()]
    every = spark.createDataFrame([(name,) for name in names], "file string")
    endless = every.join(known.where("ended").select("file").distinct(), "file", "left_anti")
    nothing = F.lit(None)
    return rows.union(endless.select("file", nothing.cast("long"), nothing.cast("string"), F.lit("the array has no end")))


# What may stand before a record and after the last one; there, every text ends with the ``}`` of its chunk.
_FIRST_LEAD, _LEAD = "^\ufeff?\\s*\\[\\s*\\{", "^\\s*,\\s*\\{"
_EMPTY, _END = "^\ufeff?\\s*\\[\\s*\\]\\s*\\}$", "^\\s*\\]\\s*\\}$"
_STRIP = "^[\ufeff\\s\\[,]*\\{"
