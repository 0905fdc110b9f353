"""Line dedup by content-defined chunks.

A hash rolls over the lines of a text and ends a chunk at every line where its value says so, so a passage is cut
alike wherever it stands, and what is put in before it shifts no later boundary. A chunk reaches from one such line to
the next, both included, so neighbouring chunks overlap and no pair of lines lies between two of them. Chunks of
several lines that occur earlier in the corpus are removed, after their bytes were found equal.

How many lines end a chunk is a parameter. At one in one, as in the query, all of them do: chunks are as short as can
be, and a repeated passage goes to its very ends whatever surrounds it. At one in n, fewer and longer chunks are
compared, and what lies between a passage's end and the nearest boundary inside it stays.

Only documents that hold a chunk whose hash repeats are shuffled, the others never leave their place.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import pairwise

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hemeroteca.llm.batches import fresh, slices, split_by_keys, tidied, with_columns
from hemeroteca.sources.writers import materialise

_FACTOR, _WORD = 0x9E3779B97F4A7C15, (1 << 64) - 1


def boundaries(lines: list[bytes], worded: list[int], one_in: int) -> list[int]:
    """The lines that end a chunk and begin the next: one in so many, by a hash rolled over ``one_in - 1`` lines and it.

    A hash over a single line is the line's own, and at one in one no line is passed over.
    """
    if one_in == 1:
        return worded
    window, rolling = [0] * one_in, 0
    leaves = pow(_FACTOR, one_in, 1 << 64)
    out = []
    for number, line in enumerate(worded):
        new = xxhash.xxh3_64_intdigest(lines[line])
        rolling = (rolling * _FACTOR + new - window[number % one_in] * leaves) & _WORD
        window[number % one_in] = new
        if (rolling ^ rolling >> 29) * _FACTOR >> 40 & 0xFFFF < 0x10000 // one_in:
            out.append(line)
    return out


def line_chunks(text: str, one_in: int = 1) -> Iterator[tuple[int, int, bytes]]:
    """(first line's number, hash, bytes) of every chunk; it begins and ends with a line that has something in it."""
    coded = text.encode().split(b"\n")
    worded = [number for number, line in enumerate(text.split("\n")) if line and not line.isspace()]
    for i, j in pairwise(boundaries(coded, worded, one_in)):
        chunk = b"\n".join(coded[i : j + 1])
        yield i, xxhash.xxh3_64_intdigest(chunk) - (1 << 63), chunk


def _listed(docs: DataFrame, with_bytes: bool, one_in: int) -> DataFrame:
    """``doc``, ``n``, ``hash`` and, if asked for, ``chunk`` of every chunk."""
    names = ["doc", "n", "hash", *["chunk"] * with_bytes]

    def run(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                rows = [(doc, *c[: len(names) - 1]) for doc, t in zip(*map(pa.Array.to_pylist, part.columns), strict=True) for c in line_chunks(t, one_in)]
                columns = list(zip(*rows, strict=True)) or [()] * len(names)
                types = [part.schema.field(0).type, pa.int32(), pa.int64(), pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=False)], names=names)

    kind = docs.schema["doc"].dataType.simpleString()
    return docs.mapInArrow(tidied(run), f"doc {kind}, n int, hash long" + ", chunk binary" * with_bytes)


def drop_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", removed: str = "removed_lines", one_in: int = 1) -> DataFrame:
    """``text`` without the chunks that stand earlier, by key and place; adds ``removed``, the numbers of their lines.

    At one in one, a passage is any run of lines, two of them or more with something in them; it goes from its first
    such line to its last. So a line goes if it and its neighbour stand together earlier, whatever surrounds them; the
    chunk's first occurrence is no reason to remove it, and no line's last copy goes. Passages of one line stay.

    A text may end up empty; no row is lost. A null text stays null, and rows with a null key are neither changed nor
    counted. Rows that share a key and a text count as one. A column named like ``removed`` is replaced, others pass
    unchanged. An empty table stays one.
    """
    docs = docs.drop(removed)
    own = docs.select(F.col(key).alias("doc"), F.col(text).alias("text")).where("doc is not null and text is not null")
    light = materialise(_listed(own, with_bytes=False, one_in=one_in), "light")
    again = materialise(light.groupBy("hash").count().where("count > 1").select("hash"), "hashes")
    repeats = materialise(split_by_keys(light, "hash", again, "hash")[0].join(again, "hash", "left_semi"), "repeats")
    holders = materialise(repeats.select("doc").distinct(), "holders")
    held = split_by_keys(own, "doc", holders, "doc")[0]
    # Groups of equal bytes: the byte comparison. Chunks that only pass the filter are alone in theirs.
    found = split_by_keys(_listed(held, with_bytes=True, one_in=one_in), "hash", again, "hash")[0]
    groups = found.groupBy("hash", "chunk").agg(F.min(F.struct("doc", "n")).alias("first"))
    spoken = F.col("chunk").cast("string")
    last = F.length(spoken) - F.length(F.translate(spoken, "\n", "")) + F.col("first.n")
    groups = groups.withColumn("last", last)
    # Where a hash has one group, the hash stands for the bytes; else the bytes are looked at again.
    by_hash = groups.groupBy("hash").agg(F.min("first").alias("first"), F.min("last").alias("last"), F.count("*").alias("kinds"))
    by_hash = materialise(by_hash.join(again, "hash", "left_semi"), "first")
    plain = repeats.join(by_hash.where("kinds = 1"), "hash").select("doc", "n", "hash", "first", "last")
    mixed = by_hash.where("kinds > 1").select("hash")
    firsts = groups.join(mixed, "hash", "left_semi")
    unlike = found.join(mixed, "hash", "left_semi").join(firsts, ["hash", "chunk"]).select("doc", "n", "hash", "first", "last")
    if not mixed.isEmpty():
        plain = plain.union(unlike)
    later = plain.where("struct(doc, n) != first")
    # A chunk that starts with the last line of its first occurrence leaves that line to it.
    shares = F.expr("doc = first.doc and n = last").alias("shares")
    listed, same = fresh(docs, "listed"), fresh(docs, "doc")
    gone = later.select(F.col("doc").alias(same), "n", "hash", shares)
    gone = materialise(gone.groupBy(same).agg(F.collect_set(F.struct("n", "hash", "shares")).alias(listed)), "gone")
    touched, rest = split_by_keys(docs, key, gone, same)
    rows = touched.join(gone, F.col(key) == F.col(same), "left").drop(same)
    both = fresh(rows, "both")
    rows = rows.withColumn(both, F.struct(F.col(text).alias("text"), F.col(listed).alias("listed")))

    def work(rows: pa.Array) -> dict[str, pa.Array]:
        texts, numbers = [], []
        for row in rows.to_pylist():
            t, dropped = row["text"], set()
            if t is not None and row["listed"]:
                wanted = {(x["n"], x["hash"]): x["shares"] for x in row["listed"]}
                for n, h, chunk in line_chunks(t, one_in):
                    if (shared := wanted.get((n, h))) is not None:
                        dropped.update(range(n + shared, n + 1 + chunk.count(b"\n")))
                t = "\n".join(line for n, line in enumerate(t.split("\n")) if n not in dropped)
            texts.append(t)
            numbers.append(sorted(dropped))
        return {text: pa.array(texts, pa.string()), removed: pa.array(numbers, pa.list_(pa.int32()))}

    made = with_columns(rows, both, {text: "string", removed: "array<int>"}, work, size_by=text)
    return made.select(*docs.columns, removed).union(rest.withColumn(removed, F.array().cast("array<int>")))
