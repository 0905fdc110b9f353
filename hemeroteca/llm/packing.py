"""Harmonic packing of tokenised documents into sequences.

Lengths fall into reciprocal-capacity classes: class k holds the pieces of more than capacity/(k+1) and at most
capacity/k tokens, and each of its sequences takes exactly k of them. No class needs to know of another, and no
task of another, so packing is one narrow pass. Documents may be cut, so a document is cut into lengths that fill
their class's sequences up to ``slack``. What a task's open sequences hold at its end is laid end to end and cut
anew at the capacity; the last rest is cut at powers of two, which need no padding.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from hemeroteca.llm.batches import give_back, slices
from hemeroteca.llm.bpe import word_encoder

#: Rows are handed on in batches of about this many bytes of ids.
FLUSH_BYTES = 8 << 20
#: Sequence numbers of a task start at its partition number times this.
SEQUENCES_PER_TASK = 1 << 40


@cache
def cut_lengths(capacity: int, slack: int) -> tuple[int, ...]:
    """For each length up to ``capacity``: the longest piece not above it that fills its class up to ``slack``."""
    out = [0]
    for length in range(1, capacity + 1):
        fills = capacity // length * length >= capacity - slack
        out.append(length if fills or length == 1 else out[-1])
    return tuple(out)


def cuts(tokens: int, capacity: int, slack: int) -> Iterator[tuple[int, int]]:
    """(start, length) of a document's pieces, the full sequences first."""
    best, start = cut_lengths(capacity, slack), 0
    while start < tokens:
        length = best[min(tokens - start, capacity)]
        yield start, length
        start += length


def fill(documents, capacity: int, slack: int) -> Iterator[list[tuple]]:
    """Sequences, each a list of (doc_id, start, ids, doc_tokens), from (doc_id, ids) with 4 bytes an id."""
    open_ones: dict[int, list[tuple]] = {}
    for doc_id, ids in documents:
        tokens = len(ids) // 4
        for start, length in cuts(tokens, capacity, slack):
            k = capacity // length
            own = open_ones.setdefault(k, [])
            own.append((doc_id, start, ids[4 * start : 4 * (start + length)], tokens))
            if len(own) == k:
                yield open_ones.pop(k)
    rest = [piece for k in sorted(open_ones) for piece in open_ones[k]]
    left = sum(len(p[2]) // 4 for p in rest)
    full, short = divmod(left, capacity)
    room = [capacity] * full + [1 << b for b in reversed(range(short.bit_length())) if short >> b & 1]
    pieces = iter(rest)
    piece = next(pieces, None)
    for size in room:
        sequence = []
        while size:
            doc_id, start, ids, tokens = piece
            taken = min(size, len(ids) // 4)
            sequence.append((doc_id, start, ids[: 4 * taken], tokens))
            size -= taken
            piece = (doc_id, start + taken, ids[4 * taken :], tokens) if 4 * taken < len(ids) else next(pieces, None)
        yield sequence


def pack(
    docs: DataFrame, tokenizer: str, end_id: int, capacity: int = 2048, slack: int = 16, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Pieces of all documents, placed in sequences of at most ``capacity`` tokens.

    Columns: the key, ``start`` (ids of the document before the piece), ``length``, ``token_bytes`` (32-bit
    little-endian ids), ``doc_tokens`` (with the end id), ``sequence_id`` and ``offset`` in it. A null or empty
    text is the end id alone. Repeated rows are packed each. Other columns are left out. An empty table gives no
    rows. A sequence is short of ``capacity`` by ``slack`` at most or its length is a power of two. A task that
    runs again gives the same rows, as it reads the same ones in the same order.
    """
    rows = docs.select(key, text)
    schema = T.StructType([rows.schema[0], *T.StructType.fromDDL(
        "start long, length long, token_bytes binary, doc_tokens long, sequence_id long, offset long").fields])
    end = end_id.to_bytes(4, "little")

    def run(batches):
        kinds = {}
        first = TaskContext.get().partitionId() * SEQUENCES_PER_TASK

        def documents():
            encoder = word_encoder(tokenizer)
            for batch in batches:
                kinds["key"] = batch.schema.field(0).type
                for part in slices(batch, text):
                    for doc_id, t in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                        yield doc_id, (encoder.encode(t) if t else b"") + end

        def table(held):
            columns = list(zip(*held, strict=True))
            types = [kinds["key"], pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=schema.names)

        def batches_of_pieces():
            held, size = [], 0
            for number, sequence in enumerate(fill(documents(), capacity, slack), first):
                offset = 0
                for doc_id, start, ids, tokens in sequence:
                    held.append((doc_id, start, len(ids) // 4, ids, tokens, number, offset))
                    offset += len(ids) // 4
                size += 4 * offset
                if size >= FLUSH_BYTES:
                    yield table(held)
                    held, size = [], 0
            if held:
                yield table(held)

        try:
            yield from batches_of_pieces()
        finally:
            give_back(word_encoder)

    return rows.mapInArrow(run, schema)
