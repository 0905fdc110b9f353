"""Arrow batches through Python, with every other column carried along."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator
from functools import reduce

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hemeroteca.operators.prefilter import held_in_groups

#: Batches are worked on in slices of about this much text, so that what a worker holds doesn't follow the batch.
SLICE_BYTES = 4 << 20


def fresh(df: DataFrame, name: str) -> str:
    """``name``, or ``name`` with underscores that make it unlike all columns."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def split_by_keys(rows: DataFrame, key: str, keys: DataFrame, own: str) -> tuple[DataFrame, DataFrame]:
    """(rows whose key may be among ``keys.own``, all other rows), by Bloom filters of 8 MB at most.

    A join with the keys need only shuffle the first part; the others stay where they lie. ``keys`` is stored. More
    keys than a filter holds are met in groups, each of which reads the rows.
    """
    groups = held_in_groups(keys, own, F.col(key))
    parts = [(rows.where(mine & held), rows.where(mine & ~held)) for mine, held in groups]
    return tuple(reduce(DataFrame.union, side) for side in zip(*parts, strict=True))


def give_back(*caches) -> None:
    """Empty the caches and hand free memory back, at a task's end.

    A worker lives on for later tasks and other stages, several in one executor; what it doesn't need there would add up.
    """
    for cache in caches:
        cache.cache_clear()
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def tidied(run: Callable) -> Callable:
    """``run`` over batches, with memory given back at the task's end."""

    def wrapped(batches):
        try:
            yield from run(batches)
        finally:
            give_back()

    return wrapped


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in consecutive slices of about ``limit`` bytes of ``column``; each has a row at least."""
    column = batch.column(column)
    if pa.types.is_list(column.type):
        sizes = [4 * (n or 0) for n in pc.list_value_length(column).to_pylist()]
    else:
        sizes = [n or 0 for n in pc.binary_length(column).to_pylist()]
    start = held = 0
    for i, size in enumerate(sizes):
        if held and held + size > limit:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += size
    if start < len(sizes):
        yield batch.slice(start)


def with_columns(
    df: DataFrame,
    read: str,
    made: dict[str, str],
    work: Callable[[pa.Array], dict[str, pa.Array]],
    size_by: str | None = None,
    drop: tuple[str, ...] = (),
    limit: int = SLICE_BYTES,
    caches: tuple = (),
) -> DataFrame:
    """Like ``withColumns``: ``work`` makes the columns ``made`` (name to DDL type) from the column ``read``.

    A column of that name, in any case of letters, is replaced. ``work`` runs in the executors, once a slice of about
    ``limit`` bytes of ``size_by`` (else of ``read``). Columns in ``drop`` are read and left out. ``caches`` that ``work``
    fills are emptied at a task's end.
    """
    out = {name.lower() for name in (*made, *drop)}
    keep = [f for f in df.schema.fields if f.name.lower() not in out]
    new = T.StructType.fromDDL(", ".join(f"`{name}` {kind}" for name, kind in made.items()))
    schema = T.StructType(keep + new.fields)
    kept = [f.name for f in keep]

    def run(batches):
        try:
            for batch in batches:
                for part in slices(batch, size_by or read, limit):
                    out = work(part.column(read))
                    arrays = [part.column(c) for c in kept] + [out[c] for c in made]
                    yield pa.RecordBatch.from_arrays(arrays, names=kept + list(made))
        finally:
            give_back(*caches)

    return df.mapInArrow(run, schema)
