"""Bloom filters over key sets, to thin out a big table where it lies."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hemeroteca.session import scratch_path

#: Bits of one bitmap of Spark's bitmap functions.
_BITMAP = 32_768
#: One filter never exceeds 8 MB; a longer key set is split into groups that have a filter each.
MOST_BITMAPS = 2_048
BITS_PER_KEY, HASHES = 12, 4
#: Groups are dealt by hash, so they are planned at this share of what a filter holds.
FILL = 0.75


def keys_per_filter() -> int:
    """Keys that a filter of the greatest size holds at a few false hits in a hundred."""
    return MOST_BITMAPS * _BITMAP // BITS_PER_KEY


class KeyFilter:
    """``may_hold`` is true for every key of the set, and for few others."""

    def __init__(self, keys: DataFrame, key: str, count: int | None = None):
        """``keys`` is read twice, or once if their ``count`` is given; hand in a stored table."""
        count = keys.count() if count is None else count
        self.bitmaps = min(MOST_BITMAPS, max(1, -(-count * BITS_PER_KEY // _BITMAP)))
        at = keys.where(F.col(key).isNotNull()).select(F.explode(self._positions(F.col(key))).alias("at"))
        made = at.groupBy(F.expr(f"at div {_BITMAP}").alias("n")).agg(F.bitmap_construct_agg(F.col("at") % _BITMAP).alias("bits"))
        found = {r["n"]: bytes(r["bits"]) for r in made.collect()}  # MOST_BITMAPS rows of 4 KB at most
        self.bits = b"".join(found.get(n, bytes(_BITMAP // 8)) for n in range(self.bitmaps))

    def _positions(self, key: Column) -> Column:
        return F.array(*[F.pmod(F.xxhash64(key, F.lit(i)), F.lit(self.bitmaps * _BITMAP)) for i in range(HASHES)])

    def may_hold(self, key: Column) -> Column:
        """One copy of the bits is in the expression, whatever the number of hashes. A null key isn't held."""

        def is_set(at: Column) -> Column:
            byte = F.conv(F.hex(F.substr(F.lit(self.bits), F.shiftright(at, 3).cast("int") + 1, F.lit(1))), 16, 10)
            return F.getbit(byte.cast("int"), (at % 8).cast("int")) == 1

        return key.isNotNull() & F.forall(self._positions(key), is_set)


def _groups(count: int) -> int:
    return -(-count // int(keys_per_filter() * FILL)) if count > keys_per_filter() else 1


def held_in_groups(keys: DataFrame, key: str, bears: Column) -> list[tuple[Column, Column]]:
    """(which rows are in the group, whether such a row may bear one of the keys) for each group of a key set.

    Groups are dealt by a hash of the key, which rows have in ``bears``; every row is in one. A set that fits one
    filter is one group. Hand in stored keys.
    """
    count = keys.count()
    groups = _groups(count)
    if groups == 1:
        return [(F.lit(True), KeyFilter(keys, key, count).may_hold(bears))]

    def own(column: Column) -> Column:
        return F.pmod(F.xxhash64(F.lit(-1), column), F.lit(groups))

    return [(own(bears) == n, KeyFilter(keys.where(own(F.col(key)) == n), key).may_hold(bears)) for n in range(groups)]


def kept_by_keys(rows: DataFrame, keys: DataFrame, key: str, by: str | None = None) -> DataFrame:
    """The rows whose ``key`` is in ``keys``, and a few others, without a shuffle of the rows.

    One filter holds so many keys. A longer set is met in groups: rows are dealt by a hash of the column ``by`` (the
    file they come from; else the key itself), each group's filter holds only the keys that its rows bear, and the
    parts are put together again. So no filter passes 8 MB and the share of false hits doesn't grow with the keys.
    For this the rows are read once more, but only ``by`` and ``key`` of them; if ``by`` is the source's
    ``_metadata.file_path``, each group reads its own files alone, so no other column is read twice. Hand in stored,
    distinct keys.
    """
    count = keys.count()
    groups = _groups(count)
    if groups == 1 or by is None:
        return reduce(DataFrame.unionAll, [rows.where(own & held) for own, held in held_in_groups(keys, key, F.col(key))])
    group = F.pmod(F.xxhash64(F.col(by)), F.lit(groups))
    borne = rows.select(key, group.alias("_group")).join(keys.select(key), key, "left_semi").distinct()
    path = scratch_path(rows.sparkSession, "borne")
    borne.write.partitionBy("_group").parquet(path)
    borne = rows.sparkSession.read.parquet(path)
    counts = {r["_group"]: r["count"] for r in borne.groupBy("_group").count().collect()}  # a row a filter
    parts = [
        rows.where((group == n) & KeyFilter(borne.where(F.col("_group") == n), key, counts[n]).may_hold(F.col(key)))
        for n in sorted(counts)
    ]
    return reduce(DataFrame.unionAll, parts) if parts else rows.where("false")
