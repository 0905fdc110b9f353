"""Sharding by a permutation-filled lookup table.

Every shard has its own order of preference over the slots of a table of prime size. Shards take turns, each
claiming the first slot of its order that is still free, until none is left; so all shards hold the same number
of slots, give or take one, and withdrawing a shard moves little but its own slots. The table has a fixed number
of rows whatever the data, so it is broadcast, and a row is placed by one look-up.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hemeroteca.llm.batches import fresh

#: A prime, far more slots than shards.
SLOTS = 65_537
#: Hexadecimal digits of an MD5 that are read as a number; they fit a long.
DIGITS = 15


def _number(text: str) -> int:
    return int(hashlib.md5(text.encode()).hexdigest()[:DIGITS], 16)


def fill_slots(shards: list[str], slots: int = SLOTS) -> list[int]:
    """The shard (its place in ``shards``) that owns each slot. The names alone decide the orders of preference."""
    if not 0 < len(shards) <= slots or len(set(shards)) < len(shards):
        raise ValueError("one name or more, all different, and no more than slots")
    if any(slots % d == 0 for d in range(2, int(slots**0.5) + 1)) or slots < 2:
        raise ValueError("the number of slots must be a prime")
    at = [_number(f"offset {name}") % slots for name in shards]
    step = [_number(f"skip {name}") % (slots - 1) + 1 for name in shards]
    owner, free = [-1] * slots, slots
    while free:
        for shard in range(len(shards)):
            while owner[at[shard]] >= 0:
                at[shard] = (at[shard] + step[shard]) % slots
            owner[at[shard]] = shard
            free -= 1
            if not free:
                break
    return owner


def slot_of(key: Column, slots: int = SLOTS) -> Column:
    """The slot of a key of any type, by its text; null is placed like empty text."""
    digest = F.substring(F.md5(F.coalesce(key.cast("string"), F.lit(""))), 1, DIGITS)
    return F.pmod(F.conv(digest, 16, 10).cast("long"), F.lit(slots))


def slot_table(spark: SparkSession, owner: list[int], slot: str = "slot", shard: str = "shard") -> DataFrame:
    """The look-up table: one row a slot."""
    owners = F.split(F.lit(",".join(map(str, owner))), ",").cast("array<int>")
    rows = spark.range(1).select(F.posexplode(owners).alias(slot, shard))
    return rows.select(F.col(slot).cast("long").alias(slot), shard)


def place(rows: DataFrame, key: str, shards: list[str], slots: int = SLOTS, shard: str = "shard") -> DataFrame:
    """Add ``shard``, the place in ``shards`` of each row's shard. A column of that name is replaced.

    Rows of one key share a shard; every row is placed, one with a null key like one with empty text. A key that
    holds a third of the rows makes its shard that large: place by an identifier to have even shards.
    """
    rows = rows.drop(shard)
    slot, owner = fresh(rows, "slot"), fresh(rows, "owner")
    lookup = slot_table(rows.sparkSession, fill_slots(shards, slots), slot, owner)
    placed = rows.withColumn(slot, slot_of(F.col(f"`{key}`"), slots)).join(F.broadcast(lookup), slot)
    return placed.drop(slot).withColumnRenamed(owner, shard)
