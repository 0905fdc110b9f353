"""Conversation prefix trie by vertical bitmaps.

Conversations are dealt to shards of neighbouring ids. A shard's index has one bitset of its conversations for each
(position, turn). A node is the bitset of the conversations that begin alike; and-ing it with the postings of the next
position gives its children, bit counts their sizes, and the bitset of conversations that end there its end list. A
depth-first walk over a shard takes each node once.

Shards are then brought together by a hash of each node's turns. What a subtree sums up is additive over shards once
every node has one owner, the lowest shard that holds it: (members - 1) x bytes, summed over distinct nodes, is
members x bytes over all shards' nodes less bytes over the owned ones. So shards send rows about nodes, and no
conversation, list of members, or subtree ever leaves its shard whole. Texts stay behind a hash and a length.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from hemeroteca.llm.batches import tidied
from hemeroteca.sources.writers import materialise

#: Neighbouring conversation ids in one shard, and so bits in a bitset.
SHARD_IDS = 256
FLUSH_ROWS = 20_000
ROOT = bytes(16)
NODES = (
    "key binary, parent binary, shard long, number long, up long, depth long, conv long, n_convs long, n_children long, "
    "size long, total long, ends array<long>"
)
SUMS = (
    "key binary, depth long, conv long, parent_conv long, n_convs long, n_children long, n_leaves long, saved long"
)


def numbered_turns(turns: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """(conv, n, code, size): turns in order, with a 128-bit hash of role and text and the text's UTF-8 bytes.

    Turns go by their number, null first; ones that tie in it, by their hash.
    """
    own_role, own_text = F.coalesce(F.col(role).cast("string"), F.lit("")), F.coalesce(F.col(text).cast("string"), F.lit(""))
    said = F.concat(F.octet_length(own_role).cast("string"), F.lit(":"), own_role, own_text)
    rows = turns.where(F.col(conv).isNotNull()).select(
        F.col(conv).cast("long").alias("conv"),
        F.col(turn).alias("turn"),
        F.unhex(F.substr(F.sha2(said, 256), F.lit(1), F.lit(32))).alias("code"),
        F.octet_length(own_text).cast("long").alias("size"),
    )
    order = W.partitionBy("conv").orderBy(F.asc_nulls_first("turn"), "code")
    return rows.withColumn("n", F.row_number().over(order).cast("long") - 1).drop("turn")


def shared(conv: Column, most: int) -> Column:
    """How many turns a conversation takes from its family's first one."""
    return F.crc32(conv.cast("string").cast("binary")) % (most + 1)


def rebuilt(turns: DataFrame, family: int, most: int) -> DataFrame:
    """(conv, n, code, size): every conversation's turns, in order of ``n``, and one row of n = -1 for each.

    A conversation c has the first h turns of conversation c - c % family, then its own after its first h.
    """
    stored = materialise(turns, "turns")
    head = F.when(F.col("n") < most, F.struct("n", "code", "size"))
    # A head is of at most ``most`` turns.
    convs = stored.groupBy("conv").agg(F.collect_list(F.when(F.col("conv") % family == 0, head)).alias("heads"))
    bases = convs.where(F.col("conv") % family == 0).select(F.col("conv").alias("base"), "heads")
    all_of = convs.select("conv", (F.col("conv") - F.col("conv") % family).alias("base")).join(bases, "base", "left")
    none = F.array().cast("array<struct<n:bigint,code:binary,size:bigint>>")
    taken = F.filter(F.coalesce("heads", none), lambda x: x["n"] < shared(F.col("conv"), most))
    mark = F.array(F.struct(F.lit(-1).cast("long").alias("n"), F.lit(ROOT).alias("code"), F.lit(0).cast("long").alias("size")))
    opening = all_of.select("conv", F.inline(F.concat(mark, taken)))
    return opening.union(stored.where(F.col("n") >= shared(F.col("conv"), most)).select("conv", "n", "code", "size"))


def walk(first: int, turns: dict[int, list[tuple[bytes, int]]]) -> Iterator[tuple]:
    """A shard's nodes, parents before children: key, parent's key, number, parent's number, depth, smallest member,
    members, children, bytes of the last text, ends. ``turns`` has the (code, size) of each conversation's turns."""
    bit_of = {conv: 1 << (conv - first) for conv in turns}
    postings: dict[tuple[int, bytes], int] = {}
    ends: dict[int, int] = {}
    for conv, own in turns.items():
        for place, (code, _) in enumerate(own):
            postings[place, code] = postings.get((place, code), 0) | bit_of[conv]
        ends[len(own)] = ends.get(len(own), 0) | bit_of[conv]
    number = 0
    waiting = [(sum(bit_of.values()), 0, ROOT, ROOT, -1, 0)]
    while waiting:
        members, depth, key, parent, up, size = waiting.pop()
        ending = members & ends.get(depth, 0)
        left, children = members & ~ending, 0
        while left:
            code, length = turns[first + (left & -left).bit_length() - 1][depth]
            child = left & postings[depth, code]
            left &= ~child
            children += 1
            waiting.append((child, depth + 1, hashlib.blake2b(key + code, digest_size=16).digest(), key, number, length))
        lowest = first + (members & -members).bit_length() - 1
        yield key, parent, number, up, depth, lowest, members.bit_count(), children, size, _listed(ending, first)
        number += 1


def _listed(bits: int, first: int) -> list[int]:
    out = []
    while bits:
        out.append(first + (bits & -bits).bit_length() - 1)
        bits &= bits - 1
    return out


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        for at in range(0, batch.num_rows, FLUSH_ROWS):
            yield from zip(*(c.to_pylist() for c in batch.slice(at, FLUSH_ROWS).columns), strict=True)


def _batches(rows: Iterator[tuple], kinds: list[pa.DataType], names: list[str]) -> Iterator[pa.RecordBatch]:
    held = []
    for row in rows:
        held.append(row)
        if len(held) == FLUSH_ROWS:
            yield _batch(held, kinds, names)
            held = []
    if held:
        yield _batch(held, kinds, names)


def _batch(held: list[tuple], kinds: list[pa.DataType], names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*held, strict=True), kinds, strict=True)], names=names)


def _groups(rows: Iterator[tuple]) -> Iterator[tuple]:
    """(first value, rest of the rows) of each run of rows with one first value."""
    own, held = None, []
    for row in rows:
        if held and row[0] != own:
            yield own, held
            held = []
        own = row[0]
        held.append(row[1:])
    if held:
        yield own, held


def shard_nodes(turns: DataFrame) -> DataFrame:
    """The nodes of every shard's own trie; ``total`` is members x bytes, summed over the shard's subtree."""
    shard = F.expr(f"(conv - pmod(conv, {SHARD_IDS})) div {SHARD_IDS}").alias("shard")
    dealt = turns.select(shard, "conv", "n", "code", "size").repartition("shard").sortWithinPartitions("shard", "conv", "n")

    def run(batches):
        def nodes():
            for shard, rows in _groups(_rows(batches)):
                own: dict[int, list[tuple[bytes, int]]] = {}
                for conv, n, code, size in rows:
                    said = own.setdefault(conv, [])
                    if n >= 0:
                        said.append((code, size))
                made = list(walk(shard * SHARD_IDS, own))
                totals = [n_convs * size for *_, n_convs, _, size, _ in made]
                for i in range(len(made) - 1, 0, -1):
                    totals[made[i][3]] += totals[i]
                for (key, parent, number, up, depth, conv, n_convs, n_children, size, ends), total in zip(made, totals, strict=True):
                    yield key, parent, shard, number, up, depth, conv, n_convs, n_children, size, total, ends or None

        kinds = [pa.binary(), pa.binary(), *[pa.int64()] * 9, pa.list_(pa.int64())]
        yield from _batches(nodes(), kinds, [n.split()[0] for n in NODES.split(", ")])

    return dealt.mapInArrow(tidied(run), NODES)


def _owned_sums(nodes: DataFrame) -> DataFrame:
    """What each shard adds to its nodes: the leaves and children it owns, and the bytes saved."""
    owner = nodes.groupBy("key").agg(F.min("shard").alias("owner"), F.min("conv").alias("first"), F.max("n_children").alias("most"))
    known = nodes.join(owner, "key").select(
        "shard", "number", "up", "key", "depth", "first", "n_convs", "size", "total",
        (F.col("owner") == F.col("shard")).alias("owned"), (F.col("most") == 0).alias("leaf"),
    )
    dealt = known.repartition("shard").sortWithinPartitions("shard", "number")

    def run(batches):
        def sums():
            for _, rows in _groups(_rows(batches)):
                children, leaves, own = [0] * len(rows), [0] * len(rows), [0] * len(rows)
                for i in range(len(rows) - 1, -1, -1):
                    _, up, key, depth, first, n_convs, size, total, owned, leaf = rows[i]
                    leaves[i] += owned and leaf
                    own[i] += size if owned else 0
                    if i:
                        children[up] += owned
                        leaves[up] += leaves[i]
                        own[up] += own[i]
                for i, (_, up, key, depth, first, n_convs, _, total, *_) in enumerate(rows):
                    parent = rows[up][4] if i else None
                    yield key, depth, first, parent, n_convs, children[i], leaves[i], total - own[i]

        kinds = [pa.binary(), *[pa.int64()] * 7]
        yield from _batches(sums(), kinds, [n.split()[0] for n in SUMS.split(", ")])

    return dealt.mapInArrow(tidied(run), SUMS)


def _end_lists(nodes: DataFrame) -> DataFrame:
    """(key, ends_sha256) of the nodes where conversations end; ids are hashed as they pass, not gathered."""
    listed = nodes.where("ends is not null").select("key", "shard", "ends")
    dealt = listed.repartition("key").sortWithinPartitions("key", "shard")

    def run(batches):
        def hashes():
            key, running = None, None
            for own, _, ends in _rows(batches):
                ids = ",".join(map(str, ends))
                if own == key:
                    running.update(f",{ids}".encode())
                    continue
                if running is not None:
                    yield key, running.hexdigest()
                key, running = own, hashlib.sha256(ids.encode())
            if running is not None:
                yield key, running.hexdigest()

        yield from _batches(hashes(), [pa.binary(), pa.string()], ["key", "ends_sha256"])

    return dealt.mapInArrow(tidied(run), "key binary, ends_sha256 string")


def trie(
    turns: DataFrame, family: int = 5, most: int = 8, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """One row for each distinct beginning of the rebuilt conversations, the empty one included.

    Every conversation c is rebuilt: the first h turns of conversation c - c % family (all if there are fewer, none if
    there is no such conversation), then c's own turns after its first h, where h is crc32 of the decimal c, modulo
    ``most`` + 1. The remainder takes the sign of c, as in SQL. Columns: the id of the smallest conversation that
    begins so, ``depth``, ``parent_conv_id`` (null at the root), ``n_convs``, ``n_children``, ``n_leaves`` (nodes without
    children in the subtree), ``saved_tokens`` (over the subtree: members but one, times the last text's UTF-8 bytes)
    and ``ends_sha256`` (of the ids of the conversations that end there, ascending, joined by commas).

    Rows with a null conversation don't count; a null role or text is empty; repeated rows are turns of their own.
    Turns that tie in their number go by a hash of what was said. Other columns are left out. An empty table has no
    conversation and gives no rows. Two turns are alike if 128 bits of their SHA-256 are. A conversation's turns meet
    in one task, as hashes: 24 bytes and a length a turn.
    """
    nodes = materialise(shard_nodes(rebuilt(numbered_turns(turns, conv, turn, role, text), family, most)), "nodes")
    names = ("n_convs", "n_children", "n_leaves", "saved")
    sums = _owned_sums(nodes).groupBy("key").agg(
        F.min("depth").alias("depth"), F.min("conv").alias("conv"), F.min("parent_conv").alias("parent"), *[F.sum(n).alias(n) for n in names]
    )
    found = sums.join(_end_lists(nodes), "key", "left")
    return found.select(
        F.col("conv").alias(conv),
        "depth",
        F.col("parent").alias(f"parent_{conv}"),
        "n_convs",
        "n_children",
        "n_leaves",
        F.col("saved").alias("saved_tokens"),
        F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"),
    )
