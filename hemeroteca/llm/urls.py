"""URL filters: host and path rules, and a Bloom filter cascade for listed hosts.

A Bloom filter of the listed keys lets a few unlisted ones through. Which ones is known, as the corpus's keys are
all known; a second filter encodes those, lets a few listed ones through, and so on in turn, until a level lets
none through. Going down the levels then tells listed from unlisted for every key of the corpus, without error
and without a join.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hemeroteca.llm.batches import fresh
from hemeroteca.sources.writers import materialise

#: Bits of a bitmap that the bitmap functions make: 4 KB.
BITMAP_BITS = 32_768
#: Filters of one cascade are planned to have this many bytes at most; more keys are dealt to several cascades.
MOST_FILTER_BYTES = 8 << 20
#: Share of unlisted keys that pass a level of 12 bits a key and 4 hashes, with room to spare.
PASSING = 0.03
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _rest(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substr(url, at + 3))


def host(url: Column) -> Column:
    """What stands between the first ``://`` and ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return F.coalesce(F.translate(F.regexp_extract(_rest(url), "^[^/?#]*", 0), UPPER, LOWER), F.lit(""))


def path(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; else empty."""
    return F.coalesce(F.regexp_extract(_rest(url), "^[^/?#]*([^?#]*)", 1), F.lit(""))


def first_fit(rules: list[tuple[str, str]], host: Column, path: Column) -> Column:
    """(rule, verdict) of the longest rule ``host/path`` that fits the host or a parent domain of it, and the path's start."""
    fits = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, rule in sorted(rules, key=lambda r: (len(r[1]), r[1].index("/"), r[0])):
        own_host, _, own_path = rule.partition("/")
        domain = (host == own_host) | host.endswith(f".{own_host}")
        own = F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))
        fits = F.when(domain & path.startswith(f"/{own_path}"), own).otherwise(fits)
    return fits


class Level:
    """One Bloom filter: bits of ``keys`` under ``hashes`` functions of its own seed, held as bytes."""

    def __init__(self, keys: DataFrame, count: int, seed: int, bits_per_key: int, hashes: int):
        self.seed, self.hashes = seed, hashes
        self.bitmaps = -(-count * bits_per_key // BITMAP_BITS)
        self.bits = self.bitmaps * BITMAP_BITS
        at = keys.select(F.explode(self.positions(F.col("key"))).alias("at"))
        made = at.groupBy(F.expr(f"at div {BITMAP_BITS}").alias("n")).agg(
            F.bitmap_construct_agg(F.col("at") % BITMAP_BITS).alias("bitmap")
        )
        found = {r["n"]: bytes(r["bitmap"]) for r in made.collect()}  # as many rows as the checked size has bitmaps
        self.bytes = b"".join(found.get(n, bytes(BITMAP_BITS // 8)) for n in range(self.bitmaps))

    def positions(self, key: Column) -> Column:
        return F.array(*[F.pmod(F.xxhash64(F.lit(self.seed), F.lit(i), key), F.lit(self.bits)) for i in range(self.hashes)])

    def holds(self, key: Column) -> Column:
        """Whether all bits of the key are set; the expression has the bits once, whatever the number of hashes."""
        return F.forall(self.positions(key), self.bit)

    def bit(self, at: Column) -> Column:
        """Whether the bit is set; a bitmap's bytes are filled from the lowest bit."""
        byte = F.conv(F.hex(F.substr(F.lit(self.bytes), F.shiftright(at, 3).cast("int") + 1, F.lit(1))), 16, 10)
        return F.getbit(byte.cast("int"), (at % 8).cast("int")) == 1


class Cascade:
    """Exact membership in ``listed`` for every key of ``universe``.

    Keys are dealt by hash to as many groups as keep each group's filters to ``MOST_FILTER_BYTES``; each has its own
    levels. So the filters of a group are bounded whatever the number of keys, and no list is joined with the rows.
    """

    def __init__(self, listed: DataFrame, universe: DataFrame, bits_per_key: int = 12, hashes: int = 4):
        """Both have the one column ``key``; nulls don't count. Listed keys outside the universe don't matter."""
        known = materialise(universe.where("key is not null").distinct(), "universe")
        wanted = materialise(listed.where("key is not null").distinct(), "listed")
        keys = wanted.count() + PASSING * known.count()
        self.groups = max(1, -(-int(keys * bits_per_key / 8) // MOST_FILTER_BYTES))
        self.bits_per_key, self.hashes = bits_per_key, hashes
        self.levels = [self._built(wanted.where(self.of(F.col("key")) == n), known.where(self.of(F.col("key")) == n)) for n in range(self.groups)]

    def of(self, key: Column) -> Column:
        """The key's group."""
        return F.pmod(F.xxhash64(F.lit(-1), key), F.lit(self.groups))

    def _built(self, wanted: DataFrame, known: DataFrame) -> list[Level]:
        """The levels of one group. Only the keys that pass the first level are told apart by a join."""
        count = wanted.count()
        if not count:
            return []
        levels = [Level(wanted, count, 0, self.bits_per_key, self.hashes)]
        passed = known.where(levels[0].holds(F.col("key"))).join(wanted.withColumn("listed", F.lit(True)), "key", "left")
        passed = materialise(passed.select("key", F.coalesce("listed", F.lit(False)).alias("listed")), "passed")
        inside, outside = passed.where("not listed"), passed.where("listed")
        while count := inside.count():
            level = Level(inside, count, len(levels), self.bits_per_key, self.hashes)
            levels.append(level)
            inside, outside = outside.where(level.holds(F.col("key"))), inside
        return levels

    @staticmethod
    def _holds(levels: list[Level], key: Column) -> Column:
        out = F.lit(len(levels) % 2 == 1)
        for depth in range(len(levels), 0, -1):
            out = F.when(~levels[depth - 1].holds(key), F.lit(depth % 2 == 0)).otherwise(out)
        return out

    def mark(self, rows: DataFrame, key: Column, name: str) -> DataFrame:
        """Add the boolean ``name``: whether a key of the universe is listed. A null key isn't."""
        if self.groups == 1:
            return rows.withColumn(name, F.coalesce(self._holds(self.levels[0], key), F.lit(False)))
        # Each group reads the rows; those without a key are in the group of null.
        own = F.coalesce(self.of(key), F.lit(0))
        parts = [rows.where(own == n).withColumn(name, F.coalesce(self._holds(levels, key), F.lit(False))) for n, levels in enumerate(self.levels)]
        return reduce(DataFrame.unionAll, parts)


def judge(pages: DataFrame, rules: list[tuple[str, str]], listed: DataFrame, url: str = "url", blocked: str = "block", other: str = "allow") -> DataFrame:
    """Add ``host``, ``path``, ``rule`` and ``verdict`` to pages; columns of these names are replaced.

    The longest fitting rule decides; where none fits, a host in ``listed`` (column ``key``) gets ``blocked`` and
    any other one ``other``. A url that is null or has no ``://`` has an empty host and path: no rule fits it, and
    it's judged by whether the empty host is listed. Every row comes back once, repeated rows included.
    """
    own = pages.drop("host", "path", "rule", "verdict") if url not in ("host", "path") else pages
    address = F.col(f"`{url}`")
    fit, hit = fresh(own, "fit"), fresh(own, "listed")
    parsed = own.withColumns({"host": host(address), "path": path(address)})
    hosts = parsed.select(F.col("host").alias("key"))
    cascade = Cascade(listed, hosts)
    marked = cascade.mark(parsed.withColumn(fit, first_fit(rules, F.col("host"), F.col("path"))), F.col("host"), hit)
    verdict = F.coalesce(F.col(f"{fit}.verdict"), F.when(F.col(hit), blocked).otherwise(other))
    return marked.withColumns({"rule": F.col(f"{fit}.rule"), "verdict": verdict}).drop(fit, hit)
