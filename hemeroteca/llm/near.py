"""Near-duplicates by SetSketch registers.

A document's set of word shingles becomes registers: each is the smallest of the set's hashes under a function
of its own, put on an exponential scale and cut to a small whole number. Registers of a union are the larger
ones of the parts', and equal registers are about as frequent as two sets are alike. Bands of registers pick
candidates; the likelihood of all registers of a pair, given the two set sizes, drops hopeless ones; what is left
is confirmed on the full sets.

Copies are folded into one representative before bands are made. In a bucket every member is tried against the
smallest one, so a bucket of near copies costs its size, not its square. Those that stay apart may still be alike
to other members. Two sets that are 75 % alike share one of their rarest shingles, so the nodes of such buckets
are ordered by those: first all that share a rare shingle are tried against the one in which it stands earliest,
then what is still apart against whatever it shares a rare shingle with. No pair that could join two components
goes untried.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hemeroteca.llm.batches import slices, split_by_keys, tidied
from hemeroteca.sources.writers import materialise

WORDS = 5
#: Least likeness of linked documents, as a fraction.
ALIKE = (75, 100)
#: 48 bands of 5 registers miss a pair of likeness 0.75 with a chance of 2e-6.
BANDS, BAND_REGISTERS = 48, 5
REGISTERS = BANDS * BAND_REGISTERS
#: Base of the exponential scale. Close to 1, registers of unlike sets are seldom equal by chance.
BASE = 1.01
RATE = 20.0
#: Pairs are dropped if they are e^-20 times less likely at any likeness that links than at the best other one.
IMPLAUSIBLE = 20.0
_RND = np.random.Generator(np.random.PCG64(20))
_FACTORS = (_RND.integers(0, 2**32, REGISTERS, dtype=np.uint32) | 1)[:, None]
_SHIFTS = _RND.integers(0, 2**32, REGISTERS, dtype=np.uint32)[:, None]
_PLACES = _RND.integers(0, 2**63, WORDS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BLOCK = 1024


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(text: str | None) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's five-word shingles; of all words as one if there are fewer."""
    words = text.encode().lower().split() if text else []  # bytes: ASCII white space and A-Z alone
    n = len(words)
    if not n:
        return np.empty(0, np.uint64)
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, n)
    if n < WORDS:
        return _mix(np.atleast_1d((hashes * _PLACES[:n]).sum(dtype=np.uint64) + np.uint64(n)))
    out = hashes[: n - WORDS + 1] * _PLACES[0]
    for i in range(1, WORDS):
        out += hashes[i : n - WORDS + 1 + i] * _PLACES[i]
    return np.unique(_mix(out))


def registers(hashes: np.ndarray) -> np.ndarray:
    """SetSketch registers of a set that isn't empty."""
    high = (hashes >> np.uint64(32)).astype(np.uint32)
    least = np.full(REGISTERS, 2**32 - 1, np.uint32)
    for at in range(0, len(high), _BLOCK):
        np.minimum(least, (high[at : at + _BLOCK] * _FACTORS + _SHIFTS).min(axis=1), out=least)
    waits = -np.log1p(-(least + 0.5) / 2**32) / RATE
    return np.clip(np.floor(1 - np.log(waits) / math.log(BASE)), 0, 2**16 - 1).astype(">u2")


def sketch(docs: DataFrame, key: str, text: str) -> DataFrame:
    """``doc_id``, ``n_shingles``, ``digest`` of the set (null if empty) and ``registers`` of each document."""

    def run(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                sizes, digests, sketches = [], [], []
                for t in part.column("text").to_pylist():
                    own = shingles(t)
                    sizes.append(len(own))
                    digests.append(xxhash.xxh3_128_digest(own.tobytes()) if len(own) else None)
                    sketches.append(registers(own).tobytes() if len(own) else None)
                arrays = [part.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()), pa.array(sketches, pa.binary())]
                yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "n_shingles", "digest", "registers"])

    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(tidied(run), "doc_id long, n_shingles long, digest binary, registers binary")


def _log_share(x: np.ndarray) -> np.ndarray:
    """p_b(x): how often one set's register is the larger, if it holds the share x of all that only it holds."""
    return -np.log1p(-x * (BASE - 1) / BASE) / math.log(BASE)


def plausible(n_a: np.ndarray, n_b: np.ndarray, larger: np.ndarray, smaller: np.ndarray, alike: float) -> np.ndarray:
    """Whether a likeness of ``alike`` or more isn't out of the question, given how many registers are larger or smaller."""
    u = n_a / (n_a + n_b)
    most = np.minimum(u, 1 - u) / np.maximum(u, 1 - u)
    able = most >= alike - 1e-9
    tried = np.linspace(0, 1, 201)[None, :] * most[:, None]
    tried = np.hstack([tried, np.minimum(alike, most)[:, None]])
    up = np.maximum(_log_share(np.maximum(u[:, None] - (1 - u)[:, None] * tried, 0)), 1e-12)
    down = np.maximum(_log_share(np.maximum((1 - u)[:, None] - u[:, None] * tried, 0)), 1e-12)
    same = np.maximum(1 - up - down, 1e-12)
    equal = REGISTERS - larger - smaller
    likelihood = larger[:, None] * np.log(up) + smaller[:, None] * np.log(down) + equal[:, None] * np.log(same)
    best = likelihood.max(axis=1)
    linking = np.where(tried >= np.minimum(alike, most)[:, None] - 1e-9, likelihood, -np.inf).max(axis=1)
    return able & (linking >= best - IMPLAUSIBLE)


def _likely(pairs: DataFrame, nodes: DataFrame, alike: float) -> DataFrame:
    """Pairs (a, b) that the joint likelihood of their registers doesn't rule out."""
    a = nodes.select(F.col("node").alias("a"), F.col("n").alias("n_a"), F.col("registers").alias("r_a"))
    b = nodes.select(F.col("node").alias("b"), F.col("n").alias("n_b"), F.col("registers").alias("r_b"))

    def run(frames):
        for pdf in frames:
            for at in range(0, len(pdf), 2000):
                part = pdf.iloc[at : at + 2000]
                ra = np.frombuffer(b"".join(part["r_a"]), ">u2").reshape(-1, REGISTERS)
                rb = np.frombuffer(b"".join(part["r_b"]), ">u2").reshape(-1, REGISTERS)
                keep = plausible(
                    part["n_a"].to_numpy(float), part["n_b"].to_numpy(float), (ra > rb).sum(1), (ra < rb).sum(1), alike
                )
                yield part.loc[keep, ["a", "b"]]

    least, most = F.least("n_a", "n_b"), F.greatest("n_a", "n_b")
    sized = pairs.join(a, "a").join(b, "b").where(least * ALIKE[1] >= most * ALIKE[0])
    return sized.mapInPandas(tidied(run), "a long, b long")


def _confirmed(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """Pairs (a, b) whose full sets are alike."""
    a = texts.select(F.col("node").alias("a"), F.col("text").alias("t_a"))
    b = texts.select(F.col("node").alias("b"), F.col("text").alias("t_b"))

    def run(frames):
        last, own = None, None
        for pdf in frames:
            keep = np.zeros(len(pdf), bool)
            for i, (ta, tb) in enumerate(zip(pdf["t_a"], pdf["t_b"], strict=True)):
                if ta != last:
                    last, own = ta, shingles(ta)
                other = shingles(tb)
                both = len(np.intersect1d(own, other, assume_unique=True))
                keep[i] = ALIKE[1] * both >= ALIKE[0] * (len(own) + len(other) - both)
            yield pdf.loc[keep, ["a", "b"]]

    return pairs.join(b, "b").join(a, "a").mapInPandas(tidied(run), "a long, b long")


def _labels(links: DataFrame) -> DataFrame:
    """(node, label): the smallest node that a linked node can reach. Labels spread to neighbours, then jump."""
    both = links.select("a", "b").union(links.select(F.col("b"), F.col("a"))).distinct()
    both = materialise(both, "links")
    first = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("label"))
    labels = materialise(first.select("node", F.least("node", "label").alias("label")), "labels")
    while True:
        near = both.join(labels, F.col("b") == F.col("node")).groupBy("a").agg(F.min("label").alias("near"))
        spread = labels.join(near, F.col("node") == F.col("a")).select(
            "node", "label", F.least("label", "near").alias("target")
        )
        target = labels.select(F.col("node").alias("target"), F.col("label").alias("jumped"))
        jumped = spread.join(target, "target", "left").select(
            "node", F.coalesce(F.least("target", "jumped"), "target").alias("label"), F.col("label").alias("was")
        )
        stored = materialise(jumped, "labels")
        labels = stored.select("node", "label")
        if stored.where("label < was").isEmpty():
            return labels


def _prefixes(texts: DataFrame, chosen: DataFrame) -> DataFrame:
    """(node, n, token, at): each chosen node's rarest shingles and their places, rarest first in an order that all share.

    Only shingles of several chosen nodes are listed, and only as far as one of them could be the first that two
    linked sets share.
    """

    def run(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                sets = [shingles(t) for t in part.column("text").to_pylist()]
                ends = np.cumsum([0, *map(len, sets)], dtype=np.int32)
                values = np.concatenate([*sets, np.empty(0, np.uint64)]).view(np.int64)
                lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(values))
                yield pa.RecordBatch.from_arrays([part.column("node"), lists], names=["node", "tokens"])

    sets = texts.join(chosen, "node", "left_semi").mapInArrow(tidied(run), "node long, tokens array<long>")
    tokens = materialise(sets, "tokens").select("node", F.size("tokens").alias("n"), F.explode("tokens").alias("token"))
    often = materialise(tokens.groupBy("token").agg(F.count("*").alias("often")).where("often > 1"), "often")
    listed = tokens.join(often, "token").groupBy("node", "n").agg(F.sort_array(F.collect_list(F.struct("often", "token"))).alias("own"))
    alone = F.col("n") - F.size("own")  # shingles of no other node come before all others
    reach = F.greatest(F.floor(F.col("n") * (ALIKE[1] - ALIKE[0]) / ALIKE[1]) + 1 - alone, F.lit(0)).cast("int")
    placed = listed.select("node", "n", alone.alias("alone"), F.posexplode(F.slice("own", F.lit(1), reach)).alias("i", "own"))
    return placed.select("node", "n", F.col("own.token").alias("token"), (F.col("alone") + F.col("i")).alias("at"))


def _meetings(prefixes: DataFrame, labels: DataFrame, apart: DataFrame) -> DataFrame:
    """Pairs (a, b) of nodes in different components, one of them in ``apart``, whose first common shingle stands
    early enough in both for the sets to be alike."""
    t, both = ALIKE[0], ALIKE[0] + ALIKE[1]
    known = _labelled(prefixes, labels, "node", "label")

    def kind(n: Column) -> Column:  # sizes within 5 % or so
        return F.floor(F.log(n.cast("double")) / math.log(1.05))

    # With x's remaining shingles all common, y can have this many at most.
    most = F.floor((F.col("n") - F.col("at")) * both / t) - F.col("n")
    least = F.ceil(F.col("n") * t / ALIKE[1])
    x = known.join(apart, "node", "left_semi").where(most >= least)
    x = x.select(*[F.col(c).alias(f"x_{c}") for c in ("node", "n", "at", "label")], "token", F.explode(F.sequence(kind(least), kind(most))).alias("kind"))
    y = known.withColumn("kind", kind(F.col("n")))
    need = t * (F.col("n") + F.col("x_n"))
    early = (both * (F.col("n") - F.col("at")) >= need) & (both * (F.col("x_n") - F.col("x_at")) >= need)
    met = x.join(y, ["token", "kind"]).where(early & (F.col("label") != F.col("x_label")))
    return met.select(F.least("x_node", "node").alias("a"), F.greatest("x_node", "node").alias("b")).distinct()


def _labelled(rows: DataFrame, labels: DataFrame, node: str, label: str) -> DataFrame:
    """Add the component of ``node``, which is its own one if it isn't linked."""
    known = labels.select(F.col("node").alias("_known"), F.col("label").alias("_label"))
    joined = rows.join(known, F.col(node) == F.col("_known"), "left")
    return joined.withColumn(label, F.coalesce("_label", node)).drop("_known", "_label")


def classes(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row a document row: the key, ``n_shingles``, ``component_id`` and ``kept``.

    Documents are linked if their sets are alike to 75 % or more; a component is what links reach, named by its
    smallest key; ``kept`` marks the row that bears that key. A text without words is linked with nothing and kept.
    The key must be a whole number. Rows with one key are one document: their texts' links are all its links. A
    row with a null key takes its text's component if another row has that text; else it's kept and its component
    is null. Other columns are left out; an empty table gives no rows.
    """
    alike = ALIKE[0] / ALIKE[1]
    sketched = materialise(sketch(docs, key, text), "sketches")
    own = sketched.where("digest is not null and doc_id is not null")
    # Equal digests have equal sizes and registers, so any copy's will do: registers are shuffled once, a set's not a copy's.
    folded = own.groupBy("digest").agg(
        F.min("doc_id").alias("node"), F.any_value("n_shingles").alias("n"), F.any_value("registers").alias("registers")
    )
    nodes = materialise(folded, "nodes")
    least, nodes = nodes.select("digest", "node"), nodes.select("node", "n", "registers")
    size = 2 * BAND_REGISTERS
    band = F.transform(
        F.sequence(F.lit(0), F.lit(BANDS - 1)),
        lambda i: F.xxhash64(i, F.substr(F.col("registers"), i * size + 1, F.lit(size))),
    )
    banded = nodes.select("node", F.explode(band).alias("bucket"))
    shared = banded.groupBy("bucket").agg(F.min("node").alias("hub"), F.max("node").alias("last")).where("hub < last")
    shared = materialise(shared.select("bucket", "hub"), "buckets")
    members = materialise(banded.join(shared, "bucket").select("bucket", "node", "hub"), "members")
    # Filters keep all other texts and registers from being shuffled.
    involved = materialise(members.select("node").distinct(), "involved")
    worded = docs.select(F.col(key).cast("long").alias("node"), F.col(text).alias("text")).where("text is not null")
    likely, _ = split_by_keys(worded, "node", involved, "node")
    texts = materialise(likely.join(involved, "node", "left_semi"), "texts")
    sketched_nodes, _ = split_by_keys(nodes, "node", involved, "node")

    def confirmed(pairs: DataFrame, purpose: str) -> DataFrame:
        return materialise(_confirmed(_likely(pairs, sketched_nodes, alike), texts), purpose)

    def apart_from_hub(labels: DataFrame) -> DataFrame:
        placed = _labelled(_labelled(members, labels, "node", "label"), labels, "hub", "hub_label")
        return placed.where("label != hub_label")

    spokes = members.where("node > hub").select(F.col("hub").alias("a"), F.col("node").alias("b")).distinct()
    links = confirmed(spokes, "spokes")
    # Unlike texts of one key have nodes of their own, which that key links.
    unlike = own.groupBy("doc_id").agg(F.min("digest").alias("low"), F.max("digest").alias("high")).where("low != high")
    unlike = materialise(unlike.select("doc_id"), "unlike")
    if not unlike.isEmpty():
        texts_of = own.select("doc_id", "digest").join(unlike, "doc_id", "left_semi").join(least, "digest")
        lowest = texts_of.groupBy("doc_id").agg(F.min("node").alias("a"))
        same_key = texts_of.select("doc_id", F.col("node").alias("b")).join(lowest, "doc_id").where("a < b")
        links = materialise(links.select("a", "b").union(same_key.select("a", "b").distinct()), "links")
    labels = _labels(links)
    apart = materialise(apart_from_hub(labels).select("bucket", "node"), "apart")
    if not apart.isEmpty():
        chosen = materialise(members.join(apart.select("bucket").distinct(), "bucket", "left_semi").select("node").distinct(), "chosen")
        prefixes = materialise(_prefixes(texts, chosen), "prefixes")
        heads = materialise(prefixes.groupBy("token").agg(F.min(F.struct("at", "node")).alias("head")), "heads")
        rays = prefixes.join(heads, "token").select(F.col("head.node").alias("head"), "node").where("head != node")
        rays = rays.select(F.least("head", "node").alias("a"), F.greatest("head", "node").alias("b")).distinct()
        links = links.union(confirmed(rays, "rays"))
        labels = _labels(links)
        apart = materialise(apart_from_hub(labels).select("node").distinct(), "apart")
        more = confirmed(_meetings(prefixes, labels, apart), "meetings")
        if not more.isEmpty():
            labels = _labels(links.union(more))

    named = materialise(_labelled(least, labels, "node", "component_id").select("digest", "component_id"), "components")
    component = F.coalesce("component_id", "doc_id")
    return sketched.join(named, "digest", "left").select(
        F.col("doc_id").alias(key), "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept")
    )
