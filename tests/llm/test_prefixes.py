"""The prefix trie against sets of tuples."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from hemeroteca.llm import prefixes, queries

SCHEMA = "conv_id long, turn long, role string, text string, depth int, KEY string"


def plain(rows):
    """rows: (conv_id, turn, role, text). Ties in a turn's number mustn't matter to the rows given."""
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append(((turn is not None, turn or 0), role or "", text or ""))
    said = {c: [t[1:] for t in sorted(turns)] for c, turns in own.items()}
    made = {}
    for c in said:
        h = zlib.crc32(str(c).encode()) % 9
        rest = c % 5 if c >= 0 else -(-c % 5)
        made[c] = tuple(said.get(c - rest, [])[:h] + said[c][h:])
    members = defaultdict(list)
    for c, turns in made.items():
        for d in range(len(turns) + 1):
            members[turns[:d]].append(c)
    out = []
    for node, convs in members.items():
        below = [m for m in members if m[: len(node)] == node]
        children = [m for m in below if len(m) == len(node) + 1]
        leaves = [m for m in below if not any(x[:-1] == m for x in below if x)]
        saved = sum((len(members[m]) - 1) * len(m[-1][1].encode()) for m in below if m)
        ends = ",".join(map(str, sorted(c for c in convs if made[c] == node)))
        parent = min(members[node[:-1]]) if node else None
        digest = hashlib.sha256(ends.encode()).hexdigest()
        out.append((min(convs), len(node), parent, len(convs), len(children), len(leaves), saved, digest))
    return sorted(out, key=str)


def as_rows(df):
    names = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
    return sorted((tuple(r[n] for n in names) for r in df.collect()), key=str)


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "k") for r in rows], SCHEMA).repartition(4)


def random_rows(seed, ids, length, words):
    rnd = random.Random(seed)
    rows = []
    for conv in ids:
        for turn in range(rnd.randrange(length + 1)):
            rows.append((conv, turn * 3 - 4, rnd.choice(["user", "tool", None]), rnd.choice(words)))
    rnd.shuffle(rows)
    return rows


@pytest.mark.parametrize("shard_ids", [1, 7, 256])
def test_equals_sets_of_tuples(spark, monkeypatch, shard_ids):
    monkeypatch.setattr(prefixes, "SHARD_IDS", shard_ids)
    ids = [*range(60), *range(-12, 0), 10**15, 10**15 + 3, 700, 701]
    rows = random_rows(shard_ids, ids, 5, ["", "é", "ab", None])
    rows += [(None, 1, "user", "lost"), (90, None, "user", "null first"), (90, -5, "user", "then this"), (91, 2, "a", "x")]
    assert as_rows(prefixes.trie(frame(spark, rows))) == plain(rows)


def test_copies_and_a_long_conversation(spark, monkeypatch):
    monkeypatch.setattr(prefixes, "SHARD_IDS", 64)
    monkeypatch.setattr(prefixes, "FLUSH_ROWS", 50)
    rows = [(conv * 5, turn, "user", f"copy {turn}") for conv in range(200) for turn in range(4)]
    rows += [(2000, turn, "user", f"turn {turn % 7}") for turn in range(3000)]
    got = as_rows(prefixes.trie(frame(spark, rows)))
    assert len(got) == 1 + 4 + 3000
    tops = {r[1]: r for r in got if r[0] == 0}
    ends = hashlib.sha256(",".join(str(5 * c) for c in range(200)).encode()).hexdigest()
    assert tops[4] == (0, 4, 0, 200, 0, 1, 199 * 6, ends)
    assert tops[0][3:7] == (201, 2, 2, 199 * 24)
    assert max(r[1] for r in got) == 3000


def test_repeated_rows_are_turns(spark):
    rows = [(5, 1, "user", "again")] * 3 + [(5, 0, "user", "first")]
    assert as_rows(prefixes.trie(frame(spark, rows))) == plain(rows)


def test_turnless_and_no_conversations(spark):
    # Conversation 7 has fewer turns than it would take from conversation 5, which isn't there.
    h = next(c for c in range(1, 999) if c % 5 and zlib.crc32(str(c).encode()) % 9 > 2)
    rows = [(h, 0, "user", "x"), (h, 1, "user", "y")]
    assert as_rows(prefixes.trie(frame(spark, rows))) == plain(rows)
    assert plain(rows)[0][3:5] == (1, 0)
    assert prefixes.trie(frame(spark, rows).limit(0)).collect() == []


def test_query(spark, sf):
    rows = [(r.conv_id, r.turn, r.role, r.text) for r in spark.read.parquet(f"{sf}/conversations.parquet").collect()]
    assert as_rows(queries.op13_prefixes(spark, sf)) == plain(rows)
