"""The look-up table, and placement."""

import hashlib
from collections import Counter

import pytest

from hemeroteca.llm import queries, sharding


def plain_table(names, slots):
    """Turns over whole preference lists."""
    number = lambda s: int(hashlib.md5(s.encode()).hexdigest()[:15], 16)
    lists = [
        [(number(f"offset {n}") + j * (number(f"skip {n}") % (slots - 1) + 1)) % slots for j in range(slots)] for n in names
    ]
    owner = {}
    while len(owner) < slots:
        for shard, wanted in enumerate(lists):
            free = next((s for s in wanted if s not in owner), None)
            if free is not None:
                owner[free] = shard
    return [owner[s] for s in range(slots)]


@pytest.mark.parametrize(("shards", "slots"), [(1, 2), (3, 7), (7, 101), (5, 5)])
def test_table_equals_turns_over_preference_lists(shards, slots):
    names = [f"n{i}" for i in range(shards)]
    assert sharding.fill_slots(names, slots) == plain_table(names, slots)


def test_table_is_even_and_stable():
    names = [f"n{i}" for i in range(20)]
    before, after = sharding.fill_slots(names, 4099), sharding.fill_slots(names[:-1], 4099)
    held = Counter(before)
    assert max(held.values()) - min(held.values()) <= 1
    moved = sum(a != b for a, b in zip(before, after, strict=True) if a != 19)
    assert moved < 0.1 * 4099


def test_bad_tables():
    for names, slots in (([], 7), (["a"], 9), (["a", "a"], 7), (list("abcdefgh"), 7)):
        with pytest.raises(ValueError):
            sharding.fill_slots(names, slots)


def test_cases(spark):
    rows = [(1, 5, "x", 9), (1, 5, "x", 9), (None, 5, None, 9), (2, None, "", 9)]
    docs = spark.createDataFrame(rows, "doc_id long, slot int, owner string, shard int")
    placed = sharding.place(docs, "doc_id", ["a", "b", "c"], 101).collect()
    assert sorted(map(str, ((r.doc_id, r.slot, r.owner) for r in placed))) == sorted(map(str, (r[:3] for r in rows)))
    table = sharding.fill_slots(["a", "b", "c"], 101)
    for r in placed:
        key = "" if r.doc_id is None else str(r.doc_id)
        assert r.shard == table[int(hashlib.md5(key.encode()).hexdigest()[:15], 16) % 101]
    assert sharding.place(docs.limit(0), "doc_id", ["a"], 7).collect() == []


def test_main_path_is_native(spark, sf):
    plan = queries.op2_sharding(spark, sf)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "BroadcastHashJoin" in plan
