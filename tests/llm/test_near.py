"""Near-dedup against all pairs."""

import random
import re
from itertools import combinations

import numpy as np
import pytest

import corpus_pipeline
from hemeroteca.llm import near, queries


def plain_set(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall("[^\x20\x09-\x0d]+", lowered)
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4)))


def plain_classes(rows):
    sets = {i: plain_set(t) for i, t in rows}
    label = {i: i for i in sets}

    def top(i):
        while label[i] != i:
            i = label[i]
        return i

    for a, b in combinations(sorted(sets), 2):
        x, y = sets[a], sets[b]
        if x and y and 100 * len(x & y) >= 75 * len(x | y):
            p, q = sorted((top(a), top(b)))
            label[q] = p
    return {i: (len(sets[i]), top(i)) for i in sets}


def same_as_plain(got, rows):
    want = plain_classes(rows)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in got) and len(got) == len(want)


def edited(rnd, words, share):
    return [rnd.choice("abcdefg") * 3 + str(rnd.randrange(999)) if rnd.random() < share else w for w in words]


def test_chains_clusters_and_cases(spark):
    rnd = random.Random(3)
    base = [f"w{rnd.randrange(5000)}" for _ in range(120)]
    texts = [None, "", " \n", "one", "One", "one two three four", "ONE two\tthree four", "é a b c d", "É a b c d"]
    for share in (0.0, 0.01, 0.02, 0.03, 0.05):
        texts += [" ".join(edited(rnd, base, share)) for _ in range(12)]
    other = [f"v{rnd.randrange(5000)}" for _ in range(60)]
    chain = other
    for _ in range(15):  # each is near the one before, but the ends aren't near each other
        chain = [*chain[3:], *(f"z{rnd.randrange(9999)}" for _ in range(3))]
        texts.append(" ".join(chain))
    texts += ["\x0b".join(other), " ".join(other).upper(), "long " * 20_000 + "end"]
    rows = [(1000 - 7 * i, t) for i, t in enumerate(texts)]
    docs = spark.createDataFrame([(i, t, 1, b"x") for i, t in rows], "doc_id long, text string, node int, registers binary")
    same_as_plain(near.classes(docs).collect(), rows)
    assert near.classes(docs.limit(0)).collect() == []


def test_query(spark, sf):
    rows = [(r.doc_id, r.text) for r in queries.table(spark, sf, "documents").collect()]
    same_as_plain(queries.op10_near_dedup(spark, sf).collect(), rows)


def test_repeated_and_null_keys(spark):
    text = " ".join(f"w{i}" for i in range(30))
    rows = [(5, text), (5, text), (None, text), (None, "lonely"), (7, text), (9, None)]
    got = near.classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(map(str, ((r.doc_id, r.component_id, r.kept) for r in got))) == sorted(
        map(str, [(5, 5, True), (5, 5, True), (None, 5, False), (None, None, True), (7, 5, False), (9, 9, True)])
    )


def test_unlike_texts_of_one_key(spark):
    a, b, c = (" ".join(f"{x}{i}" for i in range(30)) for x in "abc")
    rows = [(1, a), (5, a), (5, b), (8, b), (9, c), (9, c), (10, c + " x y"), (10, "alone")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {(r.doc_id, r.component_id, r.kept) for r in near.classes(docs).collect()}
    assert got == {(1, 1, True), (5, 1, False), (8, 1, False), (9, 9, True), (10, 9, False)}
    left = corpus_pipeline.near_duplicates(spark, docs, "").collect()
    assert sorted(r.doc_id for r in left) == [1, 9, 9]


def test_registers_merge_and_agree_with_likeness():
    rnd = np.random.default_rng(1)
    pool = rnd.integers(0, 2**64, 3000, dtype=np.uint64)
    a, b = pool[:2000], pool[400:2400]
    ra, rb = near.registers(a), near.registers(b)
    assert (np.maximum(ra, rb) == near.registers(pool[:2400])).all()
    assert abs((ra == rb).mean() - 1600 / 2400) < 0.12


@pytest.mark.parametrize(("shared", "wanted"), [(1800, True), (1720, True), (300, False), (0, False)])
def test_plausible(shared, wanted):
    rnd = np.random.default_rng(2)
    for _ in range(20):
        pool = rnd.integers(0, 2**64, 4000, dtype=np.uint64)
        ra, rb = near.registers(pool[:2000]), near.registers(pool[2000 - shared : 4000 - shared])
        n = np.array([2000.0])
        assert near.plausible(n, n, np.array([(ra > rb).sum()]), np.array([(ra < rb).sum()]), 0.75)[0] == wanted


def test_only_texts_that_may_be_alike_are_shuffled(spark, monkeypatch):
    rnd, kept = random.Random(8), []
    words = [[f"w{rnd.randrange(10**6)}" for _ in range(60)] for _ in range(300)]
    rows = [(i, " ".join(w)) for i, w in enumerate([*words, words[7][:-1]])]
    split = near.split_by_keys

    def noted(*given):
        kept.append(split(*given)[0].count())
        return split(*given)

    monkeypatch.setattr(near, "split_by_keys", noted)
    same_as_plain(near.classes(spark.createDataFrame(rows, "doc_id long, text string")).collect(), rows)
    assert len(kept) == 2 and max(kept) < 30, "texts, and registers"
