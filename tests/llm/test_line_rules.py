"""Counts, decoding and fit of the line field."""

import re
from itertools import product

import numpy as np

from hemeroteca.llm import line_rules, queries


def plain_counts(text):
    words = re.findall("[^\x20\x09-\x0d]+", text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often = {w for w in windows if windows.count(w) > 1} if len(windows) < 400 else {w for w in set(windows) if windows.count(w) > 1}
    covered = {i + k for i, w in enumerate(windows) if w in often for k in range(3)}
    lines = [x for x in text.split("\n") if re.search("[^\x20\x09-\x0d]", x)]
    n = len(words)
    return (
        n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered),
        n < 50 or 100 * len(covered) > 50 * n,
    )


def counts(row):
    return tuple(row[c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"))


def test_counts(spark, sf):
    texts = {r.doc_id: r.text or "" for r in queries.table(spark, sf, "documents").collect()}
    rows = queries.op3_quality_rules(spark, sf).collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert counts(r) == plain_counts(texts[r.doc_id])
        assert not (r.kept and r.base_failed) and 0 <= r.content_share <= 1


def test_cases(spark):
    texts = [None, "", "\n\n", "a b c a b c", "x\x0b y\xa0z\n\nx\x0b y\xa0z", "w " * 30_000, "# * $"]
    docs = spark.createDataFrame([(i, t, "k") for i, t in enumerate(texts)], "doc_id long, text string, kept string")
    rows = sorted(line_rules.judge(docs.union(docs), line_rules.ALL_CONTENT).collect(), key=lambda r: r.doc_id)
    assert len(rows) == 2 * len(texts)
    for r in rows:
        if len(texts[r.doc_id] or "") < 1000:
            assert counts(r) == plain_counts(texts[r.doc_id] or "")
    assert (rows[-3].n_repeat_words, rows[-3].kept) == (30_000, False)
    assert line_rules.judge(docs.limit(0), line_rules.ALL_CONTENT).collect() == []
    empty = spark.createDataFrame([], "doc_id long, quality int")
    assert line_rules.fit(docs, empty) is line_rules.ALL_CONTENT


def test_viterbi_against_all_sequences():
    rnd = np.random.default_rng(4)
    for length in (1, 2, 5, 8):
        for _ in range(20):
            scores, steps = rnd.normal(size=length), rnd.normal(size=(2, 2))

            def value(path, scores=scores, steps=steps):
                return sum(s for s, c in zip(scores, path, strict=True) if c) + sum(steps[a, b] for a, b in zip(path, path[1:], strict=False))

            best = max(product((0, 1), repeat=length), key=value)
            assert tuple(map(int, line_rules.viterbi(scores, steps))) == best
    assert line_rules.viterbi(np.empty(0), np.zeros((2, 2))) == []


def test_held_out_documents(spark, sf):
    sf = sf.replace("sf0.001", "sf0.01")
    docs, labels = queries.table(spark, sf, "documents"), queries.table(spark, sf, "labels")
    field = line_rules.fit(docs, labels.where("crc32(string(doc_id)) % 5 != 0"))
    judged = line_rules.judge(docs, field).join(labels.where("crc32(string(doc_id)) % 5 = 0"), "doc_id")
    good, bad = judged.where("quality = 1 and not base_failed"), judged.where("quality = 0")
    assert good.where("kept").count() >= 0.97 * good.count()
    assert bad.where("kept").count() <= 0.1 * bad.count()
