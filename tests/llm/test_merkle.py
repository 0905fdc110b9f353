"""Fingerprints."""

import hashlib

from pyspark.sql import functions as F

from hemeroteca.llm import merkle, queries


def prints(spark, texts):
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, t string").orderBy("i")
    return [r[0] for r in rows.select(merkle.fingerprint(F.col("t"))).collect()]


def test_equal_roots_mean_equal_texts(spark):
    texts = ["", None, "a", "a\n", "\na", "a b", "a  b", " a", "a ", "b\na", "a\nb", "a\n\nb", "word " * 20, "word " * 21, "x" * 100_000, " " * 50]
    made = prints(spark, texts)
    assert made[0] == made[1]
    assert len({p[:64] for p in made}) == len(texts) - 1


def test_branches_locate_edits(spark):
    lines = [f"paragraph {i} has some words of its own, enough for two leaves or three {i}" for i in range(40)]
    edited = [*lines[:7], "something else", *lines[8:20], "put in", *lines[20:]]
    rows = spark.createDataFrame([("\n".join(lines), "\n".join(edited))], "a string, b string")
    a, b = merkle.fingerprint(F.col("a")), merkle.fingerprint(F.col("b"))
    r = rows.select(merkle.differing_paragraphs(a, b), merkle.differing_paragraphs(b, a), merkle.likeness(a, b)).first()
    assert r[0] == [7] and r[1] == [7, 20]
    assert 0.9 < r[2] < 1


def test_tree_by_hand(spark):
    text = "one two three four five six seven eight nine\nten"
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    leaves = [[sha("one two three four five six seven eight "), sha("nine")], [sha("ten")]]
    paragraphs = [sha("p" + "".join(own)) for own in leaves]
    sections, held = [], ""
    for p in paragraphs:
        held += p
        if int(p[:4], 16) % merkle.SECTION_PARAGRAPHS == 0:
            sections.append(sha("s" + held))
            held = ""
    if held:
        sections.append(sha("s" + held))
    made = prints(spark, [text])[0]
    assert made[:64] == sha("".join(sections))
    assert [x[:8] for x in made.split(";")[1:]] == [s[:8] for s in sections]
    assert [x for x in made.split("-")[1:] if x] and [x[:8] for x in made.split("-")[1:]] == [h[:8] for own in leaves for h in own]


def test_query_against_plain(spark, sf):
    docs = sorted(((r.doc_id, r.text or "") for r in queries.table(spark, sf, "documents").collect()))
    got = {r.doc_id: r for r in queries.op7_fingerprints(spark, sf).collect()}
    assert len(got) == len(docs)
    by_text = {}
    for i, (doc_id, text) in enumerate(docs):
        after, half = docs[(i + 1) % len(docs)][1], len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        r = got[doc_id]
        assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        assert by_text.setdefault(text, r.fingerprint) == r.fingerprint
        assert 0 <= r.near_next <= 1 and 0 <= r.near_edited <= 1
    assert len(set(by_text.values())) == len(by_text)
    assert sum(r.near_edited for r in got.values()) / len(got) > 0.35
    assert sum(r.near_next for r in got.values()) / len(got) < 0.1


def test_next_rows(spark):
    for ids in ([5], [3, 1, 2], [4, 4, 1], [None, 2, 9, None], [], list(range(0, 900, 7)), [10**12, -5, 0]):
        rows = [(i, f"t{n}", "x") for n, i in enumerate(ids)]
        docs = spark.createDataFrame(rows, "doc_id long, text string, part string").repartition(3)
        for parts in (1, 4, 50):
            got = merkle.with_next(docs, "doc_id", ["text"], parts).collect()
            want = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
            follow = {r[1]: want[(n + 1) % len(want)][1] for n, r in enumerate(want)}
            assert {r.text: r.next_text for r in got} == follow and len(got) == len(rows)


def test_cases(spark):
    docs = spark.createDataFrame([(1, None, 2), (2, "", 2), (3, "some text", 2), (3, "some text", 2)], "doc_id long, text string, part int")
    got = merkle.compare_with_edit(docs, 4).collect()
    assert [r.n_chars for r in sorted(got, key=lambda r: (r.doc_id, r.n_chars))] == [0, 0, 9, 9]
    assert merkle.compare_with_edit(docs.limit(0), 4).collect() == []


def test_main_path_is_native(spark, sf):
    plan = queries.op7_fingerprints(spark, sf)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "SinglePartition" not in plan
