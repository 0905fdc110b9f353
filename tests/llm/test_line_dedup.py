"""Repeated passages against trying all runs of lines."""

import random

import pytest

import corpus_pipeline
from hemeroteca.llm import line_dedup, queries


def runs_removed(rows):
    """Texts without any run of lines, two or more with something in them, that stands earlier; by trying all runs."""
    at, out = {}, {}
    texts = {doc: text.split("\n") for doc, text in rows}
    full = {doc: [bool(x.strip()) for x in lines] for doc, lines in texts.items()}

    def runs(doc):
        lines = texts[doc]
        for i in range(len(lines)):
            for j in range(i + 1, len(lines)):
                if full[doc][i] and full[doc][j]:
                    yield i, j, tuple(lines[i : j + 1])

    for doc in sorted(texts):
        for i, j, run in runs(doc):
            at.setdefault(run, (doc, i, j))
    for doc in texts:
        gone = set()
        for i, j, run in runs(doc):
            first, start, end = at[run]
            if (first, start) != (doc, i):
                gone.update(k for k in range(i, j + 1) if not (first == doc and start <= k <= end))
        out[doc] = "\n".join(x for k, x in enumerate(texts[doc]) if k not in gone)
    return out


def test_planted_passages_go_to_their_ends(spark):
    rnd = random.Random(3)
    passages = [[f"line {rnd.random()}" for _ in range(k)] for k in range(2, 9) for _ in range(6)]
    passages[3].insert(1, "")
    rows = []
    for doc in range(3 * len(passages)):
        own = [[f"own {rnd.random()}" for _ in range(rnd.randrange(1, 4))] for _ in range(2)]
        rows.append((doc, "\n".join([*own[0], *passages[doc % len(passages)], *own[1]])))
    rows += [(900, "a\na\na\na\nb"), (901, "x\ny\nx\ny\n\n"), (902, "a\nb\nx"), (903, "\n".join(passages[5] + passages[9])), (904, " \n\n"), (905, "é\né\né\né"), (906, "ñá\n\nñá\nñá\nz")]
    docs = spark.createDataFrame([(*r, len(r[1])) for r in rows], "doc_id long, text string, n_chars int").repartition(5)
    want = runs_removed(rows)
    got = {r.doc_id: r.text for r in corpus_pipeline.lines(spark, docs, "").collect()}
    assert got == want
    for doc, text in rows[len(passages) : 3 * len(passages)]:
        assert not set(passages[doc % len(passages)]) & set(want[doc].split("\n")) - {""}
    lost = {x for _, t in rows for x in t.split("\n") if x.strip()} - {x for t in got.values() for x in t.split("\n")}
    assert not lost
    assert line_dedup.drop_repeats(docs.limit(0)).collect() == []


def test_chunks_resist_shifts():
    rnd = random.Random(1)
    passage = [f"line {rnd.random()}" for _ in range(60)]
    heads = [[f"head {rnd.random()}" for _ in range(n)] for n in (0, 1, 2, 5, 9)]
    for one_in, lost in ((1, 0), (2, 3), (4, 6)):
        cut = [{c for _, _, c in line_dedup.line_chunks("\n".join([*h, *passage]), one_in)} for h in heads]
        assert len(set.intersection(*cut)) >= len(cut[0]) - lost
        assert len(cut[0]) < 60 / one_in * 1.7 + 1
    pairs = [c for _, _, c in line_dedup.line_chunks("a\n\nb\n \nc\n")]
    assert pairs == [b"a\n\nb", b"b\n \nc"]
    for text in ("", "a", "\n", " \n\t"):
        assert not list(line_dedup.line_chunks(text))


def test_odd_rows(spark):
    rnd = random.Random(2)
    pool = ["\n".join(f"line {rnd.randrange(10**6)}" for _ in range(12)) for _ in range(6)]
    texts = [None, "", "\n\n\n", *("\n".join(rnd.sample(pool, 3) + [f"own {i}"]) for i in range(30)), pool[0], pool[0], "x\ny\n" * 9000]
    docs = spark.createDataFrame([(i, t, "s", 4) for i, t in enumerate(texts)], "doc_id long, text string, HASH string, Removed_Lines int").repartition(5)
    got = {r.doc_id: r for r in line_dedup.drop_repeats(docs).collect()}
    want = runs_removed([(i, t) for i, t in enumerate(texts[:-1]) if t is not None])
    assert {i: got[i].text for i in want} == want
    assert got[0].text is None and got[0].HASH == "s" and len(got) == len(texts)
    assert got[len(texts) - 1].text.split("\n")[:2] == ["x", "y"] and len(got[len(texts) - 1].text) < 10
    assert line_dedup.drop_repeats(docs.limit(0)).collect() == []
    none = spark.createDataFrame([(None, pool[1]), (None, pool[1]), (1, pool[1]), (1, pool[1])], "doc_id long, text string")
    assert [r.text for r in line_dedup.drop_repeats(none).collect()] == [pool[1]] * 4


def test_many_keys_are_met_in_groups(spark, monkeypatch):
    from hemeroteca.operators import prefilter

    rows = [(i, "\n".join(f"line {(i % 900) * 3 + k}" for k in range(8)) + f"\nown {i}") for i in range(2700)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    want = sorted(map(tuple, line_dedup.drop_repeats(docs).select("doc_id", "text").collect()))
    monkeypatch.setattr(prefilter, "MOST_BITMAPS", 1)
    monkeypatch.setattr(prefilter, "BITS_PER_KEY", 24)
    assert sorted(map(tuple, line_dedup.drop_repeats(docs).select("doc_id", "text").collect())) == want


@pytest.mark.parametrize("query", [queries.op6_line_dedup, queries.op6_passage_dedup])
def test_queries(spark, sf, query):
    rows = [(r.doc_id, r.text) for r in queries.table(spark, sf, "documents").collect()]
    want = runs_removed([(d, t) for d, t in rows if t is not None])
    got = {r.doc_id: r.text for r in query(spark, sf).collect()}
    assert len(got) == len(rows)
    assert {d: got[d] for d in want} == want


def test_fewer_boundaries_take_no_more(spark, sf):
    docs = queries.table(spark, sf, "documents").select("doc_id", "text")
    rows = {r.doc_id: r.text for r in docs.collect()}
    want = runs_removed([(d, t) for d, t in rows.items() if t is not None])
    got = {r.doc_id: r.text for r in line_dedup.drop_repeats(docs, one_in=2).collect()}
    assert all(len(want[d]) <= len(got[d]) <= len(rows[d]) for d in want)


def test_passages_with_colliding_hashes(spark, monkeypatch):
    """The bytes decide where one hash stands on unlike pairs."""

    def coarse(text, one_in):
        for n, _, pair in whole(text, one_in):
            yield n, len(pair), pair

    whole = line_dedup.line_chunks
    monkeypatch.setattr(line_dedup, "line_chunks", coarse)
    rows = [(0, "aa\nbb\ncc"), (1, "dd\nee\nff"), (2, "aa\nbb\nzz"), (3, "qq\nee\nff")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.text, r.removed_lines) for r in line_dedup.drop_repeats(docs).collect()}
    assert got == {0: (rows[0][1], []), 1: (rows[1][1], []), 2: ("zz", [0, 1]), 3: ("qq", [1, 2])}
