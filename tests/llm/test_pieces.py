"""Piece encoding and decoding against the sentencepiece library."""

import hashlib
import random

import numpy as np
import public_tokenizers as P
import pytest
import sentencepiece

from hemeroteca.llm import pieces, queries

MODEL = P.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


@pytest.fixture(scope="module")
def own():
    return pieces.PieceModel(MODEL)


def odd_texts():
    rnd = random.Random(8)
    letters = ["abcdefghij ", "  ab", "▁ a", "a", "aeiou", "é日本x \n\t", "<s></s><0x41>", "0123456789,. ", "́eﬁ\U0001d4b3\x00 ", " ", "=-_*#"]
    for _ in range(3000):
        alphabet = rnd.choice(letters) + rnd.choice(letters)
        yield "".join(rnd.choice(alphabet) for _ in range(rnd.randrange(rnd.choice([5, 40, 300]))))
    words = ["the", "representation", "desde", "Straße", "l'été", "listener", "....", "add", "Event"]
    for _ in range(500):
        yield "".join(rnd.choice(words) + rnd.choice(["", " ", "  ", "\n"]) for _ in range(40))
    for size in (1500, 5000, 30_000):
        yield "".join(rnd.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(size))
        yield "".join(rnd.choice("-=_.") for _ in range(size))
        yield "".join(rnd.choice(words) for _ in range(size // 5))
        yield from (" " * size + "x", "x" + " " * size, "a" * size, "ha" * size, "-" * size)
    yield from ("", " ", "a ", "  a", "▁", "▁▁x", " \n ")


def test_ids_and_texts_equal_the_library(own, library):
    texts = list(odd_texts())
    for text, ids in zip(texts, own.encode(texts), strict=True):
        assert ids.tolist() == library.encode(text, add_bos=True, add_eos=True), repr(text[:80])
        assert own.decode(ids) == library.decode(ids.tolist())


def test_words_in_small_arrays(own, library, monkeypatch):
    monkeypatch.setattr(pieces, "FLAT_SYMBOLS", 40)
    monkeypatch.setattr(pieces, "LONG_WORD", 20)
    texts = ["one two threethreethreethreethree four fivefivefivefivefivefive", "a " * 100, "representationrepresentation"]
    for text, ids in zip(texts, own.encode(texts), strict=True):
        assert ids.tolist() == library.encode(text, add_bos=True, add_eos=True)


def test_any_ids_decode_as_the_library_does(own, library):
    rnd = random.Random(3)
    for _ in range(2000):
        ids = [rnd.choice([0, 1, 2, rnd.randrange(3, 259), rnd.randrange(259, 32000), 28705]) for _ in range(rnd.randrange(9))]
        assert own.decode(np.array(ids, np.int32)) == library.decode(ids)


def test_frames(spark, library):
    texts = [None, "", "One two.\n\nThree  four", "One two.\n\nThree  four", "añ字\U0001f600", "long " * 30_000]
    docs = spark.createDataFrame([(i, t, 7, "x") for i, t in enumerate(texts)], "doc_id long, text string, IDS int, n_tokens string")
    for packed in (False, True):
        ids = pieces.encode(docs, MODEL, packed=packed)
        assert ids.columns == ["doc_id", "text", "n_tokens", "ids"]
        got = {r.doc_id: r for r in pieces.decode(ids.withColumnRenamed("text", "own"), MODEL).collect()}
        for i, t in enumerate(texts):
            want = library.encode(t or "", add_bos=True, add_eos=True)
            assert (np.frombuffer(got[i].ids, "<i4").tolist() if packed else got[i].ids) == want
            assert got[i].text == (t or "") and got[i].own == t
    assert pieces.encode(docs.limit(0), MODEL).collect() == []
    lists = spark.createDataFrame([([1, 300, 40_000, -1, None],), (None,), ([],)], "ids array<int>")
    assert sorted(r.text for r in pieces.decode(lists, MODEL).collect()) == ["", "", library.decode([300])]


def test_query_digests(spark, sf, library):
    got = {r.doc_id: r for r in queries.op11_pieces(spark, sf).collect()}
    rows = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    assert len(rows) == len(got)
    for row in rows:
        ids = library.encode(row.text or "", add_bos=True, add_eos=True)
        own = got[row.doc_id]
        assert own.n_tokens == len(ids)
        assert own.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert own.decoded_sha256 == hashlib.sha256(library.decode(ids).encode()).hexdigest()
