"""Encoding and decoding against the tokenizers library, and packing."""

import random
import zlib

import numpy as np
import public_tokenizers as P
import pytest
from tokenizers import Tokenizer

from hemeroteca.llm import bpe, packing, queries

BYTES, WORDS = P.path("byte_bpe_50k.json"), P.path("word_bpe_49k.json")


def odd_texts():
    rnd = random.Random(5)
    alphabet = "ab'sB \n\t\r .,1²é ñ\xa0ÀǅΣİ$#<|endoftext|>́字"
    texts = ["".join(rnd.choice(alphabet) for _ in range(rnd.randrange(30))) for _ in range(4000)]
    texts += [f"a{chr(c)}b 1{chr(c)} {chr(c)}{chr(c)}'s  x" for c in range(1, 0x2FFF, 3)]
    texts += ["", " ", "a ", "  a", "\n a", "x<|endoftext|> y<|startoftext|>", "'s't", "ab" * 9000, "é" * 5000, "<|endoftext|>"]
    return texts


@pytest.mark.parametrize(("path", "kind"), [(BYTES, bpe.ByteEncoder), (WORDS, bpe.WordEncoder)])
def test_ids_equal_the_library(path, kind):
    encoder, library = kind(path), Tokenizer.from_file(path)
    for limit in (bpe.REMEMBERED, 3):
        encoder.pieces, encoder.words = bpe.Memory(limit), bpe.Memory(limit)
        for text in odd_texts():
            assert np.frombuffer(encoder.encode(text), "<i4").tolist() == library.encode(text, add_special_tokens=False).ids


def test_cuts_are_where_no_token_holds_the_pair():
    encoder = bpe.ByteEncoder(BYTES)
    vocab = encoder.library.get_vocab(with_added_tokens=False)
    for word in ("ñqüzß", "wasserñßzq", "日本語", "kq́x"):
        parts = encoder.fragments(encoder.mapped(word))
        assert "".join(parts) == encoder.mapped(word)
        for a, b in zip(parts, parts[1:], strict=False):
            assert not any(a[-1] + b[0] in token for token in vocab)
    assert len(encoder.fragments(encoder.mapped("日本語ñqüzß"))) > 1


def test_encode_decode_frames(spark):
    library = Tokenizer.from_file(BYTES)
    texts = [None, "", "One two.\n\nThree  four", "One two.\n\nThree  four", "añ字\U0001f600", "long " * 30000]
    docs = spark.createDataFrame([(i, t, 7, "x") for i, t in enumerate(texts)], "doc_id long, text string, ids int, decoded string")
    ids = bpe.encode(docs, BYTES)
    got = {r.doc_id: r for r in bpe.decode(ids, BYTES, text="decoded").collect()}
    for i, t in enumerate(texts):
        assert got[i].ids == library.encode(t or "", add_special_tokens=False).ids
        assert got[i].decoded == (t or "") and got[i].text == t
    assert bpe.encode(docs.limit(0), BYTES).collect() == []
    lists = spark.createDataFrame([([50256, 128, 60000, -1],), (None,), ([],)], "ids array<int>")
    assert sorted(r.text for r in bpe.decode(lists, BYTES).collect()) == ["", "", library.decode([50256, 128], skip_special_tokens=False)]


def test_query_digests(spark, sf):
    import hashlib

    library = Tokenizer.from_file(BYTES)
    texts = {r.doc_id: r.text or "" for r in queries.table(spark, sf, "documents").collect()}
    rows = queries.op1_bpe(spark, sf).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = library.encode(texts[r.doc_id], add_special_tokens=False).ids
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()


def check_pieces(rows, want, capacity):
    """Every id in one piece; sequences gapless, within capacity, and almost full or of a length that is a power of two."""
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append(r)
    assert by_doc.keys() == want.keys()
    for doc_id, ids in want.items():
        at = 0
        for r in sorted(by_doc[doc_id], key=lambda r: r.start):
            assert r.start == at and r.length > 0 and r.doc_tokens == len(ids)
            assert r.ids_crc32 == zlib.crc32(np.array(ids[at : at + r.length], "<u4").tobytes())
            at += r.length
        assert at == len(ids)
    padding = 0
    for pieces in by_sequence.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= capacity
        padding += capacity - at if at & (at - 1) else 0
    assert padding <= 0.01 * sum(map(len, want.values()))


def test_packing_query(spark, sf):
    library = Tokenizer.from_file(WORDS)
    docs = queries.table(spark, sf, "documents").collect()
    want = {r.doc_id: [*library.encode(r.text or "", add_special_tokens=False).ids, 1] for r in docs}
    check_pieces(queries.op4_packing(spark, sf).collect(), want, 2048)


def test_packing_cases(spark):
    texts = [None, "", "a", "a", "word " * 5000]
    docs = spark.createDataFrame([(i, t, i) for i, t in enumerate(texts)], "doc_id long, text string, start int")
    rows = packing.pack(docs, WORDS, 1, capacity=64, slack=2).selectExpr("*", "crc32(token_bytes) ids_crc32").collect()
    library = Tokenizer.from_file(WORDS)
    check_pieces(rows, {i: [*library.encode(t or "", add_special_tokens=False).ids, 1] for i, t in enumerate(texts)}, 64)
    assert packing.pack(docs.limit(0), WORDS, 1).collect() == []
    twice = packing.pack(docs.union(docs), WORDS, 1, capacity=64)
    assert sum(r.length for r in twice.collect()) == 2 * sum(r.length for r in rows)


def test_classes_hold_a_fixed_count():
    rnd = random.Random(1)
    docs = [(i, b"abcd" * rnd.randrange(1, 9000)) for i in range(500)]
    sequences = list(packing.fill(docs, 2048, 16))
    full = [s for s in sequences if len({2048 // (len(p[2]) // 4) for p in s}) == 1 and len(s) == 2048 // (len(s[0][2]) // 4)]
    assert len(full) > 0.9 * len(sequences)
    assert all(sum(len(p[2]) // 4 for p in s) >= 2048 - 16 for s in full)
