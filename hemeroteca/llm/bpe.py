"""Byte-pair encoding by forced boundaries, and decoding.

No merge can span two bytes that stand side by side in no token of the vocabulary. Such a pair is a certain
cut: the two sides can be encoded alone and joined. In a byte-level vocabulary "character, blank" is such a
pair, so a text falls apart into blank-led pieces; a piece falls apart where the pre-tokenizer cuts; and what
is left falls apart at the vocabulary's other missing pairs. Fragments repeat far more often than texts, so
each task remembers the ids of those it has met, in two generations of bounded size.
"""

from __future__ import annotations

import json
import re
from array import array
from functools import cache
from operator import add

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from hemeroteca.llm.batches import with_columns

#: Fragments that a task remembers in each of two generations: about 25 MB in each, 60 MB if all are long.
REMEMBERED = 120_000
#: Longer ones, in characters, aren't remembered, so that numbers bound bytes.
LONGEST = 64

# The classes of the characters up to U+017F, and the published split patterns over them.
LETTERS = "A-Za-zªµºÀ-ÖØ-öø-ſ"
NUMBERS = "0-9²³¹¼-¾"
#: Characters outside these go to the library's own pre-tokenizer: other blanks, scripts and marks.
UNUSUAL = re.compile("[^\t\n\r\x20-\x7e¡-įı-ſ]")
USUAL_ASCII = bytes([9, 10, 13, *range(0x20, 0x7F)])
BYTE_SPLIT = re.compile(
    f"'s|'t|'re|'ve|'m|'ll|'d| ?[{LETTERS}]+| ?[{NUMBERS}]+| ?[^\\s{LETTERS}{NUMBERS}]+|\\s+(?!\\S)|\\s+"
)
WORD_SPLIT = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{LETTERS}]+|[{NUMBERS}]|[^\\s{LETTERS}{NUMBERS}]+")


def byte_alphabet() -> dict[int, str]:
    """Byte to the printable character that stands for it in byte-level vocabularies."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = iter(range(0x100, 0x200))
    return {b: chr(b if b in plain else next(others)) for b in range(256)}


ALPHABET = byte_alphabet()


def is_unusual(text: str) -> bool:
    if text.isascii():
        return bool(text.encode().translate(None, USUAL_ASCII))
    return UNUSUAL.search(text) is not None


class Memory:
    """A map of bounded size. Entries not met again while a generation fills up are forgotten."""

    def __init__(self, limit: int):
        self.limit, self.young, self.old = limit, {}, {}

    def get(self, key):
        found = self.young.get(key)
        if found is None and (found := self.old.get(key)) is not None:
            self.put(key, found)
        return found

    def put(self, key, value) -> None:
        if len(key) > LONGEST:
            return
        if len(self.young) >= self.limit:
            self.young, self.old = {}, self.young
        self.young[key] = value


class FragmentEncoder:
    """What both kinds of vocabulary share: a model that is asked once for each fragment."""

    def __init__(self, path: str, remembered: int = REMEMBERED):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.model = self.library.model
        with open(path, encoding="utf-8") as file:
            added = json.load(file)["added_tokens"]
        self.added = {t["content"]: t["id"] for t in added}
        self.pieces, self.words = Memory(remembered), Memory(remembered // 4)

    def model_ids(self, mapped: str) -> bytes:
        return array("i", [t.id for t in self.model.tokenize(mapped)]).tobytes()

    @staticmethod
    def mapped(word: str) -> str:
        return word.encode().decode("latin-1").translate(ALPHABET)


class ByteEncoder(FragmentEncoder):
    """Byte-level BPE: text to 32-bit little-endian ids, as the tokenizers library gives them."""

    def __init__(self, path: str, remembered: int = REMEMBERED):
        super().__init__(path, remembered)
        inside = set()
        for token in self.library.get_vocab(with_added_tokens=False):
            inside.update(zip(token, token[1:], strict=False))
        #: Pairs of mapped bytes that occur in some token; all others are certain cuts.
        self.joined = {a + b for a, b in inside}
        blank = ALPHABET[0x20]
        assert not any(pair[1] == blank and pair[0] not in map(ALPHABET.get, b"\t\n\v\f\r \x85\xa0") for pair in self.joined)
        self.specials = re.compile("|".join(map(re.escape, self.added)))

    def fragments(self, mapped: str) -> list[str]:
        """A mapped word, cut at every pair of bytes that no token holds."""
        pairs = list(map(add, mapped, mapped[1:]))
        if self.joined.issuperset(pairs):
            return [mapped]
        cuts = [i for i, pair in enumerate(pairs, 1) if pair not in self.joined]
        return [mapped[a:b] for a, b in zip([0, *cuts], [*cuts, len(mapped)], strict=True)]

    def cut_and_encode(self, word: str) -> bytes:
        mapped = word.replace(" ", "Ġ") if word.isascii() and word.isprintable() else self.mapped(word)
        return b"".join(map(self.model_ids, self.fragments(mapped)))

    def word(self, word: str) -> bytes:
        found = self.words.get(word)
        if found is None:
            found = word[0] == " " and self.pieces.young.get(word[1:]) or self.cut_and_encode(word)
            self.words.put(word, found)
        return found

    def led_piece(self, rest: str) -> bytes:
        """Ids of a blank and the blank-free ``rest`` after it."""
        found = self.pieces.get(rest)
        if found is None:
            words = BYTE_SPLIT.findall(" " + rest)
            found = self.cut_and_encode(words[0]) if len(words) == 1 else b"".join(map(self.word, words))
            self.pieces.put(rest, found)
        return found

    def plain(self, text: str) -> bytes:
        """Ids of a text without special tokens."""
        if is_unusual(text):
            return b"".join(self.word(text[a:b]) for _, (a, b) in self.library.pre_tokenizer.pre_tokenize_str(text))
        if "  " in text or "\n " in text or "\t " in text or "\r " in text:
            # Here a blank follows white space, and the split depends on what comes after.
            return b"".join(map(self.word, BYTE_SPLIT.findall(text)))
        first, *led = text.split(" ")
        ids = list(map(self.pieces.young.get, led))
        if None in ids:
            ids = [self.led_piece(p) if i is None else i for i, p in zip(ids, led, strict=True)]
        return b"".join([*map(self.word, BYTE_SPLIT.findall(first)), *ids])

    def encode(self, text: str) -> bytes:
        if "<|" not in text or not self.specials.search(text):
            return self.plain(text)
        out, at = [], 0
        for hit in self.specials.finditer(text):
            out += [self.plain(text[at : hit.start()]), array("i", [self.added[hit[0]]]).tobytes()]
            at = hit.end()
        return b"".join([*out, self.plain(text[at:])])


class WordEncoder(FragmentEncoder):
    """BPE over lower-cased words with word ends; white space is dropped, so every gap is a certain cut."""

    def word(self, word: str) -> bytes:
        found = self.words.get(word)
        if found is None:
            self.words.put(word, found := self.model_ids(self.mapped(word)))
        return found

    def piece(self, piece: str) -> bytes:
        found = self.pieces.get(piece)
        if found is None:
            words = WORD_SPLIT.findall(piece)
            found = self.word(words[0]) if len(words) == 1 else b"".join(map(self.word, words))
            self.pieces.put(piece, found)
        return found

    def encode(self, text: str) -> bytes:
        if is_unusual(text) or any(t in text for t in self.added):
            return array("i", self.library.encode(text, add_special_tokens=False).ids).tobytes()
        pieces = text.lower().split()
        ids = list(map(self.pieces.young.get, pieces))
        if None in ids:
            ids = [self.piece(p) if i is None else i for i, p in zip(ids, pieces, strict=True)]
        return b"".join(ids)


@cache
def byte_encoder(path: str) -> ByteEncoder:
    return ByteEncoder(path)


@cache
def word_encoder(path: str) -> WordEncoder:
    return WordEncoder(path)


@cache
def token_bytes(path: str) -> list[bytes]:
    """The bytes of every id, b"" for an id that isn't used."""
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(path)
    back = {c: bytes([b]) for b, c in ALPHABET.items()}
    vocab = library.get_vocab(with_added_tokens=True)
    out = [b""] * (max(vocab.values()) + 1)
    for token, at in vocab.items():
        out[at] = b"".join(back[c] for c in token)
    return out


def id_lists(parts: list[bytes]) -> pa.ListArray:
    """A list array from each row's 32-bit ids."""
    ends = np.cumsum([0, *(len(p) // 4 for p in parts)], dtype=np.int32)
    values = pa.Array.from_buffers(pa.int32(), int(ends[-1]), [None, pa.py_buffer(b"".join(parts))])
    return pa.ListArray.from_arrays(pa.array(ends), values)


def encode(docs: DataFrame, tokenizer: str, text: str = "text", ids: str = "ids", keep_text: bool = True) -> DataFrame:
    """Add ``ids``, the token ids of the whole text under the byte-level vocabulary file ``tokenizer``.

    A null or empty text has no ids. Special tokens in a text get their own id, as in the library. Other
    columns and repeated rows pass unchanged; a column named like ``ids`` is replaced. An empty table stays one.
    ``keep_text=False`` leaves the text out, which saves its way back from Python.
    """

    def work(texts: pa.Array) -> dict[str, pa.Array]:
        encoder = byte_encoder(tokenizer)
        return {ids: id_lists([encoder.encode(t) if t else b"" for t in texts.to_pylist()])}

    return with_columns(docs, text, {ids: "array<int>"}, work, drop=() if keep_text else (text,), caches=(byte_encoder,))


def decode(rows: DataFrame, tokenizer: str, ids: str = "ids", text: str = "text") -> DataFrame:
    """Add ``text``, what the ids stand for. Bytes that aren't UTF-8 become U+FFFD; ids outside the vocabulary
    stand for nothing; null ids give an empty text. Other columns pass unchanged."""

    def work(lists: pa.Array) -> dict[str, pa.Array]:
        table = token_bytes(tokenizer)
        out = []
        for row in lists:
            known = row.values.drop_null().to_numpy() if row.is_valid else np.empty(0, np.int32)
            if len(known) and (known.min() < 0 or known.max() >= len(table)):
                known = known[(known >= 0) & (known < len(table))]
            out.append(b"".join(map(table.__getitem__, known.tolist())).decode("utf-8", "replace"))
        return {text: pa.array(out, pa.string())}

    return with_columns(rows, ids, {text: "string"}, work, caches=(token_bytes,))
