"""SentencePiece BPE encoding by vectorised merge rounds, and decoding.

No merge can span a character and a blank after it, as no piece of the vocabulary holds that pair, so a text is a row
of blank-led words that are encoded alone. The different words of a slice of texts lie end to end in one flat array of
symbols. Each round looks up the rank of every pair of neighbours, takes each word's lowest, merges all its places
that don't overlap from left to right, and closes the gaps. Words without a pair left drop out; the rounds end when
none is left. The ids of the texts are then gathered from those of the words.

A piece is "hasty" if a longer piece that starts or ends with it is merged no later than itself. The library, which
merges one place at a time, may then go on at that place before it comes to the next one. What it makes there is a
piece, so of hasty places those go at once that lie out of reach of the one before. All others go at once anyway.
"""

from __future__ import annotations

import codecs
import re
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from hemeroteca.llm.batches import with_columns
from hemeroteca.llm.bpe import id_lists

BLANK = "▁"
#: Symbols that are worked on at once; a long word is worked on alone.
FLAT_SYMBOLS, LONG_WORD = 1 << 19, 1 << 10
#: Texts are worked on in slices of about this many bytes.
SLICE = 4 << 20
WORDS = re.compile(" *[^ ]+| +")
NO_RANK = np.iinfo(np.int32).max


def _byte_by_byte(error: UnicodeDecodeError) -> tuple[str, int]:
    return "�", error.start + 1


codecs.register_error("hemeroteca-byte-by-byte", _byte_by_byte)


def every_second(at: np.ndarray) -> np.ndarray:
    """Of places in a row, which overlap, the first, the third and so on."""
    number = np.arange(len(at))
    starts = np.diff(at, prepend=-2) > 1
    return (number - np.maximum.accumulate(np.where(starts, number, 0))) % 2 == 0


def least_before(values: np.ndarray, reach: int) -> np.ndarray:
    """The least of the ``reach`` values, or more, before each one."""
    width, least = 1, np.append(np.int32(NO_RANK), values[:-1])
    while width < reach:
        least[width:] = np.minimum(least[width:], least[:-width])
        width *= 2
    return least


class PieceModel:
    """What the rounds need of a model file: BPE, identity normaliser, blank prefix, byte fallback."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        library = SentencePieceProcessor(model_file=path)
        self.size = size = library.vocab_size()
        self.begin, self.end = library.bos_id(), library.eos_id()
        pieces = library.id_to_piece(list(range(size)))
        self.control = np.array([library.is_control(i) for i in range(size)])
        self.bytes_at = {int(pieces[i][3:5], 16): i for i in range(size) if library.is_byte(i)}
        special = [library.is_control(i) or library.is_byte(i) or library.is_unknown(i) for i in range(size)]
        ids = {p: i for i, p in enumerate(pieces) if not special[i]}
        probe = "  ﬁ a  b　 "
        if len(self.bytes_at) != 256 or library.decode(library.encode(probe)) != probe or any(map(library.is_unused, range(size))):
            raise ValueError("only BPE models with byte fallback that leave texts as they are can be used")
        if any(re.search(f"[^{BLANK}]{BLANK}", p) for p in ids):
            raise ValueError("a piece of the model spans words")
        self._ranks(library, ids)
        self.reach = 2 * max(map(len, ids)) + 2
        self.run = self._blank_run(ids)
        self.symbol = np.arange(size, size + 0x110000, dtype=np.int32)  # characters that are no piece
        for piece, i in ids.items():
            if len(piece) == 1:
                self.symbol[ord(piece)] = i
        self._texts(library, pieces)

    def _ranks(self, library, ids: dict[str, int]) -> None:
        scores = np.array([-library.get_score(i) for i in ids.values()])
        rank = dict(zip(ids, np.unique(scores, return_inverse=True)[1].tolist(), strict=True))
        pairs, hasty = {}, set()
        for piece, i in ids.items():
            for at in range(1, len(piece)):
                left, right = piece[:at], piece[at:]
                if left in ids and right in ids:
                    pairs[ids[left] * self.size + ids[right]] = (i, rank[piece])
                hasty.update(rank[part] for part in (left, right) if len(part) > 1 and part in ids and rank[piece] <= rank[part])
        self.pair_keys = np.array(sorted(pairs), np.int64)
        found = np.array([pairs[k] for k in self.pair_keys.tolist()], np.int32).reshape(-1, 2)
        # The last entry stands for pairs that make no piece.
        self.pair_piece = np.append(found[:, 0], 0).astype(np.int32)
        self.pair_rank = np.append(found[:, 1], NO_RANK).astype(np.int32)
        self.is_hasty = np.zeros(len(scores) + 1, bool)
        self.is_hasty[list(hasty)] = True

    def _blank_run(self, ids: dict[str, int]) -> int:
        """Length of the longest run of blanks that is a piece, or 0 where longer runs can't be cut into such pieces.

        They can if runs are merged after all else, at one rank, never with a letter, and one of that length becomes
        one piece: from the left, then, every longer run does so first.
        """
        runs = {len(p): i for p, i in ids.items() if set(p) == {BLANK}}
        longest = max(runs, default=0)
        made = np.isin(self.pair_piece[:-1], [i for n, i in runs.items() if n > 1])
        mixed = any(p.startswith(BLANK * 2) and set(p) != {BLANK} for p in ids)
        if longest < 2 or mixed or set(self.pair_rank[:-1][made].tolist()) != {int(self.pair_rank[:-1].max())}:
            return 0
        symbols, _ = self.merged(np.full(longest, ids[BLANK], np.int32), np.array([longest]))
        return longest if symbols.tolist() == [runs[longest]] else 0

    def _texts(self, library, pieces: list[str]) -> None:
        back = {i: bytes([b]) for b, i in self.bytes_at.items()}
        self.text_of, self.led = [], np.zeros(self.size, bool)
        for i, piece in enumerate(pieces):
            if library.is_control(i):
                self.text_of.append(b"")
            elif library.is_unknown(i):
                self.text_of.append(library.decode([i]).encode())
            else:
                self.led[i] = i not in back and piece.startswith(BLANK)
                self.text_of.append(back.get(i) or piece.replace(BLANK, " ").encode())

    def pairs(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Number of each pair, the last number if it makes no piece."""
        none = len(self.pair_keys)
        key = left.astype(np.int64) * self.size + right
        at = np.searchsorted(self.pair_keys, key)
        fits = (at < none) & (left < self.size) & (right < self.size)
        at[~fits] = 0
        return np.where(fits & (self.pair_keys[at] == key), at, none).astype(np.int32)

    def merged(self, symbols: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbols of words that lie end to end, each at least one long, after all merges; and the new lengths."""
        none = len(self.pair_keys)
        word = np.repeat(np.arange(len(lengths), dtype=np.int32), lengths)
        pair = np.full(len(symbols), none, np.int32)
        pair[:-1] = self.pairs(symbols[:-1], symbols[1:])
        pair[:-1][word[1:] != word[:-1]] = none
        done, done_words = [], []
        while len(symbols):
            rank = self.pair_rank[pair]
            first = np.flatnonzero(np.diff(word, prepend=-1))
            lowest = np.minimum.reduceat(rank, first)
            counts = np.diff(first, append=len(word))
            over = lowest == NO_RANK
            if over.any():
                gone = np.repeat(over, counts)
                done.append(symbols[gone])
                done_words.append(word[gone])
                symbols, word, pair, rank = symbols[~gone], word[~gone], pair[~gone], rank[~gone]
                lowest, counts = lowest[~over], counts[~over]
                if not len(symbols):
                    break
            at = self._far_places(rank) if len(counts) == 1 else self._places(rank, np.repeat(lowest, counts), word)
            symbols[at] = self.pair_piece[pair[at]]
            stays = np.ones(len(symbols), bool)
            stays[at + 1] = False
            symbols, word, pair = symbols[stays], word[stays], pair[stays]
            at -= np.arange(len(at))
            for place in (at, at[at > 0] - 1):
                right = np.minimum(place + 1, len(symbols) - 1)
                fits = (right > place) & (word[right] == word[place])
                pair[place] = np.where(fits, self.pairs(symbols[place], symbols[right]), none)
        if not done:
            return symbols, lengths
        symbols, word = np.concatenate(done), np.concatenate(done_words)
        return symbols[np.argsort(word, kind="stable")], np.bincount(word, minlength=len(lengths))

    def _places(self, rank: np.ndarray, lowest: np.ndarray, word: np.ndarray) -> np.ndarray:
        """Where each word's lowest rank can be merged at once."""
        at = np.flatnonzero(rank == lowest)
        hasty = self.is_hasty[rank[at]]
        keep = every_second(at)
        if hasty.any():
            keep &= ~hasty | (np.diff(word[at], prepend=-1) > 0) | (np.diff(at, prepend=-self.reach) >= self.reach)
        return at[keep]

    def _far_places(self, rank: np.ndarray) -> np.ndarray:
        """Where pairs of a single word can be merged at once: those that no pair in reach goes before.

        So a long word doesn't take a round for each rank in it.
        """
        before = least_before(rank, self.reach)
        after = least_before(rank[::-1], self.reach)[::-1]
        own = (rank <= after) & (rank < NO_RANK)
        own &= np.where(self.is_hasty[np.where(rank < NO_RANK, rank, 0)], rank < before, rank <= before)
        # Places in a row that bear one rank are taken from the first of them on, or wait for it.
        follows = np.append(False, rank[1:] == rank[:-1])
        starts = np.flatnonzero(~follows)
        own &= np.repeat(own[starts], np.diff(starts, append=len(rank)))
        at = np.flatnonzero(own)
        return at[every_second(at)]

    def encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all words end to end, number of ids of each). A word is without its first blank."""
        out, counts = [], []
        for part in self._parts(words):
            flat = "".join([BLANK + w for w in part]).replace(" ", BLANK)
            points = np.frombuffer(flat.encode("utf-32-le"), np.uint32)
            lengths = np.fromiter(map(len, part), np.int64, len(part)) + 1
            symbols, lengths = self.merged(self.symbol[points], lengths)
            ids, lengths = self._bytes_for_unknown(symbols, lengths)
            out.append(ids)
            counts.append(lengths)
        return np.concatenate([np.empty(0, np.int32), *out]), np.concatenate([np.empty(0, np.int64), *counts]).astype(np.int64)

    @staticmethod
    def _parts(words: list[str]) -> Iterator[list[str]]:
        """Words in order, as many as fit in a flat array; long ones alone."""
        part, held = [], 0
        for word in words:
            if part and (held + len(word) > FLAT_SYMBOLS or len(word) > LONG_WORD or held > LONG_WORD and len(part) == 1):
                yield part
                part, held = [], 0
            part.append(word)
            held += len(word) + 1
        if part:
            yield part

    def _bytes_for_unknown(self, symbols: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        unknown = np.flatnonzero(symbols >= self.size)
        if not len(unknown):
            return symbols, lengths
        coded = [[self.bytes_at[b] for b in chr(s - self.size).encode()] for s in symbols[unknown].tolist()]
        width = np.ones(len(symbols), np.int64)
        width[unknown] = [len(c) for c in coded]
        ids = np.repeat(symbols, width)
        ids[np.repeat(symbols >= self.size, width)] = [b for c in coded for b in c]
        return ids, np.add.reduceat(width, np.cumsum(lengths) - lengths)

    def words(self, text: str) -> list[str]:
        """The words of a text, each without its first blank."""
        text = text.replace(BLANK, " ")
        if "  " not in text and not text.startswith(" "):
            return text.split(" ")
        out = []
        for word in WORDS.findall(f" {text}"):
            if self.run and word.startswith(" " * (self.run + 1)):
                blanks = len(word) - len(word.lstrip(" "))
                runs = (blanks - 1) // self.run
                out += [" " * (self.run - 1)] * runs
                word = word[runs * self.run :]
            out.append(word[1:])
        return out

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text, with begin and end ids."""
        numbers: dict[str, int] = {}
        rows = []
        for text in texts:
            own = self.words(text) if text else []
            rows.append(np.fromiter((numbers.setdefault(w, len(numbers)) for w in own), np.int64, len(own)))
        ids, counts = self.encode_words(list(numbers))
        starts = np.cumsum(counts) - counts
        begin, end = np.array([self.begin], np.int32), np.array([self.end], np.int32)
        out = []
        for row in rows:
            width = counts[row]
            ends = np.cumsum(width)
            at = np.repeat(starts[row] - (ends - width), width) + np.arange(ends[-1] if len(ends) else 0)
            out.append(np.concatenate([begin, ids[at], end]))
        return out

    def decode(self, ids: np.ndarray) -> str:
        ids = ids[(ids >= 0) & (ids < self.size)]
        silent = np.flatnonzero(self.control[ids])
        # Bytes on both sides of a control id are no character.
        parts = [b"".join(map(self.text_of.__getitem__, part.tolist())) for part in np.split(ids, silent)]
        spoken = ids[~self.control[ids]]
        text = "".join(part.decode("utf-8", "hemeroteca-byte-by-byte") for part in parts)
        return text[1:] if len(spoken) and self.led[spoken[0]] else text


@cache
def piece_model(path: str) -> PieceModel:
    return PieceModel(path)


def encode(docs: DataFrame, model: str, text: str = "text", ids: str = "ids", keep_text: bool = True, packed: bool = False) -> DataFrame:
    """Add ``ids``, the piece ids of the whole text with begin and end ids, as the sentencepiece library gives them.

    They are a list of integers or, if ``packed``, their little-endian 32-bit bytes. A null or empty text has the begin
    and end ids alone. Names of control pieces in a text are ordinary text. Characters outside the vocabulary are
    given by their bytes. Other columns and repeated rows pass unchanged; a column named like ``ids`` is replaced. An
    empty table stays one. ``keep_text=False`` leaves the text out.
    """

    def work(texts: pa.Array) -> dict[str, pa.Array]:
        found = [row.tobytes() for row in piece_model(model).encode([t or "" for t in texts.to_pylist()])]
        return {ids: pa.array(found, pa.binary()) if packed else id_lists(found)}

    kind = "binary" if packed else "array<int>"
    return with_columns(docs, text, {ids: kind}, work, drop=() if keep_text else (text,), limit=SLICE, caches=(piece_model,))


def decode(rows: DataFrame, model: str, ids: str = "ids", text: str = "text") -> DataFrame:
    """Add ``text``, what the ids stand for; ``ids`` is a list of integers or packed as by ``encode``.

    The blank before the first word goes, control ids stand for nothing, as do ids outside the vocabulary and null
    ones. Bytes that aren't UTF-8 become U+FFFD each. Null ids give an empty text. Other columns pass unchanged.
    """

    def work(lists: pa.Array) -> dict[str, pa.Array]:
        own, out = piece_model(model), []
        for row in lists:
            if not row.is_valid:
                out.append("")
            elif pa.types.is_list(lists.type):
                out.append(own.decode(row.values.drop_null().to_numpy()))
            else:
                out.append(own.decode(np.frombuffer(row.as_py(), np.int32)))
        return {text: pa.array(out, pa.string())}

    return with_columns(rows, ids, {text: "string"}, work, limit=SLICE, caches=(piece_model,))
