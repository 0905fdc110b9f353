"""Quality rules: a linear-chain conditional random field marks each line as content or boilerplate.

Counts over the whole text fail the plainest junk. The field labels the rest: its most likely line sequence, by
Viterbi decoding, gives the share of the text that is content, and that share decides. The weights are fitted to
documents marked good or bad, whose lines count as content or boilerplate.
"""

from __future__ import annotations

import math
from collections import defaultdict
from dataclasses import dataclass
from itertools import count
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from hemeroteca.llm.batches import with_columns
from hemeroteca.llm.samples import labelled_texts

SYMBOLS = "#*$%&|<>"
BLANKS = " \t\n\v\f\r"
FEATURES = 11
#: Share of a text's line characters that must be content.
LEAST_CONTENT = 0.5
#: Bounds of the sample that the weights are fitted to: rows, and characters of a text.
SAMPLE_ROWS, SAMPLE_CHARS = 3000, 50_000
#: Lines of a training sequence; longer documents are several sequences.
SEQUENCE = 32
_NO_UPPER, _NO_DIGIT = bytes(range(65, 91)), b"0123456789"

COLUMNS = {
    "n_words": "long", "word_chars": "long", "n_symbols": "long", "n_dup_lines": "long", "n_repeat_words": "long",
    "base_failed": "boolean", "content_share": "double", "content_lines": "array<int>", "kept": "boolean",
}


@dataclass
class Field:
    """Weights of the label "content" against "boilerplate"; ``steps[i, j]`` goes from label i to j."""

    weights: np.ndarray
    steps: np.ndarray


#: Without labelled rows of both kinds every line is content.
ALL_CONTENT = Field(np.eye(1, FEATURES)[0], np.zeros((2, 2)))


def repeated_words(words: list[bytes]) -> int:
    """Words that lie in a window of three that occurs twice or more."""
    n = len(words)
    if n < 4:
        return 0
    numbers: defaultdict[bytes, int] = defaultdict(count().__next__)
    ids = np.fromiter(map(numbers.__getitem__, words), np.int64, n)
    pairs, m = ids[:-2] * len(numbers) + ids[1:-1], len(numbers)
    if m**3 >= 2**63:
        pairs = np.unique(pairs, return_inverse=True)[1]
    _, at, often = np.unique(pairs * m + ids[2:], return_inverse=True, return_counts=True)
    twice = often[at] > 1
    inside = np.zeros(n, bool)
    for shift in range(3):
        inside[shift : n - 2 + shift] |= twice
    return int(inside.sum())


def line_features(line: str, words: list[bytes], again: bool) -> tuple[float, ...]:
    """What the field sees of a line with a word in it."""
    n, raw = len(words), line.encode()
    size = len(raw)
    return (
        1.0,
        math.log1p(n) / 4,
        min(1.0, sum(map(line.count, SYMBOLS)) / n),
        2 * (size - len(raw.translate(None, _NO_UPPER))) / size,
        min(1.0, line.count("!") / n),
        1 - len(set(words)) / n,
        sum(map(eq, words, words[1:])) / n,
        float(again),
        float(raw.rstrip()[-1:] in (b".", b"!", b"?")),
        min(2.0, size / n / 10),
        (size - len(raw.translate(None, _NO_DIGIT))) / size,
    )


def read_lines(text: str) -> tuple[list[int], list[list[bytes]], np.ndarray, list[int], int]:
    """Of the lines with a word: number, words, features and characters; and how many equal an earlier one."""
    numbers, worded, features, sizes, seen, again = [], [], [], [], set(), 0
    for number, line in enumerate(text.split("\n")):
        words = line.encode().split()  # bytes: ASCII white space alone
        if words:
            repeated = line in seen
            again += repeated
            seen.add(line)
            numbers.append(number)
            worded.append(words)
            features.append(line_features(line, words, repeated))
            sizes.append(len(line))
    return numbers, worded, np.array(features).reshape(-1, FEATURES), sizes, again


def viterbi(scores: np.ndarray, steps: np.ndarray) -> list[bool]:
    """Which lines are content in the most likely sequence; of equal ones, the one with content last."""
    (bb, bc), (cb, cc) = steps.tolist()
    back, bad, good = [], 0.0, None
    for score in scores.tolist():
        if good is None:
            good = score
            continue
        from_bad_b, from_good_b, from_bad_c, from_good_c = bad + bb, good + cb, bad + bc, good + cc
        back.append((from_good_b >= from_bad_b, from_good_c >= from_bad_c))
        bad, good = max(from_bad_b, from_good_b), max(from_bad_c, from_good_c) + score
    if good is None:
        return []
    path = [good >= bad]
    for to_bad, to_good in reversed(back):
        path.append(to_good if path[-1] else to_bad)
    return path[::-1]


def judge_text(text: str, field: Field) -> tuple:
    """Values of ``COLUMNS`` for one text."""
    numbers, worded, features, sizes, again = read_lines(text)
    words = [w for line in worded for w in line]
    n, repeats = len(words), repeated_words(words)
    failed = n < 50 or 100 * repeats > 50 * n
    content = viterbi(features @ field.weights, field.steps)
    share = sum(s for s, c in zip(sizes, content, strict=True) if c) / sum(sizes) if sizes else 0.0
    return (
        n, len(text) - sum(map(text.count, BLANKS)), sum(map(text.count, SYMBOLS)), again, repeats, failed, share,
        [i for i, c in zip(numbers, content, strict=True) if c], not failed and share >= LEAST_CONTENT,
    )


def _log_add(a: np.ndarray, axis: int) -> np.ndarray:
    most = a.max(axis=axis, keepdims=True)
    return (most + np.log(np.exp(a - most).sum(axis=axis, keepdims=True))).squeeze(axis)


def fit_field(sequences: list[np.ndarray], labels: list[int], rounds: int = 200, decay: float = 1e-3) -> Field:
    """Most likely weights, by gradient ascent; the gradient is what was seen less what the field expects.

    ``sequences`` hold one row of features a line; all lines of a sequence bear its label.
    """
    cut = [(s[i : i + SEQUENCE], y) for s, y in zip(sequences, labels, strict=True) for i in range(0, len(s), SEQUENCE)]
    if len({y for _, y in cut}) < 2:
        return ALL_CONTENT
    n, length = len(cut), max(len(s) for s, _ in cut)
    x, there, y = np.zeros((n, length, FEATURES)), np.zeros((n, length), bool), np.array([y for _, y in cut])
    for i, (s, _) in enumerate(cut):
        x[i, : len(s)], there[i, : len(s)] = s, True
    lines, moves = there.sum(), max(1, there[:, 1:].sum())
    seen_w = x[y == 1].sum(axis=(0, 1))
    seen_t = np.diag([there[y == k, 1:].sum() for k in (0, 1)]).astype(float)
    both = np.zeros(FEATURES + 4)
    speed, swing = np.zeros_like(both), np.zeros_like(both)
    for step in range(1, rounds + 1):
        w, t = both[:FEATURES], both[FEATURES:].reshape(2, 2)
        s = np.stack([np.zeros((n, length)), x @ w], axis=2)
        ahead = np.zeros((n, length, 2))
        ahead[:, 0] = s[:, 0]
        for i in range(1, length):
            moved = _log_add(ahead[:, i - 1, :, None] + t, 1) + s[:, i]
            ahead[:, i] = np.where(there[:, i, None], moved, ahead[:, i - 1])
        total = _log_add(ahead[:, -1], 1)
        behind, expected_t = np.zeros((n, 2)), np.zeros((2, 2))
        share = np.zeros((n, length))
        for i in range(length - 1, -1, -1):
            share[:, i] = np.exp(ahead[:, i, 1] + behind[:, 1] - total) * there[:, i]
            if i:
                onward = t + (s[:, i] + behind)[:, None, :]
                joint = np.exp(ahead[:, i - 1, :, None] + onward - total[:, None, None])
                expected_t += (joint * there[:, i, None, None]).sum(axis=0)
                behind = np.where(there[:, i, None], _log_add(onward, 2), behind)
        slope_w = (seen_w - (x * share[:, :, None]).sum(axis=(0, 1))) / lines
        slope_t = (seen_t - expected_t) / moves
        slope = np.concatenate([slope_w, slope_t.ravel()]) - decay * both
        speed, swing = 0.9 * speed + 0.1 * slope, 0.99 * swing + 0.01 * slope**2
        both = both + 0.15 * (speed / (1 - 0.9**step)) / (np.sqrt(swing / (1 - 0.99**step)) + 1e-8)
    return Field(both[:FEATURES], both[FEATURES:].reshape(2, 2))


def fit(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS, longest: int = SAMPLE_CHARS) -> Field:
    """Fit to a sample of at most ``rows`` labelled documents; their line features are gathered in the driver."""
    sample = labelled_texts(docs, labels, "quality", rows, longest)

    def work(texts: pa.Array) -> dict[str, pa.Array]:
        made = [read_lines(t)[2].astype("<f4").tobytes() for t in texts.to_pylist()]
        return {"features": pa.array(made, pa.binary())}

    found = with_columns(sample, "text", {"features": "binary"}, work).select("features", "label").collect()
    features = [np.frombuffer(r["features"], "<f4").reshape(-1, FEATURES).astype(float) for r in found]
    return fit_field(features, [r["label"] for r in found])


def judge(docs: DataFrame, field: Field, text: str = "text") -> DataFrame:
    """Add ``COLUMNS``; columns of these names are replaced, others and repeated rows pass unchanged.

    ``content_lines`` numbers the content lines from 0. Lines without a word are skipped. A null text counts as
    empty: it has no words and fails. An empty table stays one.
    """

    def work(texts: pa.Array) -> dict[str, pa.Array]:
        rows = [judge_text(t or "", field) for t in texts.to_pylist()]
        types = {"long": pa.int64(), "boolean": pa.bool_(), "double": pa.float64(), "array<int>": pa.list_(pa.int32())}
        columns = list(zip(*rows, strict=True))
        return {c: pa.array(v, types[kind]) for (c, kind), v in zip(COLUMNS.items(), columns, strict=True)}

    return with_columns(docs, text, COLUMNS, work)
