"""Quality classifier: attention-based multiple-instance learning.

A document is a bag of passages and only the bag has a label. Every passage is encoded; gated attention,
tanh times sigmoid, weighs the passages of a bag against each other; the weighted sum of their encodings is
scored. Encoder, attention and score are learned together from document labels.
"""

from __future__ import annotations

from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from hemeroteca.llm.batches import with_columns
from hemeroteca.llm.samples import labelled_texts

#: Bytes of a passage.
PASSAGE = 512
#: Bounds of the sample that the model is fitted to: rows, and characters of a text.
SAMPLE_ROWS, SAMPLE_CHARS = 3000, 50_000
_GROUPS = (b" ", b"\n\r\t\v\f", b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b".,;:", b"!?", b"#*$%&|<>", bytes(range(128, 192)), bytes(range(192, 256)))
KINDS = len(_GROUPS) + 1
FEATURES = KINDS * KINDS + 3
HIDDEN, GATE = 16, 8


def _kinds() -> np.ndarray:
    out = np.full(256, KINDS - 1, np.int64)
    for kind, group in enumerate(_GROUPS):
        out[list(group)] = kind
    return out


_KIND = _kinds()


def passages(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Features of all passages of all texts, and where each text's passages start. An empty text has one passage."""
    raws = [t.encode() for t in texts]
    counts = np.array([max(1, -(-len(r) // PASSAGE)) for r in raws])
    starts = np.cumsum(counts) - counts
    total = int(counts.sum())
    sizes = np.zeros(total)
    repeats = np.zeros((total, 2))
    pair_counts = np.zeros(total * KINDS * KINDS)
    for raw, start in zip(raws, starts, strict=True):
        if not raw:
            continue
        kinds = _KIND[np.frombuffer(raw, np.uint8)]
        at = np.arange(len(raw)) // PASSAGE
        pairs = at[:-1] * (KINDS * KINDS) + kinds[:-1] * KINDS + kinds[1:]
        own = np.bincount(pairs, minlength=(at[-1] + 1) * KINDS * KINDS)
        pair_counts[start * KINDS * KINDS : start * KINDS * KINDS + len(own)] = own
        for n, i in enumerate(range(0, len(raw), PASSAGE)):
            part = raw[i : i + PASSAGE]
            words = part.split()
            sizes[start + n] = len(part)
            if words:
                repeats[start + n] = 1 - len(set(words)) / len(words), sum(map(eq, words, words[1:])) / len(words)
    shares = np.sqrt(pair_counts.reshape(total, -1) / np.maximum(sizes, 1)[:, None])
    return np.hstack([shares, repeats, np.log1p(sizes)[:, None] / 6]), starts


@dataclass
class Model:
    mean: np.ndarray
    spread: np.ndarray
    parts: dict[str, np.ndarray]

    def scores(self, x: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Each bag's score, and each passage's weight in its bag."""
        forward = _forward(self.parts, (x - self.mean) / self.spread, starts)
        return forward["score"], forward["share"]


#: Without labelled rows of both kinds all texts score alike.
UNTAUGHT = Model(np.zeros(FEATURES), np.ones(FEATURES), {
    "encode": np.zeros((FEATURES, HIDDEN)), "encode_0": np.zeros(HIDDEN), "gate_v": np.zeros((HIDDEN, GATE)),
    "gate_u": np.zeros((HIDDEN, GATE)), "gate": np.zeros(GATE), "out": np.zeros(HIDDEN), "out_0": np.zeros(1)})


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def _forward(p: dict[str, np.ndarray], x: np.ndarray, starts: np.ndarray) -> dict[str, np.ndarray]:
    bag = np.repeat(np.arange(len(starts)), np.diff([*starts, len(x)]))
    h = np.tanh(x @ p["encode"] + p["encode_0"])
    v, u = np.tanh(h @ p["gate_v"]), _sigmoid(h @ p["gate_u"])
    pull = (v * u) @ p["gate"]
    pull = np.exp(pull - np.maximum.reduceat(pull, starts)[bag])
    share = pull / np.add.reduceat(pull, starts)[bag]
    z = np.add.reduceat(share[:, None] * h, starts)
    return {"bag": bag, "h": h, "v": v, "u": u, "share": share, "z": z, "score": _sigmoid(z @ p["out"] + p["out_0"])}


def loss(p: dict[str, np.ndarray], x: np.ndarray, starts: np.ndarray, y: np.ndarray) -> float:
    """Mean log loss over the bags."""
    score = _forward(p, x, starts)["score"]
    return float(-np.mean(y * np.log(score) + (1 - y) * np.log(1 - score)))


def slopes(p: dict[str, np.ndarray], x: np.ndarray, starts: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
    """The gradient of ``loss`` in every weight."""
    f = _forward(p, x, starts)
    bag, h, v, u, share = f["bag"], f["h"], f["v"], f["u"], f["share"]
    off = (f["score"] - y) / len(y)
    d_z = off[:, None] * p["out"]
    d_h = share[:, None] * d_z[bag]
    d_share = (h * d_z[bag]).sum(axis=1)
    d_pull = share * (d_share - np.add.reduceat(share * d_share, starts)[bag])
    d_v, d_u = d_pull[:, None] * p["gate"] * u * (1 - v**2), d_pull[:, None] * p["gate"] * v * u * (1 - u)
    d_h = (d_h + d_v @ p["gate_v"].T + d_u @ p["gate_u"].T) * (1 - h**2)
    return {
        "encode": x.T @ d_h, "encode_0": d_h.sum(axis=0), "gate_v": h.T @ d_v, "gate_u": h.T @ d_u,
        "gate": (v * u).T @ d_pull, "out": f["z"].T @ off, "out_0": np.array([off.sum()]),
    }


def fit_bags(x: np.ndarray, starts: np.ndarray, y: np.ndarray, rounds: int = 150, decay: float = 1e-4) -> Model:
    """Learn from bags of passages by gradient descent on the log loss."""
    if len(set(y.tolist())) < 2:
        return UNTAUGHT
    mean, spread = x.mean(axis=0), x.std(axis=0) + 1e-3
    x = (x - mean) / spread
    random = np.random.default_rng(8)
    p = {name: random.normal(0, 0.5 / np.sqrt(max(1, v.shape[0])), v.shape) for name, v in UNTAUGHT.parts.items()}
    p |= {"encode_0": np.zeros(HIDDEN), "out_0": np.zeros(1)}
    speed, swing = {k: np.zeros_like(v) for k, v in p.items()}, {k: np.zeros_like(v) for k, v in p.items()}
    for step in range(1, rounds + 1):
        slope = slopes(p, x, starts, y)
        for k, own in p.items():
            g = slope[k] + decay * own
            speed[k], swing[k] = 0.9 * speed[k] + 0.1 * g, 0.99 * swing[k] + 0.01 * g**2
            p[k] = own - 0.02 * (speed[k] / (1 - 0.9**step)) / (np.sqrt(swing[k] / (1 - 0.99**step)) + 1e-8)
    return Model(mean, spread, p)


def fit(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS, longest: int = SAMPLE_CHARS, label: str = "quality") -> Model:
    """Fit to a sample of at most ``rows`` labelled documents; their passages' features are gathered in the driver."""
    sample = labelled_texts(docs, labels, label, rows, longest)

    def work(texts: pa.Array) -> dict[str, pa.Array]:
        return {"features": pa.array([passages([t])[0].astype("<f4").tobytes() for t in texts.to_pylist()], pa.binary())}

    found = with_columns(sample, "text", {"features": "binary"}, work).select("features", "label").collect()
    if not found:
        return UNTAUGHT
    bags = [np.frombuffer(r["features"], "<f4").reshape(-1, FEATURES).astype(float) for r in found]
    sizes = np.array([len(b) for b in bags])
    return fit_bags(np.vstack(bags), np.cumsum(sizes) - sizes, np.array([r["label"] for r in found], float))


def score(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """Add ``score`` (0 to 1, higher: label 1 likelier) and ``top_passage``, the number of the heaviest passage.

    A null text counts as empty; an empty text is one empty passage, and has a score. Columns of these names are
    replaced, others and repeated rows pass unchanged. An empty table stays one.
    """

    def work(texts: pa.Array) -> dict[str, pa.Array]:
        scores, tops = [], []
        held: list[str] = []
        size = 0

        def flush():
            x, starts = passages(held)
            own, share = model.scores(x, starts)
            scores.extend(own.tolist())
            tops.extend(int(np.argmax(s)) for s in np.split(share, starts[1:]))
            held.clear()

        for t in texts.to_pylist():
            held.append(t or "")
            size += len(held[-1]) + PASSAGE
            if size > 1 << 20:
                flush()
                size = 0
        if held:
            flush()
        return {"score": pa.array(scores, pa.float64()), "top_passage": pa.array(tops, pa.int32())}

    return with_columns(docs, text, {"score": "double", "top_passage": "int"}, work)
