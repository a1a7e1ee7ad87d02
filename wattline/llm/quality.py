"""Quality by attention-based multiple-instance learning.

A document is a bag of passages and only the bag has a label. Every passage is encoded; gated
attention, learned together with the encoder and the classifier from the labels of whole
documents, weighs the passages; the weighted mean is scored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
from pyspark.sql import Column, DataFrame

from wattline.llm.common import map_rows, texts
from wattline.llm.labelled import remainder, training_rows

#: Words of a passage.
PASSAGE = 48
#: Bounds of the training sample: documents, and passages of one document, evenly spread. Scoring reads all passages.
SAMPLE, SAMPLE_PASSAGES = 3000, 32
HIDDEN, GATE, ROUNDS, BATCH, RATE, DECAY = 24, 12, 25, 64, 3e-3, 1e-4

#: Classes of bytes: white space, line end, a-z, A-Z, digits, beyond ASCII, some signs, other signs, control.
CLASSES = 16
CLASS = np.full(256, 14, np.uint8)
CLASS[:32] = 15
CLASS[[9, 11, 12, 13, 32]] = 0
CLASS[10] = 1
CLASS[97:123] = 2
CLASS[65:91] = 3
CLASS[48:58] = 4
CLASS[128:] = 5
for _class, _signs in enumerate([b".", b",", b"!", b"|", b"*", b"$", b"%", b"&#@"], 6):
    CLASS[list(_signs)] = _class
#: Shares of byte pairs by class, then shares of distinct, repeated-in-place and new words, and word length.
WIDTH = CLASSES**2 + 4


def encoded(text: bytes) -> np.ndarray:
    """One row of ``WIDTH`` raw features per passage of the whole text; no rows for a text without words."""
    words = text.split()
    if not words:
        return np.zeros((0, WIDTH), np.float32)
    kinds = CLASS[np.frombuffer(text, np.uint8)]
    blank = kinds <= 1
    starts = np.flatnonzero(~blank & np.concatenate([[True], blank[:-1]]))
    count = -(-len(words) // PASSAGE)
    limits = np.append(starts[::PASSAGE], len(kinds))
    limits[0] = 0
    cells = np.repeat(np.arange(count, dtype=np.int32) * CLASSES**2, np.diff(limits))[:-1]
    cells += kinds[:-1] * np.int16(CLASSES) + kinds[1:]
    cells = np.bincount(cells, minlength=count * CLASSES**2)
    shares = cells.reshape(count, -1) / np.maximum(np.diff(limits), 1)[:, None]

    slices = [words[i : i + PASSAGE] for i in range(0, len(words), PASSAGE)]
    sizes = np.array([len(s) for s in slices])
    distinct = np.array([len(set(s)) for s in slices])
    stuck = np.array([sum(map(eq, s, s[1:])) for s in slices])
    seen: set[bytes] = set()
    known = [0]
    for s in slices:
        seen.update(s)
        known.append(len(seen))
    length = np.diff(limits) / sizes / 16.0
    extra = np.stack([distinct / sizes, stuck / sizes, np.diff(known) / sizes, np.minimum(length, 4)], 1)
    return np.hstack([np.sqrt(shares), extra]).astype(np.float32)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


@dataclass
class Model:
    """Encoder ``w, b``; attention ``v`` (tanh), ``u`` (gate) and ``a``; classifier ``c, d``."""

    mean: np.ndarray
    scale: np.ndarray
    parts: dict[str, np.ndarray]

    def forward(self, raw: np.ndarray, bags: np.ndarray, count: int) -> dict[str, np.ndarray]:
        p = self.parts
        x = (raw - self.mean) * self.scale
        h = np.tanh(x @ p["w"] + p["b"])
        t, g = np.tanh(h @ p["v"]), _sigmoid(h @ p["u"])
        e = np.exp(np.clip((t * g) @ p["a"], -30, 30))
        weights = e / np.maximum(np.bincount(bags, e, count), 1e-30)[bags]
        z = np.zeros((count, HIDDEN))
        np.add.at(z, bags, weights[:, None] * h)
        return {"x": x, "h": h, "t": t, "g": g, "weights": weights, "z": z, "score": _sigmoid(z @ p["c"] + p["d"])}

    def score(self, text: bytes) -> tuple[float, np.ndarray]:
        """The score of a whole text and the attention weights of its passages."""
        raw = encoded(text)
        p = self.parts
        if not len(raw):
            return float(_sigmoid(p["d"])[0]), np.zeros(0)
        h = np.tanh(((raw - self.mean) * self.scale) @ p["w"] + p["b"])
        e = np.exp(np.clip((np.tanh(h @ p["v"]) * _sigmoid(h @ p["u"])) @ p["a"], -30, 30))
        weights = e / e.sum()
        return float(_sigmoid(weights @ h @ p["c"] + p["d"])[0]), weights

    def gradients(self, raw: np.ndarray, bags: np.ndarray, wanted: np.ndarray) -> dict[str, np.ndarray]:
        """Of the cross entropy of a batch of bags."""
        p, f = self.parts, self.forward(raw, bags, len(wanted))
        x, h, t, g, weights, z = (f[k] for k in ("x", "h", "t", "g", "weights", "z"))
        error = (f["score"] - wanted) / len(wanted)
        by_bag = (error[:, None] * p["c"])[bags]
        by_weight = (h * by_bag).sum(1)
        by_e = weights * (by_weight - np.bincount(bags, weights * by_weight, len(wanted))[bags])
        by_gate = by_e[:, None] * p["a"]
        by_t, by_g = by_gate * g * (1 - t**2), by_gate * t * g * (1 - g)
        by_h = (weights[:, None] * by_bag + by_t @ p["v"].T + by_g @ p["u"].T) * (1 - h**2)
        return {
            "w": x.T @ by_h, "b": by_h.sum(0), "v": h.T @ by_t, "u": h.T @ by_g,
            "a": (t * g).T @ by_e, "c": z.T @ error, "d": np.array([error.sum()]),
        }


def learned(bags: list[np.ndarray], wanted: np.ndarray, seed: int = 7) -> Model:
    """Fit by Adam on bags of raw passages; the same bags in the same order give the same model."""
    rng = np.random.default_rng(seed)
    raw = np.concatenate([np.zeros((0, WIDTH), np.float32), *bags])
    mean = raw.mean(0) if len(raw) else np.zeros(WIDTH, np.float32)
    scale = 1 / np.maximum(raw.std(0) if len(raw) else np.ones(WIDTH), 0.02)
    parts = {
        "w": rng.normal(0, WIDTH**-0.5, (WIDTH, HIDDEN)), "b": np.zeros(HIDDEN),
        "v": rng.normal(0, HIDDEN**-0.5, (HIDDEN, GATE)), "u": rng.normal(0, HIDDEN**-0.5, (HIDDEN, GATE)),
        "a": rng.normal(0, GATE**-0.5, GATE), "c": rng.normal(0, HIDDEN**-0.5, HIDDEN), "d": np.zeros(1),
    }
    model = Model(mean.astype(np.float64), scale.astype(np.float64), parts)
    first, second = ({k: np.zeros_like(v) for k, v in parts.items()} for _ in range(2))
    step = 0
    for _ in range(ROUNDS if bags else 0):
        order = rng.permutation(len(bags))
        for begin in range(0, len(order), BATCH):
            chosen, step = order[begin : begin + BATCH], step + 1
            which = np.repeat(np.arange(len(chosen)), [len(bags[i]) for i in chosen])
            found = model.gradients(np.concatenate([bags[i] for i in chosen]), which, wanted[chosen])
            for k, grad in found.items():
                grad = grad + DECAY * parts[k]
                first[k] = 0.9 * first[k] + 0.1 * grad
                second[k] = 0.999 * second[k] + 0.001 * grad**2
                parts[k] -= RATE * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
    return model


def fit(
    docs: DataFrame,
    labels: DataFrame,
    usable: Column,
    label: str = "quality",
    id_column: str = "doc_id",
    text_column: str = "text",
    rows: int = SAMPLE,
    passages: int = SAMPLE_PASSAGES,
) -> Model:
    """Learn from at most ``rows`` labelled documents and ``passages`` of each, encoded on the executors.

    Without labels, or with an empty table, the model scores 0.5 for all. Rows without a number are not learned from; null texts are
    empty; of repeated numbers one text is learned from. Other columns are not looked at.
    """

    def each():
        def row(doc_id: int, label: int, text: bytes) -> Iterator[tuple]:
            raw = encoded(text)
            if len(raw) > passages:
                raw = raw[np.linspace(0, len(raw) - 1, passages).astype(int)]
            yield doc_id, label, raw.astype(np.float16).tobytes()

        return row

    sample = training_rows(docs, labels, label, usable, rows, id_column, text_column)
    found = map_rows(sample, "doc_id long, label int, raw binary", each).collect()
    found.sort(key=lambda r: (r[0], r[1], bytes(r[2])))
    bags = [np.frombuffer(r[2], np.float16).reshape(-1, WIDTH).astype(np.float32) for r in found]
    return learned(bags, np.array([float(r[1] > 0) for r in found]))


def scored(df: DataFrame, model: Model, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id, score, weights``: 0 to 1, higher means better, and the attention weight of every passage.

    Whole texts are read. Null and empty texts have no passage and get the score of an empty bag.
    Rows without a number and repeated rows are scored by themselves. Other columns are not looked at; an empty table gives no
    rows.
    """

    def each():
        def row(doc_id: int | None, text: bytes) -> Iterator[tuple]:
            score, weights = model.score(text)
            yield doc_id, score, weights.astype(np.float32).tolist()

        return row

    return map_rows(texts(df, id_column, text_column), "doc_id long, score double, weights array<float>", each)


def not_held_out(modulus: int = 3, held_out: int = 1) -> Column:
    return remainder("doc_id", modulus) != held_out
