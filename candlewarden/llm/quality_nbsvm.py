"""Quality scores by Naive Bayes support vectors.

Features are indicators of n-grams: words, word pairs, and pairs of word shapes (which see capitals,
signs and repetition whatever the words are), hashed into ``DIMENSIONS``. Each indicator is scaled by
the log-ratio of its smoothed frequencies in the two classes; a linear hinge-loss model on the scaled
indicators is fitted by dual coordinate descent, and its margins are turned into scores by a logistic
curve through a part of the sample that the weights have not seen.
"""

from __future__ import annotations

import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlewarden.llm.common import Memo, append_columns, labelled_sample
from candlewarden.llm.models import curve, fit_once, logistic

DIMENSIONS = 1 << 18
SAMPLE = 12_000  # about so many labelled documents are learned from, or all if fewer
SMOOTH = 1.0
COST = 0.5
ROUNDS = 12
THRESHOLD = 0.3

_SHAPES = ((re.compile(r"[^\W\d_a-zß-öø-ÿ]{2,}"), "AA"), (re.compile(r"[^\W\d_A-ZÀ-ÖØ-Þ]+"), "a"), (re.compile(r"\d+"), "0"))


def _codes(word: bytes) -> int:
    """A hash of the word without case, and one of its shape, in one number."""
    plain = word.decode()
    shape = plain
    for pattern, short in _SHAPES:
        shape = pattern.sub(short, shape)
    return zlib.crc32(plain.lower().encode()) << 16 | zlib.crc32(shape[:12].encode()) & 0xFFFF


_MEMO = Memo(_codes)


def features(text: bytes) -> np.ndarray:
    """The distinct feature numbers of a whole text, ascending."""
    words = text.split()
    if not words:
        return np.empty(0, np.int32)
    codes = np.fromiter(map(_MEMO.__getitem__, words), np.int64, len(words))
    word, shape = (codes >> 16).astype(np.uint64), (codes & 0xFFFF).astype(np.uint64)
    mix = np.uint64(0x9E3779B97F4A7C15)
    pair = (word[:-1] * np.uint64(31) + word[1:] + np.uint64(1)) * mix
    same = np.where(word[:-1] == word[1:], np.uint64(7), np.uint64(3))
    shapes = ((shape[:-1] << np.uint64(16) | shape[1:]) * np.uint64(8) + same) * mix
    single = (shape + np.uint64(1 << 40)) * mix
    everything = np.concatenate([word * mix, pair, shapes, single]) >> np.uint64(46)
    return np.unique(everything).astype(np.int32)  # 64 - 46 = 18 bits


def _descend(rows: list[np.ndarray], y: np.ndarray, ratio: np.ndarray, seed: int = 7) -> tuple[np.ndarray, float, np.ndarray]:
    """Weights on plain indicators (the ratio included), a bias and the dual values, by dual coordinate descent on the hinge loss."""
    w, bias, alpha = np.zeros(len(ratio)), 0.0, np.zeros(len(rows))
    values = [ratio[r] / np.sqrt(max(1, len(r))) for r in rows]
    norms = np.array([v @ v + 1.0 for v in values])
    order = np.random.default_rng(seed)
    for _ in range(ROUNDS):
        moved = 0.0
        for i in order.permutation(len(rows)):
            r, v = rows[i], values[i]
            slope = y[i] * (w[r] @ v + bias) - 1
            new = min(max(alpha[i] - slope / norms[i], 0.0), COST)
            change = (new - alpha[i]) * y[i]
            if change:
                w[r] += change * v
                bias += change
                alpha[i] = new
                moved = max(moved, abs(change))
        if moved < 1e-3:
            break
    return w * ratio, bias, alpha


def fit(rows: list) -> dict:
    """Weights (32-bit), bias and calibration from (features, label, lang) rows."""
    codes, labels = [r[0] for r in rows], np.array([r[1] for r in rows], int)
    if len(rows) == 0 or labels.min() == labels.max():
        slope, intercept = logistic(np.zeros(len(rows)), labels)
        return {"weights": np.zeros(DIMENSIONS, np.float32), "bias": 0.0, "slope": slope, "intercept": intercept}
    apart = np.arange(len(rows)) % 5 == 4 if len(rows) >= 200 else np.zeros(len(rows), bool)
    learn = np.flatnonzero(~apart)
    count = np.full((2, DIMENSIONS), SMOOTH)
    for i in learn:
        count[labels[i], codes[i]] += 1
    ratio = np.log(count[1] / count[1].sum()) - np.log(count[0] / count[0].sum())
    weights, bias, _ = _descend([codes[i] for i in learn], np.where(labels[learn] == 1, 1.0, -1.0), ratio)
    model = {"weights": weights.astype(np.float32), "bias": bias}
    check = np.flatnonzero(apart) if apart.any() and len(set(labels[apart])) == 2 else learn
    margins = np.array([_margin(model, codes[i]) for i in check])
    model["slope"], model["intercept"] = logistic(margins, labels[check])
    return model


def _margin(model: dict, codes: np.ndarray) -> float:
    return float(model["weights"][codes].sum()) / np.sqrt(max(1, len(codes))) + model["bias"]


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", most: int = SAMPLE) -> dict:
    """A model from about ``most`` labelled documents outside the held-out fold; a pure function of them."""
    return fit_once(labelled_sample(docs, labels, label, most), features, fit)


def score(docs: DataFrame, model: dict, text: str = "text") -> DataFrame:
    """All columns of ``docs`` with score (0 to 1) and predicted. Null text is scored like an empty one, repeated rows alike."""
    if "predicted" in docs.columns:
        raise ValueError("the input already has predicted")

    def compute(texts: list[bytes]) -> dict[str, pa.Array]:
        margins = np.array([_margin(model, features(x)) for x in texts])
        return {"score": pa.array(curve(margins, model["slope"], model["intercept"]), pa.float64())}

    return append_columns(docs, text, "score double", compute).withColumn(
        "predicted", (F.col("score") >= THRESHOLD).cast("int")
    )
