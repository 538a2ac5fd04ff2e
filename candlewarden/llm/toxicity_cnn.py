"""Toxicity scores by a convolutional text classifier, trained in numpy.

Words are hashed to 32 bits; hashes that enough documents of the sample have get an embedding each, at
most ``BUCKETS``, and all others share one. Filters of one, two and three words slide over the whole
text, each keeps its maximum, and a logistic layer joins them. Max pooling passes a gradient only to the
place of the maximum, so a step touches a few embeddings. The first coordinate of an embedding starts as
the log-ratio of its word's document frequencies in the two classes, and the first filters start on it.

For scoring, a filter's product with every embedding is tabulated once, so a text costs gathers, sums
and a running maximum, block by block.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlewarden.llm.common import Memo, append_columns, labelled_sample
from candlewarden.llm.models import curve, fit_once, logistic

BUCKETS = 1 << 17
SEEN = 2  # documents of the sample that must have a word
SIZE = 8
WIDTHS = (1, 2, 3)
FILTERS = 6
SAMPLE = 12_000  # about so many labelled documents are learned from, or all if fewer
ROUNDS = 6
RATE = 0.05
THRESHOLD = 0.5
FALSE_ALARMS = 0.02  # most clean documents a language's threshold may reject in the sample
_BLOCK = 1 << 16
_PAD = 2

_STRIP = b".,;:!?\"'()[]*#$%&|<>-"
_MEMO = Memo(lambda word: zlib.crc32(word.lower().strip(_STRIP)) - (1 << 31))


def word_codes(text: bytes) -> np.ndarray:
    """32-bit hashes of the words of a whole text, in order."""
    words = text.split()
    return np.fromiter(map(_MEMO.__getitem__, words), np.int32, len(words))


def _vocabulary(docs: list[np.ndarray]) -> np.ndarray:
    """The hashes that have an embedding, ascending: those in at least SEEN documents, the most frequent first."""
    hashes, counts = np.unique(np.concatenate([np.empty(0, np.int32), *map(np.unique, docs)]), return_counts=True)
    hashes, counts = hashes[counts >= SEEN], counts[counts >= SEEN]
    return np.sort(hashes[np.argsort(-counts, kind="stable")[: BUCKETS - 1]])


def embedding_rows(known: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """Rows of the embedding table; 0 is shared by unknown words and by the padding at the end."""
    if not len(known):
        return np.zeros(len(codes), np.int64)
    at = np.minimum(np.searchsorted(known, codes), len(known) - 1)
    return np.where(known[at] == codes, at + 1, 0)


def _padded(codes: np.ndarray) -> np.ndarray:
    return np.concatenate([codes, np.zeros(_PAD + (len(codes) == 0), np.int64)])


def _tables(model: dict) -> list[list[np.ndarray]]:
    return [[(model["words"] @ kernel[j]).astype(np.float32) for j in range(len(kernel))] for kernel in model["kernels"]]


def _pooled(tables: list[list[np.ndarray]], codes: np.ndarray) -> np.ndarray:
    """The maximum of every filter over the whole text, before bias and cut at zero."""
    codes = _padded(codes)
    best = np.full((len(WIDTHS), FILTERS), -np.inf, np.float32)
    for start in range(0, len(codes) - _PAD, _BLOCK):
        own = codes[start : start + _BLOCK + _PAD]
        n = len(own) - _PAD
        for k, table in enumerate(tables):
            at = table[0][own[:n]]
            for j in range(1, len(table)):
                at = at + table[j][own[j : j + n]]
            np.maximum(best[k], at.max(axis=0), out=best[k])
    return best.ravel()


def margin(model: dict, tables: list[list[np.ndarray]], codes: np.ndarray) -> float:
    """The logistic layer's value for a text given by its word hashes."""
    pooled = _pooled(tables, embedding_rows(model["known"], codes))
    return float(np.maximum(pooled + model["shift"], 0) @ model["out"] + model["bias"])


def _start(docs: list[np.ndarray], y: np.ndarray, rng: np.random.Generator) -> dict:
    known = _vocabulary(docs)
    docs = [embedding_rows(known, codes) for codes in docs]
    words = rng.normal(0, 0.1, (len(known) + 1, SIZE)).astype(np.float32)
    seen = np.ones((2, len(words)))
    for codes, label in zip(docs, y, strict=True):
        seen[label, np.unique(codes)] += 1
    ratio = np.log(seen[1] / (y.sum() + 2)) - np.log(seen[0] / (len(y) - y.sum() + 2))
    words[:, 0] = np.where(np.arange(len(words)) == 0, -1.0, np.clip(ratio, -3, 3))
    kernels = [rng.normal(0, 0.1, (h, SIZE, FILTERS)).astype(np.float32) for h in WIDTHS]
    for kernel in kernels:
        kernel[:, 0, : FILTERS // 2] += 1.0 / len(kernel)
    n = len(WIDTHS) * FILTERS
    out = np.where(np.arange(n) % FILTERS < FILTERS // 2, 0.5, 0.0).astype(np.float32)
    return {"known": known, "words": words, "kernels": kernels, "shift": np.zeros(n, np.float32), "out": out, "bias": -1.0}


def _learn(model: dict, docs: list[np.ndarray], y: np.ndarray, weight: np.ndarray, rng: np.random.Generator) -> None:
    """Adagrad on the logistic loss; the gradient of a maximum goes to the words of its place."""
    words, kernels = model["words"], model["kernels"]
    sums = {k: np.full(np.shape(model[k]), 1e-2, np.float32) for k in ("words", "shift", "out")}
    kernel_sums, bias_sum = [np.full(k.shape, 1e-2, np.float32) for k in kernels], 1e-2
    for _ in range(ROUNDS):
        for i in rng.permutation(len(docs)):
            codes = _padded(docs[i])
            n, seen = len(codes) - _PAD, words[codes]
            places, tops = [], []
            for kernel in kernels:
                at = sum(seen[j : j + n] @ kernel[j] for j in range(len(kernel)))
                places.append(at.argmax(axis=0))
                tops.append(at[places[-1], np.arange(FILTERS)])
            raw = np.concatenate(tops) + model["shift"]
            active = np.maximum(raw, 0)
            error = weight[i] * (1 / (1 + np.exp(-np.clip(active @ model["out"] + model["bias"], -30, 30))) - y[i])
            if abs(error) < 1e-3:
                continue
            back = error * model["out"] * (raw > 0)
            for k, kernel in enumerate(kernels):
                own = back[k * FILTERS : (k + 1) * FILTERS]
                for j in range(len(kernel)):
                    at = codes[places[k] + j]
                    slope = kernel[j].T * own[:, None]  # per filter, for the word at its place
                    kernel_slope = words[at].T * own
                    kernel_sums[k][j] += kernel_slope**2
                    kernel[j] -= RATE * kernel_slope / np.sqrt(kernel_sums[k][j])
                    np.add.at(sums["words"], at, slope**2)
                    np.add.at(words, at, -RATE * slope / np.sqrt(sums["words"][at]))
            for name, slope in (("shift", back), ("out", error * active)):
                sums[name] += slope**2
                model[name] -= (RATE * slope / np.sqrt(sums[name])).astype(np.float32)
            bias_sum += error**2
            model["bias"] -= float(RATE * error / np.sqrt(bias_sum))


def _thresholds(scores: np.ndarray, labels: np.ndarray, langs: list) -> dict:
    """The least threshold of at least THRESHOLD, by language, that rejects few enough clean documents.

    A language with under 50 clean documents in the sample takes the one of all languages (key "").
    """
    found = {}
    for lang in ["", *sorted({x for x in langs if x is not None})]:
        clean = np.sort(scores[(labels == 0) & np.array([lang in ("", x) for x in langs], bool)])[::-1]
        if len(clean) >= 50 or lang == "":
            allowed = int(FALSE_ALARMS * len(clean))
            limit = np.nextafter(clean[allowed], 2) if len(clean) > allowed else THRESHOLD
            found[lang] = float(max(THRESHOLD, limit))
    return found


def fit(rows: list) -> dict:
    """Parameters, calibration and thresholds from (word codes, label, lang) rows."""
    codes, labels, langs = [r[0] for r in rows], np.array([r[1] for r in rows], int), [r[2] for r in rows]
    rng = np.random.default_rng(11)
    apart = np.arange(len(rows)) % 4 == 3 if len(rows) >= 200 else np.zeros(len(rows), bool)
    learn = np.flatnonzero(~apart)
    model = _start([codes[i] for i in learn], labels[learn], rng)
    if len(rows) and labels.min() != labels.max():
        toxic = learn[labels[learn] == 1]
        # all of the sample that is not kept for calibration, toxic rows weighted up by their rarity
        weight = np.where(labels[learn] == 1, (len(learn) - len(toxic)) / max(1, len(toxic)), 1.0) ** 0.5
        _learn(model, [embedding_rows(model["known"], codes[i]) for i in learn], labels[learn], weight, rng)
    check = np.flatnonzero(apart) if apart.any() and len(set(labels[apart])) == 2 else learn
    tables = _tables(model)
    margins = np.array([margin(model, tables, codes[i]) for i in check])
    model["slope"], model["intercept"] = logistic(margins, labels[check])
    model["thresholds"] = _thresholds(curve(margins, model["slope"], model["intercept"]), labels[check], [langs[i] for i in check])
    model["words"] = model["words"].astype(np.float16)
    return model


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", most: int = SAMPLE) -> dict:
    """A model from about ``most`` labelled documents outside the held-out fold; a pure function of them.

    Three quarters of them train the filters, the last quarter sets the curve and the thresholds. Repeated rows
    of a labelled document are learned from each.
    """
    return fit_once(labelled_sample(docs, labels, label, most), word_codes, fit)


def score(docs: DataFrame, model: dict, text: str = "text", out: str = "score") -> DataFrame:
    """All columns of ``docs`` with the score (0 to 1) of the whole text.

    Null text is scored like an empty one, repeated rows alike. A column of the name ``out`` must not be there.
    """
    held: list = []

    def compute(texts: list[bytes]) -> dict[str, pa.Array]:
        if not held:
            held.append(_tables(model | {"words": model["words"].astype(np.float32)}))
        margins = np.array([margin(model, held[0], word_codes(x)) for x in texts])
        return {out: pa.array(curve(margins, model["slope"], model["intercept"]), pa.float64())}

    return append_columns(docs, text, f"`{out}` double", compute)


def rejected(model: dict, score_column: str, lang: str = "lang"):
    """Whether a score reaches the threshold calibrated for its language; unknown languages take the common one."""
    limits = model["thresholds"]
    chosen = F.lit(limits[""])
    for name, limit in limits.items():
        if name:
            chosen = F.when(F.col(lang) == name, F.lit(limit)).otherwise(chosen)
    return F.col(score_column) >= chosen
