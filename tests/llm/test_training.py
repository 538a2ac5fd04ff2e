"""The two trained scorers against plain forms of their features, objective and gradients."""

from __future__ import annotations

import re
import zlib

import numpy as np
import pytest

from candlewarden.llm import quality_nbsvm, toxicity_cnn

BIG = (1 << 64) - 1


def plain_features(text):
    """Distinct numbers of words, word pairs, shapes and shape pairs, with whole numbers instead of arrays."""
    words = text.encode().split()

    def shape(word):
        for pattern, short in ((r"[^\W\d_a-zß-öø-ÿ]{2,}", "AA"), (r"[^\W\d_A-ZÀ-ÖØ-Þ]+", "a"), (r"\d+", "0")):
            word = re.sub(pattern, short, word)
        return zlib.crc32(word[:12].encode()) & 0xFFFF

    word = [zlib.crc32(w.decode().lower().encode()) for w in words]
    kind = [shape(w.decode()) for w in words]
    mix = 0x9E3779B97F4A7C15
    found = {w * mix & BIG for w in word} | {(k + (1 << 40)) * mix & BIG for k in kind}
    for k in range(len(words) - 1):
        found.add((word[k] * 31 + word[k + 1] + 1) * mix & BIG)
        found.add(((kind[k] << 16 | kind[k + 1]) * 8 + (7 if word[k] == word[k + 1] else 3)) * mix & BIG)
    return sorted({x >> 46 for x in found})


@pytest.mark.parametrize("text", ["", "one", "One TWO two 3three, Über über!", "a a a b", "x1 22 Y_z ---"])
def test_features_are_words_shapes_and_pairs(text):
    assert quality_nbsvm.features(text.encode()).tolist() == plain_features(text)


def sample(n, seed):
    rng = np.random.default_rng(seed)
    rows = []
    for k in range(n):
        good = k % 2
        words = [f"w{rng.integers(40) + (15 if good else 0)}" for _ in range(rng.integers(1, 25))]
        rows.append((quality_nbsvm.features(" ".join(words).encode()), good, None))
    return rows


def test_weights_are_the_optimum_of_the_dual():
    """Ratios by counting, and a small gap between the objective and its dual, which bounds the distance to the optimum."""
    rows = sample(150, 3)
    counts = [{}, {}]
    for codes, label, _ in rows:
        for c in codes.tolist():
            counts[label][c] = counts[label].get(c, 0) + 1
    totals = [quality_nbsvm.DIMENSIONS * quality_nbsvm.SMOOTH + sum(c.values()) for c in counts]
    ratio = np.zeros(quality_nbsvm.DIMENSIONS)
    for c in range(quality_nbsvm.DIMENSIONS):
        share = [(counts[k].get(c, 0) + quality_nbsvm.SMOOTH) / totals[k] for k in (0, 1)]
        ratio[c] = np.log(share[1] / share[0])
    y = np.array([1.0 if label else -1.0 for _, label, _ in rows])
    codes = [r for r, _, _ in rows]
    weights, bias, alpha = quality_nbsvm._descend(codes, y, ratio)
    assert quality_nbsvm.fit(rows)["weights"] == pytest.approx(weights.astype(np.float32), abs=1e-5)
    values = [ratio[r] / np.sqrt(max(1, len(r))) for r in codes]
    w, b = np.zeros(len(ratio)), 0.0
    for r, v, t, a in zip(codes, values, y, alpha, strict=True):
        w[r] += a * t * v
        b += a * t
    assert w * ratio == pytest.approx(weights) and b == pytest.approx(bias)
    assert ((alpha >= 0) & (alpha <= quality_nbsvm.COST)).all()
    losses = [max(0.0, 1 - t * (w[r] @ v + b)) for r, v, t in zip(codes, values, y, strict=True)]
    primal = 0.5 * (w @ w + b * b) + quality_nbsvm.COST * sum(losses)
    dual = alpha.sum() - 0.5 * (w @ w + b * b)
    assert 0 <= primal - dual <= 0.02 * primal
    assert np.mean([(w[r] @ v + b > 0) == (t > 0) for r, v, t in zip(codes, values, y, strict=True)]) > 0.9


def test_steps_follow_the_gradient(monkeypatch):
    """One step on one text against finite differences of its loss."""
    monkeypatch.setattr(toxicity_cnn, "ROUNDS", 1)
    rng = np.random.default_rng(0)
    texts = [np.array(rng.integers(0, 9, 12), np.int32) for _ in range(20)]
    model = toxicity_cnn._start(texts, np.array([0, 1] * 10), rng)
    for name in ("shift", "out"):
        model[name] = model[name] + rng.normal(0, 0.3, model[name].shape).astype(np.float32)
    codes, label, weight = toxicity_cnn.embedding_rows(model["known"], texts[0]), 1, 1.5

    def copy():
        return {k: [x.astype(np.float64) for x in v] if isinstance(v, list) else np.array(v, np.float64) if k != "known" else v for k, v in model.items()}

    def loss(m):
        seen, tops = m["words"][toxicity_cnn._padded(codes)], []
        n = len(seen) - toxicity_cnn._PAD
        for kernel in m["kernels"]:
            tops.append(np.max([sum(seen[i + j] @ kernel[j] for j in range(len(kernel))) for i in range(n)], axis=0))
        value = np.maximum(np.concatenate(tops) + m["shift"], 0) @ m["out"] + m["bias"]
        return weight * np.log1p(np.exp(-value if label else value))

    stepped = {k: [x.copy() for x in v] if isinstance(v, list) else np.copy(v) for k, v in model.items()}
    stepped["bias"] = float(model["bias"])
    toxicity_cnn._learn(stepped, [codes], np.array([label]), np.array([weight]), np.random.default_rng(1))

    def slope_of(before, after):  # a step is RATE * g / sqrt(0.01 + g^2)
        u = (np.asarray(before, np.float64) - np.asarray(after, np.float64)) / toxicity_cnn.RATE
        return 0.1 * u / np.sqrt(1 - np.clip(u * u, 0, 0.999999))

    eps, checked = 1e-5, 0
    for path in [("out",), ("shift",), ("kernels", 0)]:
        before, after = model[path[0]], stepped[path[0]]
        if len(path) > 1:
            before, after = before[path[1]], after[path[1]]
        slopes = slope_of(before, after)
        for at in list(np.ndindex(before.shape))[:24]:
            up, down = copy(), copy()
            for m, d in ((up, eps), (down, -eps)):
                (m[path[0]][path[1]] if len(path) > 1 else m[path[0]])[at] += d
            exact = (loss(up) - loss(down)) / (2 * eps)
            assert slopes[at] == pytest.approx(exact, rel=0.02, abs=2e-4)
            checked += abs(exact) > 1e-3
    assert checked > 10


def test_training_learns_what_words_alone_do_not_show():
    """Toxic texts have a pair of words in one order, clean ones in the other: only trained filters tell them apart."""
    rng = np.random.default_rng(4)
    rows = []
    for k in range(800):
        words = [f"w{rng.integers(30)}" for _ in range(12)]
        at = int(rng.integers(0, 11))
        words[at : at + 2] = ["big", "fool"] if k % 2 else ["fool", "big"]
        rows.append((toxicity_cnn.word_codes(" ".join(words).encode()), k % 2, "en"))
    learn, held = rows[:600], rows[600:]

    def accuracy(model):
        tables = toxicity_cnn._tables(model | {"words": model["words"].astype(np.float32)})
        margins = np.array([toxicity_cnn.margin(model, tables, c) for c, *_ in held])
        labels = np.array([y for _, y, _ in held])
        best = max(np.mean((margins >= cut) == labels) for cut in np.unique(margins))
        return best

    start = toxicity_cnn._start([c for c, *_ in learn], np.array([y for _, y, _ in learn]), np.random.default_rng(11))
    assert accuracy(start) < 0.7 < 0.9 < accuracy(toxicity_cnn.fit(learn))
