"""The toxicity network against plain loops, and its gradients against finite differences."""

from __future__ import annotations

import numpy as np
import pytest

from terrafold.llm import toxicity
from terrafold.llm.toxicity import ToxicityModel, ToxicitySettings

SMALL = ToxicitySettings(hash_bits=6, prefixes=(4,), part=3, widths=(1, 2, 3), filters=4, rounds=1, batch=64, seed=3)


def some_texts(n=12, seed=1):
    rng = np.random.default_rng(seed)
    lengths = [0, 1, 2, *rng.integers(3, 15, n - 3)]
    return [rng.integers(0, 1 << SMALL.hash_bits, (2, k)).astype(np.int32) for k in lengths]


def random_model(seed=5):
    rng, dims = np.random.default_rng(seed), SMALL.part * 2
    model = ToxicityModel(SMALL, offset=0.3)
    model.tables = [rng.normal(0, 0.5, (1 << SMALL.hash_bits, SMALL.part)) for _ in range(2)]
    model.kernels = [rng.normal(0, 0.5, (w * dims, SMALL.filters)) for w in SMALL.widths]
    model.bias = [rng.normal(0, 0.2, SMALL.filters) for _ in SMALL.widths]
    model.weights = rng.normal(0, 0.5, SMALL.filters * len(SMALL.widths))
    return model


def plain_logit(model, ids):
    """Word by word: every filter at every place, zeros behind the text, largest value, bias, positive part."""
    vectors = [np.concatenate([t[i] for t, i in zip(model.tables, word)]) for word in ids.T]
    nothing, total, at = np.zeros(sum(t.shape[1] for t in model.tables)), model.offset, 0
    for width, kernel, bias in zip(SMALL.widths, model.kernels, model.bias):
        for f in range(SMALL.filters):
            best = 0.0
            for start in range(len(vectors)):
                window = [vectors[k] if k < len(vectors) else nothing for k in range(start, start + width)]
                best = max(best, float(np.concatenate(window) @ kernel[:, f]))
            total += max(best + bias[f], 0.0) * model.weights[at]
            at += 1
    return total


def together(texts):
    return np.concatenate(texts, axis=1), np.cumsum([0, *(t.shape[1] for t in texts)])


def test_logits_equal_plain_convolution():
    model, texts = random_model(), some_texts()
    got = toxicity.logits(model, *together(texts))
    assert np.allclose(got, [plain_logit(model, t) for t in texts], atol=1e-5)
    alone = [toxicity.logits(model, *together([t]))[0] for t in texts]
    assert np.allclose(got, alone, atol=1e-5)  # no filter sees two texts


def test_gradients_equal_finite_differences(monkeypatch):
    """The first step of a fit on one batch, with the loss of the same weights nudged entry by entry."""
    texts, held = some_texts(), []
    labels = np.array([k % 3 == 0 for k in range(len(texts))], np.float64)

    def record(adam, gradient, rows=slice(None)):
        held.append((adam.values, adam.values.copy(), rows, np.array(gradient)))  # and leave the weights alone

    monkeypatch.setattr(toxicity._Adam, "step", record)
    model = toxicity.fit_network(texts, labels, SMALL)
    offset = next(v for v, *_ in held if v.shape == (1,))
    exact = ToxicityModel(SMALL, offset=float(offset[0]))
    exact.tables, exact.kernels, exact.bias = ([v.astype(np.float64) for v in part] for part in (model.tables, model.kernels, model.bias))
    exact.weights = model.weights.astype(np.float64)

    def loss():
        z = np.array([plain_logit(exact, t) for t in texts])
        penalty = 0.5e-5 * sum((k**2).sum() for k in exact.kernels) + 0.5e-4 * (exact.weights**2).sum()
        return float(np.mean(np.log1p(np.exp(z)) - labels * z)) + penalty

    def slope(values, at, step=1e-5):
        keep = values[at]
        values[at] = keep + step
        high = loss()
        values[at] = keep - step
        low = loss()
        values[at] = keep
        return (high - low) / (2 * step)

    pairs = [*zip(model.tables, exact.tables), *zip(model.kernels, exact.kernels), *zip(model.bias, exact.bias), (model.weights, exact.weights)]
    rng, checked = np.random.default_rng(0), 0
    for values, _, rows, gradient in held:
        own = [e for m, e in pairs if m is values]
        if not own:
            continue
        entries = list(np.ndindex(gradient.shape))
        for at in (entries[i] for i in rng.choice(len(entries), min(12, len(entries)), replace=False)):
            place = at if isinstance(rows, slice) else (int(rows[at[0]]), *at[1:])
            assert gradient[at] == pytest.approx(slope(own[0], place), abs=2e-4), (values.shape, place)
            checked += 1
    assert checked > 60
