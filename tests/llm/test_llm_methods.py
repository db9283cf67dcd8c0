"""Learners and packers against plain versions, without Spark."""

import math
import tracemalloc

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from cordon.llm import packing, quality, toxicity
from cordon.llm import textbytes as tb


def plain_ftrl(rows, alpha, beta, l1, l2):
    """FTRL-proximal over dictionaries, one weight at a time."""
    z, n = {}, {}

    def weight(i):
        if abs(z.get(i, 0.0)) <= l1:
            return 0.0
        return -(z[i] - math.copysign(l1, z[i])) / ((beta + math.sqrt(n[i])) / alpha + l2)

    for x, y in rows:
        w = {i: weight(i) for i in x}
        p = 1 / (1 + math.exp(-max(-35.0, min(35.0, sum(w[i] * v for i, v in x.items())))))
        for i, v in x.items():
            g = (p - y) * v
            sigma = (math.sqrt(n.get(i, 0.0) + g * g) - math.sqrt(n.get(i, 0.0))) / alpha
            z[i] = z.get(i, 0.0) + g - sigma * w[i]
            n[i] = n.get(i, 0.0) + g * g
    return weight


def test_ftrl_equals_a_plain_loop():
    rng = np.random.default_rng(3)
    rows = []
    for _ in range(400):
        own = rng.choice(40, int(rng.integers(1, 8)), replace=False)
        rows.append(({int(i): float(v) for i, v in zip(own, rng.uniform(0.1, 2, len(own)))} | {40: 1.0},
                     float(rng.random() < 0.2 + 0.6 * (own.min() < 8))))
    for l1 in (0.0, 0.02, 0.5):
        model = quality.Ftrl(40, l1=l1)
        for x, y in rows:
            model.update(np.array(list(x)), np.array(list(x.values())), y)
        weight = plain_ftrl(rows, model.alpha, model.beta, l1, model.l2)
        assert np.allclose(model.weights(), [weight(i) for i in range(41)], atol=1e-12)
    assert (model.weights() == 0).any()


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(1, 64), max_size=150))
def test_tiers_hold_their_documents(lengths):
    """Every piece lies once, no window is over its tier, a piece is never in a
    shorter tier than its own, and without promotion shorter windows stay."""
    tiers = (8, 16, 32, 64)
    for promote in (True, False):
        got = packing.pack(lengths, tiers, promote)
        assert sorted(i for _, own in got for i in own) == list(range(len(lengths)))
        for tier, own in got:
            assert tier in tiers and sum(lengths[i] for i in own) <= tier
            assert all(lengths[i] <= tier for i in own)
            if promote and tier < tiers[-1]:
                assert sum(lengths[i] for i in own) == tier  # an unfilled short window moves up
    # a window is opened only when no open one has room: two windows of the
    # longest tier are never both at most half full
    half = [sum(lengths[i] for i in own) for tier, own in packing.pack(lengths, tiers) if tier == 64]
    assert sum(2 * x <= 64 for x in half) <= 1


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 1000), min_size=1, max_size=400), st.integers(2, 64))
def test_steps_are_balanced(costs, size):
    """Steps differ by at most one sequence, and in cost by no more than the spread of one lap."""
    group = packing.step_groups(costs, size)
    n = np.bincount(group)
    assert n.max() <= size and n.max() - n.min() <= 1
    total = np.bincount(group, costs)
    assert total.max() - total.min() <= 2 * max(costs)


def toxic_sample(n_rows, n_words=150, seed=5):
    """Texts of made-up words, every third one toxic by a few words of its own."""
    rng = np.random.default_rng(seed)
    words = np.array([f"{a}{b}" for a in ("lorem", "tam", "sib", "quor", "ne") for b in range(400)])
    texts = []
    for i in range(n_rows):
        own = list(rng.choice(words, n_words))
        if i % 3 == 0:
            own[n_words // 2] = "vilest" + "abc"[i % 2]
        texts.append(" ".join(own))
    return pa.array([*texts, None, "", "--"], pa.large_string()), np.array(
        [float(i % 3 == 0) for i in range(n_rows)] + [0.0] * 3)


def test_toxicity_fit_goes_by_chunks(monkeypatch):
    """Chunks and slices of any size mark the same tokens and give the same model."""
    texts, toxic = toxic_sample(300)
    whole = toxicity.ToxicityModel().fit(texts, toxic, 0.5, 4)
    hashes, row, parts = toxicity.sample_features(texts)
    marks = toxicity._evidence(hashes, row, toxic)
    assert len(parts) == 1 and marks.sum() == toxic.sum()
    chunks = tb.chunks
    monkeypatch.setattr(tb, "chunks", lambda batch: chunks(batch, limit=3000))
    monkeypatch.setattr(toxicity, "SLICE_TOKENS", 500)
    assert len(toxicity.sample_features(texts)[2]) > 50
    for a, b in zip(toxicity.sample_features(texts)[:2], (hashes, row)):
        assert (a == b).all()
    assert (toxicity._evidence(hashes, row, toxic) == marks).all()
    cut = toxicity.ToxicityModel().fit(texts, toxic, 0.5, 4)
    assert np.allclose(cut.w, whole.w, atol=1e-5)
    assert np.allclose([cut.bias, cut.slope, cut.offset, *cut.trans.ravel(), *cut.begin],
                       [whole.bias, whole.slope, whole.offset, *whole.trans.ravel(), *whole.begin], atol=1e-6)


def test_toxicity_fit_needs_little_memory():
    """At most 120 bytes for each further token (about 300 when all passes held the whole sample)."""
    peaks = []
    for n_rows in (2000, 6000):
        texts, toxic = toxic_sample(n_rows)
        tracemalloc.start()
        toxicity.ToxicityModel().fit(texts, toxic, 0.5, 1)
        peaks.append(tracemalloc.get_traced_memory()[1])
        tracemalloc.stop()
    assert peaks[1] - peaks[0] < 120 * 4000 * 150
