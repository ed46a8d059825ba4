"""The network's softmax and gradients, held against plain forms of them."""

from __future__ import annotations

import numpy as np
from listingflow.llm import gru


def test_greatest_logit_is_looked_for_only_where_logits_may_be_large():
    model = gru.new_model(np.ones(gru.SLOTS))
    assert gru._bounded(model["class_weight"], model["class_bias"])
    assert gru._bounded(model["word_weight"], model["word_bias"])
    assert not gru._bounded(model["class_weight"] + 100, model["class_bias"])
    assert not gru._bounded(model["word_weight"], model["word_bias"] - gru.SAFE)


def test_softmax_of_small_and_large_logits():
    draw = np.random.default_rng(1)
    for size, bounded in ((3, True), (3, False), (50, True), (400, False)):
        logits = (size * draw.uniform(-1, 1, (7, 32))).astype(np.float32)
        exact = logits.astype(float)
        norm = exact.max(1) + np.log(np.exp(exact - exact.max(1, keepdims=True)).sum(1))
        p, found = gru._softmax(logits.copy(), True, bounded)
        assert np.allclose(found, norm, rtol=1e-5, atol=1e-5)
        assert np.allclose(p, np.exp(exact - norm[:, None]), atol=1e-5)


def test_gradients_are_those_of_the_log_probability():
    draw = np.random.default_rng(2)
    model = gru.new_model(np.ones(gru.SLOTS))
    inputs = draw.integers(0, gru.SLOTS, (4, 3)).astype(np.int32)
    targets = draw.integers(0, gru.SLOTS, 12).astype(np.int32)
    first = draw.uniform(-0.5, 0.5, (3, gru.HIDDEN)).astype(np.float32)

    def loss(model):
        states, kept = gru._recur(model, inputs, first)
        logp, grads, d = gru._outputs(model, states[1:].reshape(-1, gru.HIDDEN), targets, True)
        return -logp.astype(float).sum(), grads, states, kept, d

    _, grads, states, kept, d = loss(model)
    gru._back(model, inputs, states, kept, d.reshape(4, 3, gru.HIDDEN), grads)
    for name in ("recurrent", "recurrent_bias", "class_weight", "word_bias"):
        direction = draw.standard_normal(gru.SHAPES[name]).astype(np.float32)
        ends = [loss(model | {name: model[name] + np.float32(step) * direction})[0] for step in (0.01, -0.01)]
        assert np.isclose((ends[0] - ends[1]) / 0.02, (grads[name] * direction).sum(), rtol=0.02, atol=0.02)
