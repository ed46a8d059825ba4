"""The language model learns from all that it is shown."""

import numpy as np

from listingflow.llm import gru


def test_short_documents_are_learned_from():
    model = gru.new_model(np.ones(gru.SLOTS))
    learner = gru.Learner(model)
    assert learner.learn([np.array([1, 2, 3], np.int32)] * 5) == 15
    assert not np.array_equal(learner.model["table"][gru.START], model["table"][gru.START])


def test_every_window_is_learned_from():
    learner = gru.Learner(gru.new_model(np.ones(gru.SLOTS)))
    assert learner.learn([np.arange(gru.WINDOW * 4, dtype=np.int32)]) == gru.WINDOW * 4 and learner.steps == 4
