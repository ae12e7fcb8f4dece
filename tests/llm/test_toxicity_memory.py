from __future__ import annotations

import numpy as np

from attrition.llm import toxicity


def test_a_sample_is_laid_out_in_parts(monkeypatch):
    """The driver's tables hold a bounded number of documents, and the model does not depend on it."""
    rng = np.random.default_rng(4)
    documents = [np.unique(rng.integers(0, 300, 40)).astype(np.int32) for _ in range(400)]
    labels = np.array([int(5 in d and 9 in d or 17 in d) for d in documents])
    seen, by_document, flat = [], toxicity._by_document, toxicity._flat
    monkeypatch.setattr(toxicity, "_by_document", lambda t, n: seen.append(len(n)) or by_document(t, n))
    monkeypatch.setattr(toxicity, "_flat", lambda d: seen.append(len(d)) or flat(d))
    models = []
    for at_once in (512, 50):
        monkeypatch.setattr(toxicity, "AT_ONCE", at_once)
        seen.clear()
        models.append(toxicity.fit_machine(documents, labels, epochs=2))
    # Minibatches have at most about 128 documents.
    assert max(seen) <= 256 and seen.count(50) > 5
    assert models[0].slope == models[1].slope and models[0].shift == models[1].shift
    assert (models[0].weights == models[1].weights).all() and (models[0].factors == models[1].factors).all()
