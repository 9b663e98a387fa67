"""Calibration of the toxic passages: the extreme-value law and recall by length of text."""

import math

import numpy as np
import pytest

from tidemart.llm import queries, toxicity


@pytest.mark.parametrize("scale", [0.3, 0.01])
def test_the_scale_is_the_likeliest(scale):
    """Scores drawn from the law give its K back, also where most texts have no segment."""
    draw = np.random.default_rng(6)
    rate, sizes = 2.5, draw.integers(20, 400, 60_000).astype(float)
    best = np.maximum(0, (np.log(scale * sizes) - np.log(-np.log(draw.random(len(sizes))))) / rate)
    found = toxicity.extreme_value_scale(best, sizes, rate)
    assert found == pytest.approx(scale, rel=0.05)

    def likelihood(k):
        seen = best > 0
        one = (np.log(k * sizes[seen] * rate) - rate * best[seen] - k * sizes[seen] * np.exp(-rate * best[seen])).sum()
        return one - (k * sizes[~seen]).sum()

    assert likelihood(found) >= max(likelihood(found * f) for f in (0.9, 0.99, 1.01, 1.1))


def test_no_segments_leave_the_scale_alone():
    assert toxicity.extreme_value_scale(np.zeros(5), np.full(5, 10.0), 1.0) == 1.0
    assert toxicity.extreme_value_scale(np.empty(0), np.empty(0), 1.0) == 1.0


def test_toxic_passages_are_found_in_texts_of_any_length(spark, given):
    """A passage of a toxic document between clean ones, up to tens of thousands of words, and probability by its own formula."""
    docs = {d["doc_id"]: d["text"] or "" for d in given("documents")}
    labels = {r["doc_id"]: r["toxic"] for r in given("labels")}
    frame = queries.table(spark, "/root/testdata/sf0.01", "documents")
    model = toxicity.learn(frame, toxicity.training_labels(queries.table(spark, "/root/testdata/sf0.01", "labels")))
    clean = [w for i, t in docs.items() if labels.get(i) == 0 for w in toxicity.tokens(t) if w not in model.lexicon]
    surest = sorted(model.lexicon, key=model.lexicon.get)[-12:]
    for length in (50, 500, 5_000, 50_000):
        words = [clean[k % len(clean)] for k in range(length)]
        assert model.passages(words) == []
        half = length // 2
        found = model.passages(words[:half] + surest + words[half:])
        assert [(a, b) for a, b, _ in found] == [(half, half + len(surest))]
        score = sum(model.lexicon[w] for w in surest)
        surplus = model.rate * score - math.log(model.scale * (length + len(surest)))
        assert found[0][2] == pytest.approx(surplus)
        z = model.slope * min(surplus, 100.0) + model.intercept
        assert model.probability(surplus) == pytest.approx(1 / (1 + math.exp(-z)))
        assert model.probability(surplus) > toxicity.THRESHOLD
