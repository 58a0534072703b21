"""op4 takes what depends on a word or a pair once for each different one, whatever the number of shards."""

import numpy as np
import pytest

from tessera.llm import kneser_ney, words


def test_contexts_are_looked_up_once_a_word(spark, documents, monkeypatch):
    model = kneser_ney.fit(documents([(0, "a b a c"), (1, "b a")]))
    asked, look = [], kneser_ney.Model._context
    monkeypatch.setattr(kneser_ney.Model, "_context", lambda self, ids: asked.append(len(ids)) or look(self, ids))
    batch = documents([(0, "a b c " * 5000)]).toArrow().to_batches()[0]
    got = model.score(*kneser_ney.tokens_of(words.texts_of(batch)))
    assert got["n_known"].tolist() == [15001] and 0 < sum(asked) <= 5  # three words, the end and the start


@pytest.mark.parametrize("order", [2, 3])
def test_scores_are_the_same_over_many_shards(spark, documents, monkeypatch, order):
    rows = [(i, " ".join(f"w{(i * k * k) % 37}" for k in range(i % 9))) for i in range(60)] + [(60, None), (61, "unseen w1 w4 unseen")]
    score = lambda: [r.score for r in kneser_ney.scored(documents(rows), kneser_ney.fit(documents(rows[:50]), order)).sort("doc_id").collect()]
    few = score()
    monkeypatch.setattr(kneser_ney, "SHARD", 4)
    assert np.allclose(few, score(), rtol=1e-12)


def test_widths_before_a_place():
    width = np.random.default_rng(5).integers(0, 256, 10 * kneser_ney.BLOCK).astype(np.uint8)
    width[: kneser_ney.BLOCK] = 255
    places = np.arange(len(width))
    want = [int(width[p // kneser_ney.BLOCK * kneser_ney.BLOCK : p].sum(dtype=np.int64)) for p in places]
    assert kneser_ney._before(width, places).tolist() == want
