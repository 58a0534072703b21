"""What the Kneser-Ney model leaves on disk: its own tables, no intermediate ones and no shuffle files."""

import glob
import time

import numpy as np
import pytest
from tessera.llm import kneser_ney

ROWS = [(i, " ".join(f"w{(i * k * k) % 37}" for k in range(i % 9))) for i in range(60)]


@pytest.mark.parametrize("order", [2, 3])
def test_only_the_model_stays(spark, documents, monkeypatch, tmp_path, order):
    def new(name):
        return f"file://{tmp_path}/{name}"

    for module in ("kneser_ney", "mapped", "shared"):
        monkeypatch.setattr(f"tessera.llm.{module}.shared_path", lambda spark, name: new(name))
    folders = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    shuffles = lambda: {f for d in folders for f in glob.glob(f"{d}/**/shuffle_*", recursive=True)}
    docs, before = documents(ROWS), shuffles()
    kneser_ney.fit(docs, order)
    assert sorted(p.name for p in tmp_path.iterdir()) == ["contexts", "pairs", "vocabulary"]
    until = time.time() + 10  # executors delete them on their own
    while shuffles() - before and time.time() < until:
        time.sleep(0.1)
    assert not shuffles() - before


@pytest.mark.parametrize("order", [2, 3])
def test_numbers_of_64_bits_give_the_same_scores(spark, documents, monkeypatch, order):
    fit = lambda: kneser_ney.fit(documents(ROWS[:50]), order)
    score = lambda model: [r.score for r in kneser_ney.scored(documents(ROWS), model).sort("doc_id").collect()]
    narrow = fit()
    monkeypatch.setattr(kneser_ney, "_narrow", lambda x: x.astype(np.int64))
    wide = fit()
    for model, kind in ((narrow, "u4"), (wide, "i8")):
        assert {f.rsplit(".", 1)[1] for f in glob.glob(f"{model.contexts.removeprefix('file://')}/*.five.*")} == {kind}
    assert score(narrow) == score(wide)


def test_numbers_are_narrow_where_they_fit():
    for top, width in ((2**32 - 1, 4), (2**32, 8)):
        held = kneser_ney._narrow(np.array([0, top]))
        assert held.itemsize == width and held.tolist() == [0, top]
    assert len(kneser_ney._narrow(np.zeros(0, np.int64))) == 0
