"""Language and resampling models against plain loops over the same hashed grams."""

import collections
import math
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from tessera.llm import langid, resample
from tessera.llm.words import salted

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs():
    return pq.read_table(f"{SF}/documents.parquet").to_pandas().sort_values("doc_id")


def grams_of(text):
    return [int(b) for held, _ in langid.gram_buckets([text]) for b in held]


def bayes(rows, learn, smoothing=0.5):
    """Language and probability of each text (id, text, lang), summed bucket by bucket."""
    counts, n = collections.defaultdict(collections.Counter), collections.Counter()
    for i, text, lang in rows:
        if learn(i) and text is not None and lang is not None:
            n[lang] += 1
            counts[lang].update(grams_of(text))
    whole = {x: sum(c.values()) + smoothing * langid.BUCKETS for x, c in counts.items()}
    for i, text, _ in rows:
        if not n or not any(c.isalpha() for c in text or ""):
            yield i, "und", 0.0
            continue
        grams = collections.Counter(grams_of(text))
        total = {x: math.log(n[x] / sum(n.values())) + sum(k * math.log((counts[x][b] + smoothing) / whole[x]) for b, k in grams.items()) for x in n}
        best = min(total, key=lambda x: (-total[x], x))
        yield i, best, 1 / sum(math.exp(v - total[best]) for v in total.values())


def test_op8_is_the_formula(spark, docs):
    rows = list(zip(docs.doc_id.tolist(), docs.text, docs.lang))
    want = {i: (lang, p) for i, lang, p in bayes(rows, lambda i: zlib.crc32(str(i).encode()) % 4 != 2)}
    got = {r.doc_id: r for r in langid.op8_language(spark, SF).collect()}
    assert set(got) == set(want)
    for i, (lang, p) in want.items():
        assert got[i].lang_pred == lang and math.isclose(got[i].score, p, rel_tol=1e-3, abs_tol=1e-6)


@pytest.mark.parametrize("at_once", [1, 2, 3, 1000])
def test_more_languages_than_are_held_at_once(spark, documents, monkeypatch, at_once):
    """Blocks of languages decide as all at once do; of equal ones the first language wins."""
    monkeypatch.setattr(langid, "AT_ONCE", at_once)
    texts = [("aaa bbb", "x"), ("aaa bbb", "w"), ("ccc ddd", "y"), ("eee fff ggg", "z"), ("eee", "z"), (None, "z"), ("hhh", None), ("123", "y")]
    docs = documents([(k, x, lang) for k, (x, lang) in enumerate(texts)], "doc_id long, text string, lang string")
    model = langid.fit(docs)
    want = {i: (lang, p) for i, lang, p in bayes([(k, x, lang) for k, (x, lang) in enumerate(texts)], lambda i: True)}
    got = {r.doc_id: (r.lang_pred, r.score) for r in langid.identify(docs, model).collect()}
    assert {i: x[0] for i, x in got.items()} == {i: x[0] for i, x in want.items()} and got[0][0] == "w"
    assert all(math.isclose(got[i][1], want[i][1], rel_tol=1e-4) for i in want)
    names, chances = model.predict([x or "" for x, _ in texts])
    assert names == [got[k][0] for k in range(len(texts))] and np.allclose(chances, [got[k][1] for k in range(len(texts))])
    empty = langid.fit(docs.limit(0))
    assert {(r.lang_pred, r.score) for r in langid.identify(docs, empty).collect()} == {("und", 0.0)}


def test_op6_is_the_formula(spark, docs):
    labels = pq.read_table(f"{SF}/labels.parquet").to_pandas()
    good = set(labels.doc_id[(labels.quality == 1) & (labels.toxic == 0)].tolist())
    texts = {i: t or "" for i, t in zip(docs.doc_id.tolist(), docs.text)}
    held = {i: collections.Counter(resample.grams(pa.array([t], pa.large_string()))[0].tolist()) for i, t in texts.items()}
    raw, target = collections.Counter(), collections.Counter()
    for i, c in held.items():
        raw.update(c)
        target.update(c if i in good else {})
    log = lambda c, b: math.log((c[b] + 1) / (sum(c.values()) + resample.BUCKETS))
    ratio = {b: log(target, b) - log(raw, b) for b in raw}
    weight = {i: sum(n * ratio[b] for b, n in c.items()) for i, c in held.items()}
    noise = {i: -math.log(-math.log(((int(salted(np.array([i], np.uint64), resample.SEED)[0]) >> 11) + 0.5) * 2.0**-53)) for i in texts}
    order = sorted(texts, key=lambda i: -(weight[i] + noise[i]))
    k = round(len(good) / len(labels) * len(texts))
    got = {r.doc_id: r for r in resample.op6_resample(spark, SF).collect()}
    assert set(got) == set(order[:k])
    assert all(math.isclose(r.log_weight, weight[i], rel_tol=1e-9, abs_tol=1e-9) for i, r in got.items())
