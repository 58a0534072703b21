"""The registered queries, and the pipeline, against brute force on the smallest tables."""

import collections
import hashlib
import math
import re
import zlib

import duckdb
import numpy as np
import pyarrow.parquet as pq
import pytest

from tessera.llm import bpe, html, imatch, kneser_ney, langid, linedup, neardup, queries
from tessera.llm import decontaminate as dc

from . import brute

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs():
    return pq.read_table(f"{SF}/documents.parquet").to_pandas().sort_values("doc_id")


def rows(docs):
    return list(zip(docs.doc_id.tolist(), docs.text))


def encoding():
    import public_tokenizers as P
    import tiktoken

    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.read_ranks(P.path("byte_bpe_multi_50k.tiktoken")), special_tokens={})


def test_op1_equals_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM read_parquet('{SF}/pages.parquet')")
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    want = con.execute(f"SELECT {', '.join(names)} FROM ({queries.ORACLE_SQL['op1_warc']})").fetchall()
    assert sorted(map(str, want)) == sorted(str(tuple(r)) for r in queries.QUERIES["op1_warc"](spark, SF).select(*names).collect())


def test_op2_edits_and_likeness(spark, docs):
    got = {r.doc_id: r for r in imatch.op2_imatch(spark, SF).collect()}
    down = rows(docs)[::-1]
    for k, (i, text) in enumerate(down):
        after, half = down[(k + 1) % len(down)][1], len(text) // 2
        assert got[i].n_chars == len(text)
        assert got[i].edited_sha256 == hashlib.sha256((text[: len(text) - half] + after[:half]).encode()).hexdigest()
    prints = brute.imatch_prints([x for _, x in down])
    for k, (i, _) in enumerate(down):
        assert got[i].fingerprint == prints[k]
        assert got[i].near_next == pytest.approx(brute.imatch_likeness(prints[k], prints[(k + 1) % len(down)]))
        assert got[i].near_edited == pytest.approx(brute.imatch_likeness(prints[k], got[i].edited_fingerprint))
    assert np.mean([r.near_edited > r.near_next for r in got.values()]) > 0.8


def test_op3_is_exact(spark, docs):
    want = brute.line_dedup(rows(docs))
    assert {r.doc_id: r.text for r in linedup.op3_line_dedup(spark, SF).collect()} == want


@pytest.mark.parametrize("order", [2, 3])
def test_op4_is_the_formula_and_sums_to_one(spark, docs, monkeypatch, order):
    tokens = {i: re.findall(r"[^\x20\x09-\x0D]+", brute.lower(x)) + ["</s>"] for i, x in rows(docs)}
    train = [x for i, x in tokens.items() if zlib.crc32(str(i).encode()) % 7 != 2]
    uni = collections.Counter(w for x in train for w in x)
    grams = lambda x: [tuple((["<s>"] * (order - 1) + x)[k : k + order]) for k in range(len(x))]
    counts = {order: collections.Counter(g for x in train for g in grams(x))}
    for n in range(order - 1, 0, -1):
        counts[n] = collections.Counter(g[1:] for g in counts[n + 1])
    d = {n: kneser_ney.discounts(np.array([sum(v == k for v in c.values()) for k in (1, 2, 3, 4)])) for n, c in counts.items()}
    total, free = collections.Counter(), collections.Counter()
    for n, c in counts.items():
        for g, v in c.items():
            total[n, g[:-1]] += v
            free[n, g[:-1]] += d[n][min(v, 3)]

    def p(g):
        n = len(g)
        low = p(g[1:]) if n > 1 else 1 / (len(uni) + 1)
        if not total[n, g[:-1]]:
            return low
        c = counts[n][g]
        return (c - d[n][min(c, 3)] + free[n, g[:-1]] * low) / total[n, g[:-1]]

    seen = [g[:-1] for g in counts[order]]
    assert all(math.isclose(sum(p((*g, w)) for w in uni) + p((*g, "<unknown>")), 1) for g in [seen[0], seen[len(seen) // 2], seen[-1]])
    fit = kneser_ney.fit
    monkeypatch.setattr(kneser_ney, "fit", lambda texts: fit(texts, order))
    for r in kneser_ney.op4_kneser_ney(spark, SF).collect():
        x = tokens[r.doc_id]
        assert math.isclose(r.score, sum(math.log10(p(g)) for g in grams(x)), rel_tol=1e-9)
        assert math.isclose(r.base_score, sum(math.log10((uni[w] + 1) / (sum(uni.values()) + len(uni) + 1)) for w in x), rel_tol=1e-9)
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(x), sum(w in uni for w in x), sum(uni.values()))


def test_op4_counts_of_any_size(spark, documents):
    """A pair with more followers, and followers with more occurrences, than a byte counts."""
    texts = [" ".join(f"a b w{k}" for k in range(700)), "a b w3 " * 600, "c d"]
    model = kneser_ney.fit(documents(list(enumerate(texts))), 3)
    got = [r.score for r in kneser_ney.scored(documents([(0, "a b w3"), (1, "a b w699"), (2, "a b zz")]), model).sort("doc_id").collect()]
    assert got[0] > got[1] > got[2]
    ids = [int(x) for x in model.ids(kneser_ney.tokens_of(kneser_ney.words.texts_of(pa_batch("a b w3 w699 w0")))[0])[0]]
    keys = np.array([(ids[0] << 32) | ids[1]] * 3, np.uint64)
    shards, places = model.bigrams.find(keys)
    n, kinds = model._followers(shards, places, np.array([ids[2], ids[3], ids[4]]))
    assert n.tolist() == [601, 1, 1] and kinds[0].tolist() == [1300, 699, 0, 1]


def pa_batch(*texts):
    import pyarrow as pa

    return pa.RecordBatch.from_pydict({"text": list(texts)})


@pytest.mark.parametrize("crowd", [2, 32])
def test_op5_is_exact(spark, docs, monkeypatch, crowd):
    monkeypatch.setattr(neardup, "CROWD", crowd)
    assert {r.doc_id: r.class_id for r in neardup.op5_near_duplicates(spark, SF).collect()} == brute.near_classes(rows(docs))


def test_signatures_estimate_weighted_jaccard():
    draw = np.random.default_rng(1)
    a = draw.integers(0, 2**63, 300).astype(np.uint64)
    b = np.concatenate([a[:240], draw.integers(0, 2**63, 60).astype(np.uint64)])
    keys, owner = np.concatenate([a, b]), np.repeat([0, 1], 300)
    s = neardup.signatures(keys, owner, 3, 4_000)
    assert abs((s[0] == s[1]).mean() - 240 / 360) < 0.03 and not s[2].any() and s[:2].all()


def test_op6_prefers_clean_documents(spark):
    kept = {r.doc_id for r in queries.QUERIES["op6_resample"](spark, SF).collect()}
    labels = pq.read_table(f"{SF}/labels.parquet").to_pandas()
    share = lambda x: x.doc_id.isin(kept).mean()
    assert share(labels[(labels.quality == 1) & (labels.toxic == 0)]) > 0.9 > 0.3 > share(labels[labels.quality == 0])


def test_op7_finds_all(spark, docs):
    items = pq.read_table(f"{SF}/benchmark.parquet").to_pandas()
    want = brute.contaminations(rows(docs), list(zip(items.item_id.tolist(), items.text)))
    assert {(r.doc_id, r.item_id) for r in dc.op7_decontaminate(spark, SF).collect()} == want


def test_op8_held_out_accuracy(spark, docs):
    lang = dict(zip(docs.doc_id.tolist(), docs.lang))
    out = [r for r in langid.op8_language(spark, SF).collect() if r.held_out]
    assert out and np.mean([lang[r.doc_id] == r.lang_pred for r in out]) > 0.95


def test_op9_is_tiktoken(spark, docs):
    own = encoding()
    for r in bpe.op9_bpe(spark, SF).collect():
        text = docs.text[docs.doc_id == r.doc_id].iloc[0]
        ids = own.encode_ordinary(text)
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(text.encode()).hexdigest())


def test_op10_is_the_article(spark):
    from html import unescape

    pages = pq.read_table(f"{SF}/pages.parquet").to_pandas().set_index("page_id")
    for r in html.op10_html(spark, SF).collect():
        article = re.search(r"<article>(.*?)</article>", pages.html[r.page_id], re.S)[1]
        blocks = (" ".join(unescape(re.sub(r"<br>", " ", re.sub(r"</?b>", "", x))).split()) for x in re.split(r"</?(?:p|h1)>", article))
        assert r.text == "\n".join(x for x in blocks if x) and r.n_chars == len(r.text) and r.url == pages.url[r.page_id]


def test_pipeline(spark, docs):
    import corpus_pipeline

    model = langid.fit(spark.read.parquet(f"{SF}/documents.parquet").filter("crc32(cast(doc_id as string)) % 4 <> 2"))
    good = {i: lang != "und" and p >= 0.5 for (i, _), lang, p in zip(rows(docs), *model.predict(docs.text.tolist()))}
    kept = [(i, x) for i, x in rows(docs) if good[i]]
    kept = [(i, x) for i, x in brute.line_dedup(kept).items() if x.split() or not dict(kept)[i].split()]
    classes = brute.near_classes(kept)
    kept = [(i, x) for i, x in kept if classes[i] == i]
    items = pq.read_table(f"{SF}/benchmark.parquet").to_pandas()
    leaks = {i for i, _ in brute.contaminations(kept, list(zip(items.item_id.tolist(), items.text)))}
    own = encoding()
    want = {i: hashlib.sha256(np.array(own.encode_ordinary(x), "<u4").tobytes()).hexdigest() for i, x in kept if i not in leaks}
    assert {r.doc_id: r.ids_sha256 for r in corpus_pipeline.run(spark, SF).collect()} == want
