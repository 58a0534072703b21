"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing columns, for each operator."""

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.llm import bpe, decontaminate, html, imatch, kneser_ney, langid, linedup, neardup, resample, warc

from .conftest import words

LONG = words(20_000, 3)
ROWS = [(1, None), (2, ""), (3, "   \n\n "), (4, "short"), (4, "short"), (5, "A" * 5_000), (6, LONG), (7, LONG + " end"), (None, "no id at all here"), (None, None), (8, "!!! 123 ###")]


def tokenizer():
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN


def test_language(documents):
    docs = documents(ROWS)
    out = langid.identify(docs, langid.fit(docs)).collect()
    assert len(out) == len(ROWS)
    assert {r.text: r.lang_pred for r in out if r.text in (None, "", "!!! 123 ###")} == {None: "und", "": "und", "!!! 123 ###": "und"}
    assert all(0 <= r.score <= 1 for r in out)
    empty = docs.limit(0)
    assert langid.identify(docs, langid.fit(empty)).filter("lang_pred <> 'und'").count() == 0
    assert langid.identify(empty, langid.fit(docs)).count() == 0


def test_warc(spark):
    rows = [(1, b"x"), (2, b"x"), (None, b"x"), (3, None), (4, b""), (4, b""), (5, bytes(3_000_000)), (6, "é\r\n\r\n".encode())]
    df = spark.createDataFrame(rows, "id long, payload binary")
    bundles = warc.write_bundles(warc.with_roles(df)).cache()
    out = warc.read_records(bundles).collect()
    assert sorted((r.record_id or "", r.record_type, r.refers_to or "") for r in out) == sorted([("1", "revisit", "2"), ("2", "response", ""), ("", "revisit", "2"), ("3", "revisit", "4"), ("4", "response", ""), ("4", "response", ""), ("5", "response", ""), ("6", "response", "")])
    assert {r.record_id: bytes(r.payload) for r in out if r.record_type == "response"} == {"2": b"x", "4": b"", "5": bytes(3_000_000), "6": "é\r\n\r\n".encode()}
    one = warc.lookup(bundles, spark.createDataFrame([("6",), ("99",)], "record_id string")).collect()
    assert [bytes(r.payload) for r in one] == ["é\r\n\r\n".encode()]
    assert warc.read_records(warc.write_bundles(warc.with_roles(df.limit(0)))).count() == 0
    kept = {r.id: r.record_type for r in warc.with_roles(df, least=2).collect()}
    assert kept[1] == kept[2] == kept[3] == "response"


def test_warc_headers(spark):
    rows = [(1, b"x", "http://h/a b\r\nX: y\u00e9%20"), (2, b"x", None), (3, b"", "")]
    df = spark.createDataFrame(rows, "id long, payload binary, url string").withColumn("first_id", F.lit("clash"))
    got = {}
    for b in warc.write_bundles(warc.with_roles(df), "2020-01-31T12:00:00Z").collect():
        for x, r in zip(b.records, warc.records_in(bytes(b.bundle), [x.asDict() for x in b.records])):
            got[x.record_id] = dict(h.split(": ", 1) for h in r.partition(b"\r\n\r\n")[0].decode().split("\r\n")[1:])
    assert {k: h["WARC-Target-URI"] for k, h in got.items()} == {"1": "http://h/a%20b%0D%0AX:%20y%C3%A9%20", "2": "urn:record:2", "3": "urn:record:3"}
    assert {h["WARC-Date"] for h in got.values()} == {"2020-01-31T12:00:00Z"} and got["1"]["WARC-Type"] == "revisit"


def test_bundles_are_seekable_and_standard():
    import zstandard

    pieces = [(str(k), bytes([k]) * 200_000) for k in range(5)]
    [(bundle, index)] = list(warc.bundles_of(iter(pieces)))
    assert len(warc.seek_table(bundle)) == 5 and [x["frame"] for x in index] == list(range(5))
    assert list(warc.records_in(bundle, [index[3]])) == [pieces[3][1]]
    whole = zstandard.ZstdDecompressor().stream_reader(bundle, read_across_frames=True).read()
    assert whole == b"".join(p for _, p in pieces)


def test_imatch(spark, documents):
    rows = [(1, None), (2, ""), (3, "alpha beta gamma delta"), (4, "alpha beta gamma delta"), (4, "zeta"), (None, "alpha beta")]
    docs = documents(rows).select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    keep = imatch.lexicon(docs, 0.0, 1.0)
    signed = docs.withColumn("fingerprint", imatch.fingerprint_of(F.col("text"), keep))
    by_text = {r.text: r.fingerprint for r in signed.collect()}
    assert by_text[""] == "0" and by_text["zeta"] == "0" and by_text["alpha beta gamma delta"] != "0"
    sign = lambda text: imatch.fingerprint_of(text, keep)
    out = [(r.doc_id, r.text, r.next.text) for r in imatch.followed(docs, 3, sign).collect()]
    hashed = {r.text: r.h for r in docs.select("text", F.xxhash64("text").alias("h")).collect()}
    order = [*sorted([(4, "zeta"), (4, "alpha beta gamma delta")], key=lambda x: -hashed[x[1]]), (3, "alpha beta gamma delta"), (2, ""), (1, ""), (None, "alpha beta")]
    assert sorted(out, key=str) == sorted(((i, x, order[(k + 1) % 6][1]) for k, (i, x) in enumerate(order)), key=str)
    pair = spark.createDataFrame([("0", "0"), ("0", by_text["alpha beta gamma delta"])], "a string, b string")
    assert [r[0] for r in pair.select(imatch.likeness("a", "b")).collect()] == [1.0, 0.0]
    assert imatch.followed(docs.limit(0), 3, sign).count() == 0


def test_imatch_with_crowded_ids(spark, documents):
    # a third of the rows has no doc_id, a third the same one; one text is long, one row repeats
    long = words(60_000)
    rows = [(None, f"null {k}") for k in range(60)] + [(7, f"seven {k}") for k in range(59)] + [(k, f"own {k % 9}") for k in range(100, 160)] + [(7, long), (150, "own 6")]
    docs = documents(rows).select("doc_id", "text", F.xxhash64("text").alias("h"))
    order = [(r.doc_id, r.text) for r in sorted(docs.collect(), key=lambda r: (r.doc_id is None, -(r.doc_id or 0), -r.h))]
    out = imatch.followed(docs, 24, lambda text: F.length(text))
    assert sorted(((r.doc_id, r.text, r.next.text) for r in out.collect()), key=str) == sorted(((*x, order[(k + 1) % len(order)][1]) for k, x in enumerate(order)), key=str)
    part, tasks = imatch._parts(docs.withColumn("hash", F.col("h")), 24)
    sizes = docs.withColumn("hash", F.col("h")).groupBy(part).count()
    assert tasks == 48 and sizes.agg(F.max("count")).first()[0] <= 30


def test_lines(documents):
    out = {(r.doc_id, r.text): r for r in linedup.dedup_lines(documents(ROWS + [(9, "short\nnew line\n"), (10, "NEW  line\n\nx")])).collect()}
    assert (9, "new line\n") in out and (10, "\nx") in out and out[10, "\nx"].n_links == 1
    assert (4, "short") in out and (1, None) in out and (3, "   \n\n ") in out
    assert linedup.dedup_lines(documents([], "doc_id long, text string")).count() == 0


def test_language_model(documents):
    docs = documents(ROWS)
    out = kneser_ney.scored(docs, kneser_ney.fit(docs)).collect()
    assert len(out) == len(ROWS) and all(np.isfinite(r.score) and r.score <= 0 for r in out)
    assert {r.n_tokens for r in out if r.doc_id in (1, 2, 3)} == {1}
    blank = kneser_ney.scored(docs, kneser_ney.fit(docs.limit(0))).collect()
    assert all(r.n_known == 0 and r.base_score == 0 for r in blank)


def test_near_duplicates(documents):
    out = [(r.doc_id, r.class_id, r.class_size) for r in neardup.classes_of(documents(ROWS)).collect()]
    assert sorted(x for x in out if x[0] == 4) == [(4, 4, 2), (4, 4, 2)]
    assert (6, 6, 2) in out and (7, 6, 2) in out
    assert {x for x in out if x[0] in (1, 2, 3)} == {(1, 1, 4), (2, 1, 4), (3, 1, 4)} and (None, 1, 4) in out
    assert neardup.classes_of(documents([], "doc_id long, text string")).count() == 0


def test_near_duplicate_stage_keeps_one_of_each(spark, documents):
    kept = neardup.stage(spark, documents(ROWS), "").collect()
    assert sorted(r.doc_id for r in kept if r.doc_id) == [1, 4, 5, 6, 8] and len(kept) == 6, kept


def test_decontamination(documents):
    item = words(30, 5).split()
    changed = [*item]
    for k in (4, 11, 19):
        changed[k] = "changed"
    docs = documents([*ROWS, (20, "x y " + " ".join(item) + " z"), (21, " ".join(changed)), (22, "tiny ITEM, here"), (23, " ".join(item[:6]))])
    bench = documents([(1, " ".join(item)), (2, "tiny item here"), (3, None), (4, "")]).withColumnRenamed("doc_id", "item_id")
    assert sorted((r.doc_id, r.item_id) for r in decontaminate.contaminated(docs, bench).collect()) == [(20, 1), (21, 1), (22, 2)]
    assert decontaminate.contaminated(docs, bench.limit(0)).count() == 0
    assert decontaminate.contaminated(docs.limit(0), bench).count() == 0


@pytest.mark.parametrize("fraction, n", [(0.0, 0), (0.5, 6), (1.0, 11)])
def test_resampling(spark, documents, fraction, n):
    docs = documents(ROWS)
    target = spark.createDataFrame([(4,), (None,)], "doc_id long")
    scores = sorted((r.score for r in resample.resample(docs, target, 1.0).collect()), reverse=True)
    kept = [r.score for r in resample.resample(docs, target, fraction).collect()]
    assert sorted(kept, reverse=True) == [s for s in scores if n and s >= scores[n - 1]]
    assert resample.resample(docs.limit(0), target, fraction).count() == 0
    assert resample.resample(docs, target.limit(0), 1.0).filter("log_weight <> 0").count() == 0


def test_top_keeps_ties(spark):
    df = spark.createDataFrame([(float(x),) for x in (5, 3, 3, 1, -7)], "s double")
    assert sorted(r.s for r in resample.top(df, 2, "s").collect()) == [3.0, 3.0, 5.0]


def test_bpe_is_tiktoken(documents):
    import tiktoken

    path, pattern = tokenizer()
    own = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=bpe.read_ranks(path), special_tokens={})
    odd = ["a\x1cb \x85 c d", "​ x﻿", "naïve  \n\n  x", "日本語   ", "١٢٣ ¾", "é \U0001f600", "'s 'S I'LL", "\t\t x\r\n y ", "ab" * 3_000]
    docs = documents([*ROWS, *((30 + k, x) for k, x in enumerate(odd))])
    for r in bpe.encode(docs, path, pattern).collect():
        ids = own.encode_ordinary(r.text or "")
        assert list(r.ids) == ids and bytes(r.decoded) == (r.text or "").encode()
    for r in bpe.digests(docs.withColumn("text", F.col("text")), path, pattern).filter("doc_id = 6").collect():
        ids = own.encode_ordinary(LONG)
        assert r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
    assert bpe.digests(docs.limit(0), path, pattern).count() == 0


PAGE = """<!DOCTYPE html><html><head><title>t</title><style>p{}</style><script>var a="<p>no</p>";</script></head><body>
<header class="site"><h2>Site</h2></header><nav><ul><li><a>Home</a></ul></nav><div class="cookie-notice">We use cookies</div>
<article><h1>The &eacute;vent &amp; more</h1><p><b>One<br>two<p>Three &nbsp; four</p><div class="ad">Buy</div><form>mail <input></form>
<section class="comments"><p>first!</p></section></article><aside>Other</aside><footer>&copy; x</footer></body></html>"""


def test_html(spark):
    rows = [(1, "http://a.example/1", PAGE), (2, None, None), (3, "x", ""), (4, "http://b.example", "<p>only <!-- no --> text<p>again"), (4, "http://b.example", "<p>only <!-- no --> text<p>again"), (5, "http://c.example", "a < b <unclosed")]
    out = {r.page_id: r.text for r in html.extract(spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("node", F.lit(1))).collect()}
    assert out == {1: "The évent & more\nOne two\nThree four", 2: "", 3: "", 4: "only text\nagain", 5: "a < b <unclosed"}
    assert html.extract(spark.createDataFrame(rows, "page_id long, url string, html string").limit(0)).count() == 0


def test_site_tree_cuts_what_every_page_repeats(spark):
    rows = [(k, "http://s.example/x", f"<body><div><p>Same words on every page</p></div><div class='t'><p>{words(30, k)}</p><p>{words(20, 100 + k)}</p></div></body>") for k in range(12)]
    out = html.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert all(r.text == f"{words(30, r.page_id)}\n{words(20, 100 + r.page_id)}" for r in out)


def test_site_tree_cuts_repeated_blocks_inside_a_marked_article(spark):
    body = lambda k: f"<h1>Title {k}</h1><p>Body number {k} tells of {k} things.</p>"
    rows = [(k, f"http://m.com/{k}", f"<body><article>{body(k)}<p>Join our list now</p><div><ul><li>Mail<li>Post</ul></div></article></body>") for k in range(8)]
    rows += [(100 + k, f"http://few.com/{k}", f"<body><section><p>Only {k} here</p></section><div>Same {'words '}</div></body>") for k in range(2)]
    rows += [(200 + k, f"http://copies.com/{k}", f"<body><div>ad {k}</div><article><h1>Copy</h1><p>One text of all</p></article></body>") for k in range(6)]
    rows += [(300 + k, f"http://near.com/{k}", f"<body><main><h1>Copy {k}</h1><p>One long text that all of these pages have</p></main></body>") for k in range(6)]
    out = {r.page_id: r.text for r in html.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert all(out[k] == f"Title {k}\nBody number {k} tells of {k} things." for k in range(8))
    assert [out[100], out[101]] == ["Only 0 here", "Only 1 here"]
    assert all(out[200 + k] == "Copy\nOne text of all" for k in range(6))
    assert all(out[300 + k] == f"Copy {k}\nOne long text that all of these pages have" for k in range(6))


def test_class_words_never_take_an_article(spark):
    text = "<h1>Title</h1><p>Some words of it</p>"
    whole = [
        f"<div class='content-sidebar-wrap'><main><article>{text}</article></main></div>",
        f"<div class='page no-sidebar'>{text}</div>",
        f"<div class='search-content'>{text}</div>",
        f"<div class='sidebar'><article class='post social'>{text}</article></div>",
        "<article><div class='entry-header'><h1>Title</h1></div><p class='notice'>Some words of it</p></article>",
        "<article><h1>Title</h1><section class='discussion'><p class='tags related'>Some words of it</p></section></article>",
        f"<main>{text}<div class='comments'><article class='comment'>no</article></div><div class='ad-slot'>no</div><p class='newsletter'>no</p></main>",
    ]
    rows = [(k, f"http://{k}.com/", f"<body>{x}</body>") for k, x in enumerate(whole)]
    site = lambda k: f"<body><p>{words(20, k)}</p><div class='notice'>{words(9, 50 + k)}</div><div class='menu'>Home</div></body>"
    rows += [(100 + k, "http://site.com/", site(k)) for k in range(6)] + [(200, "http://one.com/", site(0))]
    out = {r.page_id: r.text for r in html.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert {k: out[k] for k in range(len(whole))} == {k: "Title\nSome words of it" for k in range(len(whole))}
    assert all(out[100 + k] == f"{words(20, k)}\n{words(9, 50 + k)}" for k in range(6)) and out[200] == words(20, 0)


def test_seeds_hit_every_pattern():
    import itertools

    for n in range(1, 21):
        masks = decontaminate.SEEDS[max(k for k in decontaminate.SEEDS if k <= n)]
        shifted = [{i + at for i, bit in enumerate(m) if bit == "1"} for m in masks for at in range(n - len(m) + 1)]
        replaced = n - int(np.ceil(decontaminate.LEAST * n))
        assert all(any(not ones & set(gone) for ones in shifted) for gone in itertools.combinations(range(n), replaced)), n


def test_decontamination_of_short_and_partly_quoted_items(documents):
    sizes = {1: (20, (1, 7, 11, 17)), 2: (15, (1, 6, 11)), 3: (12, (3, 7)), 4: (8, (4,)), 5: (5, (2,)), 6: (4, ())}
    items, rows = {k: words(n, 70 + k).split() for k, (n, _) in sizes.items()}, []
    for k, (_, gone) in sizes.items():
        rows.append((100 + k, " ".join("changed" if i in gone else x for i, x in enumerate(items[k]))))
        rows.append((200 + k, " ".join("changed" if i in (*gone, 0, 3) else x for i, x in enumerate(items[k]))))
    items[7] = words(60, 90).split()
    rows.append((107, "a b c " + " ".join(["changed" if k in (14, 15, 17, 18) else x for k, x in enumerate(items[7][20:40])]) + " d e f g h i j"))
    bench = documents([(k, " ".join(x)) for k, x in items.items()]).withColumnRenamed("doc_id", "item_id")
    out = {(r.doc_id, r.item_id) for r in decontaminate.contaminated(documents(rows), bench).collect()}
    assert out == {(100 + k, k) for k in items}


def test_lines_of_documents_without_an_id_of_their_own(documents):
    own = [words(12, k) for k in range(4)]
    variant = own[0].replace(own[0].split()[0], "changed")
    rows = [(1, own[0]), (None, f"license line\n{variant}"), (None, f"license line\n{own[1]}"), (None, f"license line\n{own[2]}"), (7, f"head\n{own[3]}"), (7, f"tail\n{own[3]} more")]
    out = [(r.doc_id, r.text) for r in linedup.dedup_lines(documents(rows)).collect()]
    left = [line for _, x in out for line in x.split("\n")]
    assert len(out) == 6 and left.count("license line") == 1 and variant not in left
    assert left.count(own[0]) == left.count(own[1]) == left.count(own[2]) == 1
    assert left.count(own[3]) + left.count(f"{own[3]} more") == 1


CLASH = ["__id", "__h", "__turn", "__lang", "__score", "predicted", "score", "head_id", "head_hash", "head_turn", "leaked_id", "n_links", "n_lines", "lang_pred", "h", "turn", "id"]


def clashing(df):
    return df.withColumns({c: F.lit(f"own {c}") for c in CLASH})


@pytest.mark.parametrize("name", ["language_id", "line_dedup", "near_duplicates", "decontamination", "bpe"])
def test_stages_of_the_pipeline(spark, documents, name):
    """Nulls, empty and repeated rows, an empty table, and columns with the stages' own names, which come out as they went in."""
    import corpus_pipeline

    stage, docs = dict(corpus_pipeline.STAGES)[name], clashing(documents(ROWS + [(10, "die katze"), (10, "die katze")]))
    out = stage(spark, docs, "/root/testdata/sf0.001")
    assert stage(spark, docs.limit(0), "/root/testdata/sf0.001").collect() == []
    if name == "bpe":
        assert out.count() == len(ROWS) + 2
        return
    assert out.columns == docs.columns
    rows = out.collect()
    assert rows and all(r[c] == f"own {c}" for r in rows for c in CLASH)


def test_pipeline_with_clashing_names(spark, documents, monkeypatch):
    import corpus_pipeline

    real = corpus_pipeline.table
    monkeypatch.setattr(corpus_pipeline, "table", lambda s, d, n: clashing(real(s, d, n)))
    named = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    monkeypatch.setattr(corpus_pipeline, "table", real)
    plain = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    digests = lambda df: {(r.doc_id, r.ids_sha256) for r in df.collect()}
    assert digests(named) == digests(plain) != set()
    monkeypatch.setattr(corpus_pipeline, "table", lambda s, d, n: real(s, d, n).limit(0))
    assert corpus_pipeline.run(spark, "/root/testdata/sf0.001").collect() == []
