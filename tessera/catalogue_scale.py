"""Queries whose tables grow: pair work, templates, numbered lines, streams and builds, each with SQL.

Bindings: turns of ``conversations`` are records (key ``conv_id``, value: the length of the
text); ``documents`` give metrics, prompts and lines.
"""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from .catalogue import ORACLE_SQL, PAIRS, _name_pairs, _vectors, query
from .operators import balance as B
from .operators import checks as C
from .operators import entities as E
from .operators import neighbours as K
from .operators import selection as S
from .plans import pair_builds as G
from .plans import record_splits as R
from .plans import records as W
from .plans import templates
from .plans import universes as U
from .sources import numbered as N
from .sources import observed as O
from .sources.shared import shared_folder
from .streaming import best


def _turns(t):
    """Turns as records; a turn's id is the conversation's and its own number."""
    return t("conversations").select((F.col("conv_id") * 100_000 + F.col("turn")).alias("id"), F.length("text").cast("double").alias("value"), F.col("conv_id").alias("conv"), "role")


TURNS = "SELECT conv_id * 100000 + turn AS id, length(text)::DOUBLE AS value, conv_id AS conv, role FROM conversations"


@query(
    f"WITH r AS ({TURNS}) SELECT a.conv, (abs(a.value - b.value) <= 10)::INT AS label, count(*) AS n, sum(a.id % 1000 * 31 + b.id % 1000)::BIGINT AS ends FROM r a JOIN r b ON a.conv = b.conv AND a.id < b.id "
    "WHERE abs(a.value - b.value) <= 10 OR abs(a.value - b.value) >= 30 GROUP BY ALL"
)
def conversation_pairs(spark, t):
    """Pairs of turns within each conversation, counted by label; conversations of any length are cut into even cells."""
    pairs = B.balanced_pairs(_turns(t), ["conv"])
    return pairs.groupBy(F.col("conv_a").alias("conv"), "label").agg(F.count("*").alias("n"), F.sum(F.col("id_a") % 1000 * 31 + F.col("id_b") % 1000).alias("ends"))


@query(
    "WITH k AS (SELECT conv_id, count(*) * (count(*) - 1) // 2 AS pairs FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id HAVING count(*) > 1), "
    "p AS (SELECT *, sum(pairs) OVER (ORDER BY conv_id)::BIGINT - pairs AS below, greatest(1, (sum(pairs) OVER ()::BIGINT + 63) // 64) AS width FROM k), "
    "c AS (SELECT *, unnest(range(below // width, (below + pairs - 1) // width + 1)) AS cell FROM p) "
    "SELECT conv_id, cell, greatest(0, cell * width - below) AS \"begin\", least(pairs, (cell + 1) * width - below) AS \"end\", least(pairs, (cell + 1) * width - below) - greatest(0, cell * width - below) AS pairs FROM c"
)
def pair_cells(spark, t):
    """The conversations' pairs in 64 ranges of equally many."""
    return B.pair_cells(t("conversations"), ["conv_id"], F.col("conv_id"), 64)


TEMPLATE = """{# one document as a question about its quality #}
Document {{ doc_id }} in {{ lang|upper if lang is not none else "an unknown language" }}
- source: {{ source if source is not none else "not specified" }}
- length: {{ ("%.1f"|format(thousands)) }} thousand characters
{% if quality is none %}
- no label
{% elif quality > 0 and toxic == 0 %}
- label: good{% else %}
- label: poor{% endif %}

Is it worth reading?
(A) yes
(B) no

Answer:

"""


@query(
    "SELECT d.doc_id, sha256('Document ' || d.doc_id || ' in ' || coalesce(upper(d.lang), 'an unknown language') || chr(10) || '- source: ' || coalesce(d.source, 'not specified') || chr(10) || '- length: ' || printf('%.1f', d.n_chars / 1000.0) || ' thousand characters' || chr(10) || "
    "CASE WHEN l.quality IS NULL THEN '- no label' || chr(10) WHEN l.quality > 0 AND l.toxic = 0 THEN '- label: good' ELSE '- label: poor' END || chr(10) || "
    "'Is it worth reading?' || chr(10) || '(A) yes' || chr(10) || '(B) no' || chr(10) || chr(10) || 'Answer:' || chr(10)) AS prompt_sha FROM documents d LEFT JOIN labels l USING (doc_id)"
)
def templated_prompts(spark, t):
    """A prompt for every document from a template with conditions, filters and a remark, as one expression."""
    rows = t("documents").join(t("labels").select("doc_id", "quality", "toxic"), "doc_id", "left").withColumn("thousands", F.col("n_chars") / 1000)
    return rows.select("doc_id", F.sha2(templates.rendered(TEMPLATE), 256).alias("prompt_sha"))


@query("SELECT doc_id, row_number() OVER (ORDER BY doc_id) AS line, length(text) AS n FROM documents")
def numbered_documents(spark, t):
    """Documents written as JSON lines in the order of their ids, and read again with the lines' numbers over all files."""
    path = shared_folder(spark, "lines")
    said = t("documents").select("doc_id", F.to_json(F.struct("doc_id", F.length("text").alias("n"))).alias("value"))
    said.repartitionByRange("doc_id").sortWithinPartitions("doc_id").select("value").write.text(path)
    rows = N.json_rows(spark, "doc_id long, n int", path)
    # there is a row a file here
    files = rows.groupBy("file").agg(F.max("line").alias("lines"), F.min("doc_id").alias("first"))
    before = F.coalesce(F.sum("lines").over(Window.orderBy("first").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return rows.join(files.withColumn("before", before), "file").select("doc_id", (F.col("line") + F.col("before")).alias("line"), "n")


@query(
    "SELECT lang AS key, doc_id AS step, n_chars::DOUBLE AS value FROM (SELECT lang, doc_id, n_chars, max(n_chars) OVER (PARTITION BY lang ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM documents) WHERE before IS NULL OR n_chars > before"
)
def best_so_far(spark, t):
    """Documents longer than all of their language before them, from a stream of lengths that is stopped half-way and goes on from its checkpoint."""
    folder, state, sink = (shared_folder(spark, n) for n in ("lengths", "state", "best"))
    rows = t("documents").select("doc_id", "lang", F.col("n_chars").cast("double").alias("n"))
    ends = rows.agg(F.min("doc_id"), F.max("doc_id")).first()
    middle = ((ends[0] or 0) + (ends[1] or 0)) // 2
    out = best.BatchSink(sink)
    for part in (F.col("doc_id") <= middle, F.col("doc_id") > middle):
        rows.filter(part).write.mode("append").parquet(folder)
        stream = spark.readStream.schema(rows.schema).parquet(folder)
        found = best.improvements(stream, "lang", "doc_id", "n")
        found.writeStream.foreachBatch(out).option("checkpointLocation", state).trigger(availableNow=True).start().awaitTermination()
    return out.rows(spark)


UNIVERSES = {"conversation": ["conv"], "role": ["conv", "role"], "parity": ["conv", "parity"]}
IN_UNIVERSE = "(v.u = 'conversation' OR (v.u = 'role' AND a.role = b.role) OR (v.u = 'parity' AND a.id % 2 = b.id % 2))"


@query(
    f"WITH r AS ({TURNS}), p AS (SELECT v.u AS universe, (abs(a.value - b.value) <= 10)::INT AS label, CASE WHEN (a.id + b.id) % 50 = 0 THEN 'eval' WHEN a.id % 7 = 3 OR b.id % 7 = 3 THEN 'discard' ELSE 'train' END AS route "
    f"FROM r a JOIN r b ON a.conv = b.conv AND a.id < b.id, (VALUES ('conversation'), ('role'), ('parity')) v(u) WHERE (abs(a.value - b.value) <= 10 OR abs(a.value - b.value) >= 30) AND {IN_UNIVERSE}) "
    "SELECT universe, route, label, count(*) AS n FROM p GROUP BY ALL"
)
def universe_routes(spark, t):
    """Three universes of pairs of turns from one join, with one selection for all of them."""
    turns = _turns(t).withColumn("parity", F.col("id") % 2)
    pairs = U.universe_pairs(turns, UNIVERSES)
    picked = pairs.filter((F.col("id_a") + F.col("id_b")) % 50 == 0).select("id_a", "id_b")
    barred = turns.filter("id % 7 = 3").select("id")
    return U.routed_universes(pairs, picked, barred, list(UNIVERSES)).groupBy("universe", "route", "label").agg(F.count("*").alias("n"))


LANGS = ["de", "en", "fr", "es"]


@query(
    "WITH d AS (SELECT *, doc_id % 10 <> 0 AND n_chars <= 5000 AS kept, CASE WHEN lang IN ('de', 'en', 'fr', 'es') THEN lang WHEN lang IS NULL THEN 'null' ELSE 'other values' END AS l FROM documents), "
    "v AS (SELECT unnest(['de', 'en', 'fr', 'es', 'null', 'other values']) AS l), "
    "c AS (SELECT v.l AS what, count(d.doc_id) AS before, count(d.doc_id) FILTER (kept) AS after FROM v LEFT JOIN d ON d.l = v.l GROUP BY v.l) "
    "SELECT 'lang ' || what AS what, before, after FROM c UNION ALL SELECT 'rows', count(*), count(*) FILTER (kept) FROM d UNION ALL SELECT 'n_chars', sum(n_chars)::BIGINT, sum(n_chars) FILTER (kept)::BIGINT FROM d"
)
def observed_manifest(spark, t):
    """Documents written without long ones and some others, and what was counted before and after while they were written."""
    kept = (F.col("doc_id") % 10 != 0) & (F.col("n_chars") <= 5000)
    said = O.write_counted(t("documents").select("doc_id", "lang", "n_chars"), shared_folder(spark, "kept"), kept, {"lang": LANGS}, {"n_chars": F.col("n_chars")})
    before, after = said["before"], said["after"]
    rows = [(f"lang {k}", before["lang"][k], after["lang"][k]) for k in before["lang"]]
    rows += [("rows", before["rows"], after["rows"]), ("n_chars", before["sums"]["n_chars"], after["sums"]["n_chars"])]
    return spark.createDataFrame(rows, "what string, before long, after long")


def _capped(t):
    m = F.col("conv_id") % 10
    entities = R.labelled_entities(t("conversations").withColumn("size", F.length("text")), "conv_id", "size", 300.0)
    return R.capped_splits(entities, "conv_id", m == 0, m <= 2, {"validation_1": 12, "validation_2": 12, "test": 20}, 31)


CAPPED = (
    "WITH m AS (SELECT conv_id, CASE WHEN median(length(text)) >= 300 THEN 1 ELSE 0 END AS label, count(text) AS n FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id), "
    "p AS (SELECT conv_id, row_number() OVER (PARTITION BY label ORDER BY sha256('31|smiles|' || conv_id), conv_id) AS rn, count(*) OVER (PARTITION BY label) AS c FROM m WHERE conv_id % 10 IN (1, 2)), "
    "s AS (SELECT m.*, CASE WHEN m.conv_id % 10 = 0 THEN 'test' WHEN p.rn IS NULL THEN 'train' WHEN p.rn <= ceil(p.c / 2) THEN 'validation_1' ELSE 'validation_2' END AS split FROM m LEFT JOIN p USING (conv_id)), "
    "b AS (SELECT *, coalesce(sum(n) OVER (PARTITION BY split ORDER BY n DESC, sha256('31|' || split || '|' || conv_id), conv_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before, sum(n) OVER (PARTITION BY split) AS whole FROM s), "
    "f AS (SELECT *, CASE split WHEN 'train' THEN false WHEN 'test' THEN whole - before > 20 ELSE whole - before > 12 END AS moved FROM b), e AS (SELECT *, CASE WHEN moved THEN 'train' ELSE split END AS final FROM f)"
)


@query(f"{CAPPED} SELECT conv_id, label, n, split, moved, final FROM e")
def capped_splits(spark, t):
    """Splits of conversations with caps on the turns that are held out; what is over them goes to training."""
    return _capped(t).select("conv_id", "label", "n", "split", "moved", "final")


@query(
    f"{CAPPED} SELECT 'assigned' AS stage, split, count(*) AS entities, sum(n)::BIGINT AS rows, count(*) FILTER (label = 1) AS positives, count(*) FILTER (moved) AS moved FROM e GROUP BY split "
    "UNION ALL SELECT 'capped', final, count(*), sum(n)::BIGINT, count(*) FILTER (label = 1), count(*) FILTER (moved) FROM e GROUP BY final"
)
def capped_split_report(spark, t):
    return R.split_report(_capped(t))


@query(
    "WITH r AS (SELECT conv_id, CASE WHEN turn % 5 = 4 THEN NULL ELSE role END AS role, CASE WHEN length(text) % 3 = 0 THEN 2.0 WHEN length(text) % 7 = 0 THEN NULL ELSE length(text) % 2 END AS y FROM conversations) "
    "SELECT 'null conv_id' AS fault, count(*) FILTER (conv_id IS NULL) AS n FROM r UNION ALL SELECT 'null role', count(*) FILTER (role IS NULL) FROM r UNION ALL SELECT 'non-binary y', count(*) FILTER (y IS NULL OR y NOT IN (0, 1)) FROM r"
)
def record_faults(spark, t):
    """Planted nulls and labels that aren't 0 or 1, counted in one pass."""
    n = F.length("text")
    rows = t("conversations").select("conv_id", F.when(F.col("turn") % 5 != 4, F.col("role")).alias("role"), F.when(n % 3 == 0, 2.0).when(n % 7 != 0, n % 2).alias("y"))
    return C.fault_counts(rows, ["conv_id", "role"], ["y"])


@query(ORACLE_SQL["tanimoto_neighbours"])
def pruned_neighbours(spark, t):
    """The rows of ``tanimoto_neighbours``, without the pairs whose popcounts rule them out."""
    q, s = _vectors(t)
    out = K.pruned_candidates(q.drop("q_vec"), s.drop("s_vec"), 10)
    return out.select("q_id", "s_id", F.col("rank").cast("long").alias("rank"), F.round("score", 6).alias("score"))


@query("SELECT row_number() OVER (ORDER BY min(doc_id)) - 1 AS entity_id, source, min(doc_id) AS first, count(*) AS n FROM documents WHERE source IS NOT NULL GROUP BY source")
def entity_table(spark, t):
    """Sources of documents, numbered as they are first seen."""
    return E.entity_table(t("documents"), "doc_id", "source")


@query(
    f"{PAIRS}, c AS (SELECT entity, count(*) AS cost FROM (SELECT name_a AS entity FROM pairs UNION ALL SELECT name_b FROM pairs) GROUP BY entity), "
    "e AS (SELECT DISTINCT least(name_a, name_b) AS a, greatest(name_a, name_b) AS b FROM pairs), d AS (SELECT entity, count(*) AS degree FROM (SELECT a AS entity FROM e UNION ALL SELECT b FROM e WHERE a <> b) GROUP BY entity), "
    "s AS (SELECT DISTINCT p_name AS entity FROM part WHERE p_size = 7), k AS (SELECT count(*) AS n FROM s), top AS (SELECT entity FROM d ORDER BY degree DESC, sha256(entity) LIMIT (SELECT n FROM k)), "
    "z AS (SELECT 'selected' AS choice, coalesce(sum(cost), 0)::BIGINT AS cost FROM c WHERE entity IN (SELECT entity FROM s) UNION ALL SELECT 'top degree', coalesce(sum(cost), 0)::BIGINT FROM c WHERE entity IN (SELECT entity FROM top)) "
    "SELECT choice, (SELECT n FROM k) AS entities, cost, greatest(0, (SELECT count(*) FROM pairs) - cost) AS kept FROM z"
)
def holdout_costs(spark, t):
    """What keeping the names of one size out of training costs, beside as many names of the highest degree."""
    pairs = _name_pairs(t)
    total = pairs.agg(F.sum("pairs")).first()[0] or 0
    chosen = t("part").filter("p_size = 7").select(F.col("p_name").alias("entity"))
    return E.holdout_costs(S.incident_costs(pairs, "p_name_a", "p_name_b", "pairs"), S.degrees(pairs, "p_name_a", "p_name_b"), chosen, total)


@query(
    f"WITH r AS ({TURNS}), v AS (SELECT *, CASE WHEN value IS NULL THEN 'missing value' WHEN coalesce(trim(role), '') = '' THEN 'missing entity' ELSE 'valid' END AS reason FROM r), "
    "p AS (SELECT (abs(a.value - b.value) <= 10)::INT AS label FROM v a JOIN v b ON a.conv = b.conv AND a.id < b.id WHERE a.reason = 'valid' AND b.reason = 'valid' AND (abs(a.value - b.value) <= 10 OR abs(a.value - b.value) >= 30)) "
    "SELECT 'records ' || reason AS what, count(*) AS n FROM v GROUP BY reason UNION ALL SELECT 'pairs ' || label, count(*) FROM p GROUP BY label "
    "UNION ALL SELECT 'candidates', sum(c * (c - 1) // 2)::BIGINT FROM (SELECT count(*) AS c FROM v WHERE reason = 'valid' AND conv IS NOT NULL GROUP BY conv)"
)
def pair_build(spark, t):
    """A whole build of pairs of turns: valid records, the pairs within conversations, and what it reports."""
    valid, counts = G.valid_records(_turns(t), "value", "role")
    pairs, report = G.built_pairs(valid, ["conv"])
    labels = pairs.groupBy("label").agg(F.count("*").alias("n")).select(F.concat(F.lit("pairs "), "label").alias("what"), "n")
    said = [(f"records {k}", n) for k, n in counts.items()] + [("candidates", report["candidates"])]
    return labels.unionByName(spark.createDataFrame(said, "what string, n long"))


@query(
    "SELECT doc_id::VARCHAR AS record_key, doc_id AS source_row_index, row_number() OVER (ORDER BY doc_id) - 1 AS source_position, quality::TINYINT AS label, "
    "(CASE WHEN lang IS NULL OR lower(trim(lang)) IN ('', 'na', 'n/a', 'nan', 'none', 'null', 'unknown', 'not reported') THEN '1' ELSE '0' END) || (CASE WHEN doc_id % 3 = 0 THEN '1' ELSE '0' END) AS missing_mask "
    "FROM documents JOIN labels USING (doc_id)"
)
def normalised_records(spark, t):
    """Labelled documents as records of a neighbour search, numbered in the order of their ids."""
    rows = t("documents").join(t("labels").select("doc_id", "quality"), "doc_id").withColumn("plain", F.when(F.col("doc_id") % 3 != 0, "x"))
    out = W.normalised_records(rows.select("doc_id", "lang", "plain", "quality"), "source", "doc_id", "doc_id", "quality", fields=["lang", "plain"])
    return out.select("record_key", "source_row_index", "source_position", "label", "missing_mask")
