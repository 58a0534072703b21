"""The corpus operators' queries by name, and SQL for those that SQL can express."""

from __future__ import annotations

from . import bpe, conversations, decontaminate, embeddings, html, imatch, kneser_ney, langid, linedup, neardup, negatives, resample, warc

QUERIES = {
    "op1_warc": warc.op1_warc,
    "op2_imatch": imatch.op2_imatch,
    "op3_line_dedup": linedup.op3_line_dedup,
    "op4_kneser_ney": kneser_ney.op4_kneser_ney,
    "op5_near_duplicates": neardup.op5_near_duplicates,
    "op6_resample": resample.op6_resample,
    "op7_decontaminate": decontaminate.op7_decontaminate,
    "op8_language": langid.op8_language,
    "op9_bpe": bpe.op9_bpe,
    "op10_html": html.op10_html,
    "op11_conversations": conversations.op11_conversations,
    "op12_hard_negatives": negatives.op12_hard_negatives,
    "op13_embedding_duplicates": embeddings.op13_embedding_duplicates,
}

ORACLE_SQL = {
    "op1_warc": """
        WITH p AS (
            SELECT page_id, coalesce(html, '') AS html, octet_length(encode(coalesce(html, ''))) AS payload_bytes,
                   sha1(coalesce(html, '')) AS h
            FROM pages
        ), d AS (
            SELECT page_id, payload_bytes, max(page_id) OVER (PARTITION BY h, payload_bytes) AS first_id,
                   array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                       1 + CAST((CAST('0x' || substr(h, 1 + 5 * (i // 4), 5) AS BIGINT) >> (15 - 5 * (i % 4))) & 31 AS INTEGER), 1)), '') AS payload_digest
            FROM p
        )
        SELECT page_id, payload_bytes, payload_digest,
               CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN page_id = first_id THEN NULL ELSE first_id END AS refers_to
        FROM d
    """,
    "op11_conversations": r"""
        WITH RECURSIVE keyed AS (
            SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS k FROM conversations
        ), coded AS (  -- the CRC bit by bit: a byte comes in before every eighth
            SELECT conv_id, turn, role, text, xor(4294967295, list_reduce(
                list_prepend(4294967295::BIGINT, flatten(list_transform(string_split(k, ''), lambda c: [ord(c)::BIGINT, 0, 0, 0, 0, 0, 0, 0]))),
                lambda s, x: xor(xor(s, x) >> 1, 3988292384 * (xor(s, x) & 1)))) % 20 AS code FROM keyed
        ), damaged AS (
            SELECT conv_id, turn, CASE code WHEN 4 THEN 'user' ELSE role END AS role, CASE code WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
            FROM coded, range(2) t(again) WHERE code <> 0 AND (again = 0 OR code = 3)
        ), numbered AS (
            SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i FROM damaged
        ), faulty AS (
            SELECT conv_id, turn, role, text, i, left(role, 1) AS r, lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS before,
                   CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'b' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'd'
                        WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') THEN 't' ELSE '' END AS fault FROM numbered
        ), best AS (  -- the state after i turns, and the cheapest, then least way to it
            SELECT DISTINCT conv_id, 0::BIGINT AS i, '' AS state, 0::BIGINT AS cost, '' AS audit FROM conversations
            UNION ALL
            SELECT conv_id, i, state, min(struct_pack(c := cost, a := audit)).c, min(struct_pack(c := cost, a := audit)).a FROM (
                SELECT b.conv_id, f.i, b.cost + CASE WHEN m LIKE 'I%' THEN 5 ELSE 0 END + CASE right(m, 1) WHEN 'D' THEN 2 WHEN 'R' THEN 1 ELSE 0 END + CASE WHEN f.fault = 't' AND m NOT LIKE '%D' THEN 5 ELSE 0 END AS cost,
                       b.audit || m AS audit, CASE right(m, 1) WHEN 'D' THEN mid WHEN 'R' THEN CASE mid WHEN 'u' THEN 'a' ELSE 'u' END
                       ELSE CASE WHEN f.r = 's' AND mid = '' THEN 's' WHEN f.r = 'u' AND mid <> 'u' THEN 'u' WHEN f.r = 'a' AND mid = 'u' THEN 'a' END END AS state
                FROM (SELECT *, CASE WHEN m NOT LIKE 'I%' THEN state WHEN state = 'u' THEN 'a' ELSE 'u' END AS mid FROM best, (VALUES ('D'), ('ID'), ('IK'), ('IR'), ('K'), ('R')) v(m)) b
                JOIN faulty f ON f.conv_id IS NOT DISTINCT FROM b.conv_id AND f.i = b.i + 1 WHERE f.fault NOT IN ('b', 'd') OR m LIKE '%D'
            ) WHERE state IS NOT NULL GROUP BY conv_id, i, state
        ), ended AS (
            SELECT conv_id, cost + CASE state WHEN 's' THEN 10 WHEN 'u' THEN 5 ELSE 0 END AS cost, audit || CASE state WHEN 's' THEN 'II' WHEN 'u' THEN 'I' ELSE '' END AS audit
            FROM best QUALIFY i = max(i) OVER (PARTITION BY conv_id)
        ), chosen AS (
            SELECT conv_id, cost, audit FROM ended QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY cost, audit) = 1
        ), pieces AS (
            SELECT conv_id, p, audit[p] AS edit, p - length(replace(audit[:p], 'I', '')) AS inserted, length(replace(audit[:p], 'D', '')) - length(replace(audit, 'D', '')) % 2 AS place
            FROM chosen, unnest(range(1, length(audit) + 1)) t(p)
        ), lines AS (
            SELECT c.conv_id, p, CASE WHEN edit = 'K' THEN f.role WHEN place % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || CASE WHEN edit = 'I' THEN '' ELSE f.text END AS line
            FROM pieces c LEFT JOIN faulty f ON f.conv_id IS NOT DISTINCT FROM c.conv_id AND f.i = c.p - c.inserted AND edit <> 'I' WHERE edit <> 'D'
        ), digests AS (SELECT conv_id, sha256(string_agg(line, chr(10) ORDER BY p)) AS sha FROM lines GROUP BY conv_id),
        counts AS (
            SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'b') AS blank, count(*) FILTER (fault = 'd') AS duplicate,
                   count(*) FILTER (fault = 't') AS truncated, count(*) FILTER (i > 1 AND before || r NOT IN ('su', 'ua', 'au')) AS illegal FROM faulty GROUP BY conv_id
        )
        SELECT c.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
               cost, audit, coalesce(sha, sha256('')) AS repaired_sha256
        FROM chosen c LEFT JOIN counts n ON n.conv_id IS NOT DISTINCT FROM c.conv_id LEFT JOIN digests d ON d.conv_id IS NOT DISTINCT FROM c.conv_id
    """,
    "op12_hard_negatives": """
        WITH v AS (
            SELECT vec_id, CAST(CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS BIGINT) AS label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
            FROM embeddings
            WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), s AS (
            SELECT a.vec_id AS anchor_id, r.vec_id AS id, a.label = r.label AS same, CAST(list_inner_product(a.v, r.v) AS BIGINT) AS score
            FROM v a JOIN v r ON a.vec_id <> r.vec_id WHERE a.vec_id % 100 = 0
        ), p AS (
            SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE same
            QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5
        )
        SELECT anchor_id, positive_id, CAST(row_number() OVER w AS INTEGER) AS rank, id AS negative_id, positive_score, score AS negative_score
        FROM p JOIN s USING (anchor_id) WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
        WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id)
        QUALIFY row_number() OVER w <= 10
    """,
    "op13_embedding_duplicates": """
        WITH RECURSIVE v AS (
            SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
            WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0
        ), links AS (
            SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE list_cosine_similarity(a.e, b.e) >= 0.9
        ), reach AS (
            SELECT vec_id AS id, vec_id AS root FROM embeddings UNION SELECT l.b, r.root FROM reach r JOIN links l ON l.a = r.id
        ), root AS (SELECT id, min(root) AS component_id FROM reach GROUP BY id)
        SELECT id AS vec_id, (SELECT count(*) FROM links WHERE a = id) AS n_links, component_id, id = component_id AS kept FROM root
    """,
}
