"""The queries of this subpackage, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from factloom.llm import decontam, fingerprints, jaccard, language, mixing, pii, quality, secrets, structure, tokenids, toxicity, turns, warc

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_decontamination": decontam.op1_decontamination,
    "op2_language": language.op2_language,
    "op3_toxicity": toxicity.op3_toxicity,
    "op4_jaccard": jaccard.op4_jaccard,
    "op5_token_ids": tokenids.op5_token_ids,
    "op6_pii": pii.op6_pii,
    "op7_warc": warc.op7_warc,
    "op8_fingerprints": fingerprints.op8_fingerprints,
    "op9_quality": quality.op9_quality,
    "op10_mixing": mixing.op10_mixing,
    "op11_turns": turns.op11_turns,
    "op12_structure": structure.op12_structure,
    "op13_secrets": secrets.op13_secrets,
}

#: Operators with trained, sampled or sketched results have no SQL; they are tested against brute force, round trips or held-out labels.
#: DuckDB has no base32, so the digest is built from its bits.
SQL: dict[str, str] = {
    "op4_jaccard": r"""
        WITH RECURSIVE w AS (
          SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
        ), s AS (
          SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN CAST([] AS VARCHAR[]) WHEN len(w) < 5 THEN [array_to_string(w, ' ')] ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(list_slice(w, i, i + 4), ' ')) END) AS s FROM w
        ), u AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM s),
        l AS (
          SELECT a.doc_id AS x, b.doc_id AS y FROM u a JOIN u b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))
        ), e AS (SELECT x, y FROM l UNION ALL SELECT y, x FROM l),
        r AS (SELECT doc_id AS id, doc_id AS c FROM s UNION SELECT e.y, r.c FROM r JOIN e ON r.id = e.x)
        SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, min(r.c) AS component_id FROM s JOIN r ON r.id = s.doc_id GROUP BY s.doc_id, s.s
    """,
    "op7_warc": """
        WITH p AS (
          SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS h FROM pages
        ), b AS (
          SELECT *, list_aggregate(list_transform(range(0, 40), lambda i: lpad(CAST(CAST(bin(CAST(concat('0x', substr(h, CAST(i + 1 AS INTEGER), 1)) AS INTEGER)) AS VARCHAR) AS VARCHAR), 4, '0')), 'string_agg', '') AS bits FROM p
        ), d AS (
          SELECT page_id, html, list_aggregate(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(1 +
            16 * CAST(substr(bits, CAST(5 * i + 1 AS INTEGER), 1) AS INTEGER) + 8 * CAST(substr(bits, CAST(5 * i + 2 AS INTEGER), 1) AS INTEGER) +
            4 * CAST(substr(bits, CAST(5 * i + 3 AS INTEGER), 1) AS INTEGER) + 2 * CAST(substr(bits, CAST(5 * i + 4 AS INTEGER), 1) AS INTEGER) +
            CAST(substr(bits, CAST(5 * i + 5 AS INTEGER), 1) AS INTEGER) AS INTEGER), 1)), 'string_agg', '') AS digest FROM b
        ), m AS (SELECT *, max(page_id) OVER (PARTITION BY html) AS best FROM d)
        SELECT page_id, CAST(strlen(html) AS BIGINT) AS payload_bytes, digest AS payload_digest,
          CASE WHEN page_id = best THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id = best THEN NULL ELSE best END AS refers_to FROM m
    """,
    "op11_turns": turns.SQL,
}
