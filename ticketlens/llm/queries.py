"""Registered queries of the operators: production parameters over whole tables.

``ORACLE`` has DuckDB SQL where SQL can express the result; the other queries
are held against brute force in the tests.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ticketlens.llm import (
    conversations,
    decontaminate,
    fim,
    language,
    licenses,
    mixing,
    neardup,
    pages,
    personal,
    quality,
    tokens,
    topk,
    toxicity,
)
from ticketlens.llm.common import table


def op1_dart_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate class of every document."""
    return neardup.near_duplicates(table(spark, sf_dir, "documents"))


def op2_token_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token files of all documents, read back."""
    return tokens.token_table(table(spark, sf_dir, "documents"))


def op3_ppm_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document."""
    return language.identify(table(spark, sf_dir, "documents"))


def op4_budget_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes of every document."""
    return mixing.mix_table(table(spark, sf_dir, "documents"))


def op5_bilstm_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data of every document."""
    docs = table(spark, sf_dir, "documents")
    return personal.personal_data(docs, personal.train(docs))


def op6_tiled_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five nearest vectors of every fiftieth one."""
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op7_ordinal_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Severity and flag of every document; ``labels.toxic`` gives the grades."""
    docs = table(spark, sf_dir, "documents")
    model = toxicity.train(docs, table(spark, sf_dir, "labels"), F.col("toxic"))
    return toxicity.grade_documents(docs, model)


def op8_page_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return pages.main_texts(table(spark, sf_dir, "pages"))


def op9_patience_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License notices in the documents."""
    return licenses.scan_licenses(table(spark, sf_dir, "documents"))


def op10_seed_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold a copy of a benchmark item."""
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op11_rule_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality metrics and verdict of every document."""
    return quality.quality_table(table(spark, sf_dir, "documents"))


def op12_swar_fim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fill-in-middle form of every document, with hashes of the output and of the restored text."""
    return fim.fill_in_middle_digests(table(spark, sf_dir, "documents"))


def op13_edit_lattice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation, damaged and repaired by its cheapest edits."""
    return conversations.repair_table(table(spark, sf_dir, "conversations"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_dart_minhash, op2_token_codes, op3_ppm_language, op4_budget_mix, op5_bilstm_crf,
        op6_tiled_topk, op7_ordinal_toxicity, op8_page_difference, op9_patience_licenses, op10_seed_alignment,
        op11_rule_cascade, op12_swar_fim, op13_edit_lattice,
    )
}

ORACLE: dict[str, str] = {
    "op6_tiled_topk": """
        WITH fit AS (
            SELECT row_number() OVER () AS place, vec_id, [CAST(floor(256 * CAST(x AS DOUBLE)) AS HUGEINT) FOR x IN embedding] AS v
            FROM embeddings
            WHERE vec_id IS NOT NULL AND len(embedding) > 0
              AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
        ), scored AS (
            -- query rows that share an id share a list, in which a candidate row stands once
            SELECT q.vec_id AS query_id, c.vec_id, c.place,
                   CAST(max(least(greatest(list_sum([q.v[i] * c.v[i] FOR i IN range(1, len(q.v) + 1)]),
                                           -9223372036854775808), 9223372036854775807)) AS BIGINT) AS score
            FROM fit q JOIN fit c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id AND len(q.v) = len(c.v)
            GROUP BY q.vec_id, c.vec_id, c.place
        ), ranked AS (
            SELECT query_id, vec_id, score,
                   CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank
            FROM scored
        )
        SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
    """,
    "op11_rule_cascade": r"""
        WITH docs AS (
            SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents
        ), cut AS (
            SELECT r, doc_id, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w,
                   [x FOR x IN string_split(text, chr(10)) IF regexp_matches(x, '[^\x20\x09-\x0D]')] AS lines
            FROM docs
        ), windows AS (
            SELECT r, i, count(*) OVER (PARTITION BY r, a, b, c) AS times
            FROM (SELECT r, unnest(range(1, len(w) - 1)) AS i, unnest(w[:-3]) AS a, unnest(w[2:-2]) AS b, unnest(w[3:]) AS c
                  FROM cut WHERE len(w) > 2)
        ), covered AS (
            SELECT r, count(DISTINCT p) AS n
            FROM (SELECT r, unnest([i, i + 1, i + 2]) AS p FROM windows WHERE times > 1) GROUP BY r
        ), metrics AS (
            SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words,
                   CAST(coalesce(list_sum([length(x) FOR x IN w]), 0) AS BIGINT) AS word_chars,
                   CAST(len(regexp_extract_all(text, '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
                   CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
                   CAST(coalesce(n, 0) AS BIGINT) AS n_repeat_words,
                   len(lines) AS n_lines,
                   len([x FOR x IN w IF regexp_matches(x, '\p{L}')]) AS n_letter_words,
                   len(regexp_extract_all(text, '\p{Lu}{2,}')) AS n_shouted
            FROM cut LEFT JOIN covered USING (r)
        ), judged AS (
            SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM metrics
        )
        SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
               NOT (base_failed OR 10 * n_symbols > n_words OR n_dup_lines >= 3 AND 100 * n_dup_lines > 30 * n_lines
                    OR word_chars < 3 * n_words OR word_chars > 10 * n_words
                    OR 100 * n_letter_words < 80 * n_words OR 2 * n_shouted > n_words) AS kept
        FROM judged
    """,
    "op12_swar_fim": r"""
        WITH docs AS (
            SELECT doc_id, coalesce(text, '') AS text,
                   regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS unit,
                   sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h
            FROM documents
        ), drawn AS (
            SELECT doc_id, text, unit, CAST(len(unit) AS BIGINT) AS n,
                   CAST(('0x' || h[1:8]) AS BIGINT) % (len(unit) + 1) AS c1,
                   CAST(('0x' || h[9:16]) AS BIGINT) % (len(unit) + 1) AS c2,
                   CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
                             OR CAST(('0x' || h[17:24]) AS BIGINT) % 100 >= 90 THEN 'plain'
                        WHEN CAST(('0x' || h[25:32]) AS BIGINT) % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
            FROM docs
        ), parts AS (
            SELECT doc_id, text, n, form,
                   array_to_string(unit[1:least(c1, c2)], '') AS prefix,
                   array_to_string(unit[least(c1, c2) + 1:greatest(c1, c2)], '') AS middle,
                   array_to_string(unit[greatest(c1, c2) + 1:], '') AS suffix
            FROM drawn
        )
        SELECT doc_id, n, form,
               -- whole numbers with NULLs reach pandas as DOUBLE from either engine
               CAST(CASE WHEN form <> 'plain' THEN length(prefix) END AS DOUBLE) AS prefix_chars,
               CAST(CASE WHEN form <> 'plain' THEN length(middle) END AS DOUBLE) AS middle_chars,
               sha256(CASE form WHEN 'plain' THEN text
                                WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                                ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
               sha256(CASE form WHEN 'plain' THEN text ELSE prefix || middle || suffix END) AS restored_sha256
        FROM parts
    """,
    "op13_edit_lattice": r"""
        WITH RECURSIVE given AS (
            SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
                   coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS key
            FROM conversations
        ), hit AS (  -- CRC-32: per byte one xor and eight shifts
            SELECT *, xor(list_reduce(
                       flatten([[CAST(ord(key[i]) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1] FOR i IN range(1, length(key) + 1)]),
                       lambda c, x: CASE WHEN x >= 0 THEN xor(c, x) WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END,
                       4294967295), 4294967295) % 20 AS kind
            FROM given
        ), damaged AS (
            SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
                   CASE kind WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text
            FROM (SELECT *, unnest(range(CASE kind WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) FROM hit)
        ), placed AS (
            SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i, left(role, 1) AS initial
            FROM damaged
        ), judged AS (
            SELECT *, NOT regexp_matches(text, '[^\x20\x09-\x0D]') AS blank,
                   NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') AS open_end,
                   lag(initial) OVER (PARTITION BY conv_id ORDER BY i) || initial AS step,
                   row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) AS seen
            FROM placed
        ), faults AS (
            SELECT *, NOT blank AND seen > 1 AS duplicate, NOT blank AND seen = 1 AND open_end AS truncated FROM judged
        ), sums AS (
            SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
                   sum(CAST(blank AS INT)) AS blank, sum(CAST(duplicate AS INT)) AS duplicate,
                   sum(CAST(truncated AS INT)) AS truncated,
                   sum(CASE WHEN step NOT IN ('su', 'ua', 'au') THEN 1 ELSE 0 END) AS illegal, max(i) AS n
            FROM faults GROUP BY conv_id
        ), walk AS (  -- per row the best way to each state: cost, audit, lines
            SELECT conv_id, CAST(0 AS BIGINT) AS i,
                   {'c': CAST(0 AS BIGINT), 'a': '', 't': CAST([] AS VARCHAR[])} AS w0,
                   {'c': CAST(1e15 AS BIGINT), 'a': '', 't': CAST([] AS VARCHAR[])} AS ws,
                   {'c': CAST(1e15 AS BIGINT), 'a': '', 't': CAST([] AS VARCHAR[])} AS wu,
                   {'c': CAST(1e15 AS BIGINT), 'a': '', 't': CAST([] AS VARCHAR[])} AS wa
            FROM (SELECT DISTINCT conv_id FROM faults)
            UNION ALL
            SELECT conv_id, i,
                   {'c': w0.c + 4, 'a': w0.a || 'D', 't': w0.t} AS w0,
                   list_min([{'c': ws.c + 4, 'a': ws.a || 'D', 't': ws.t},
                             {'c': w0.c + keep + CASE WHEN initial = 's' THEN 0 ELSE 1e15::BIGINT END, 'a': w0.a || 'K', 't': w0.t || [line]}]) AS ws,
                   list_min([{'c': iu.c + 4, 'a': iu.a || 'D', 't': iu.t}]
                            || flatten([[{'c': x.c + keep + CASE WHEN initial = 'u' THEN 0 ELSE 1e15::BIGINT END, 'a': x.a || 'K', 't': x.t || [line]},
                                         {'c': x.c + keep + 3, 'a': x.a || 'R', 't': x.t || ['user:' || text]}] FOR x IN [w0, ws, ia]])) AS wu,
                   list_min([{'c': ia.c + 4, 'a': ia.a || 'D', 't': ia.t},
                             {'c': iu.c + keep + CASE WHEN initial = 'a' THEN 0 ELSE 1e15::BIGINT END, 'a': iu.a || 'K', 't': iu.t || [line]},
                             {'c': iu.c + keep + 3, 'a': iu.a || 'R', 't': iu.t || ['assistant:' || text]}]) AS wa
            FROM (
                SELECT w.conv_id, f.i, f.initial, f.text, f.role || ':' || f.text AS line, w0, ws,
                       CASE WHEN blank OR duplicate THEN 1e15::BIGINT WHEN truncated THEN 3 ELSE 0 END AS keep,
                       list_min([wu] || [{'c': x.c + 3, 'a': x.a || 'I', 't': x.t || ['user:']} FOR x IN [w0, ws, wa]]) AS iu,
                       list_min([wa, {'c': wu.c + 3, 'a': wu.a || 'I', 't': wu.t || ['assistant:']}]
                                || [{'c': x.c + 6, 'a': x.a || 'II', 't': x.t || ['user:', 'assistant:']} FOR x IN [w0, ws]]) AS ia
                FROM walk w JOIN faults f ON f.conv_id IS NOT DISTINCT FROM w.conv_id AND f.i = w.i + 1
            )
        ), ended AS (
            SELECT s.*, list_min([w0, wa, {'c': wu.c + 3, 'a': wu.a || 'I', 't': wu.t || ['assistant:']},
                                  {'c': ws.c + 6, 'a': ws.a || 'II', 't': ws.t || ['user:', 'assistant:']}]) AS best
            FROM walk w JOIN sums s ON s.conv_id IS NOT DISTINCT FROM w.conv_id AND s.n = w.i
        )
        SELECT g.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, CAST(coalesce(blank, 0) AS BIGINT) AS blank,
               CAST(coalesce(duplicate, 0) AS BIGINT) AS duplicate, CAST(coalesce(truncated, 0) AS BIGINT) AS truncated,
               CAST(coalesce(illegal, 0) AS BIGINT) AS illegal, CAST(coalesce(best.c, 0) AS BIGINT) AS cost,
               coalesce(best.a, '') AS audit, sha256(coalesce(array_to_string(best.t, chr(10)), '')) AS repaired_sha256
        FROM (SELECT DISTINCT conv_id FROM conversations) g LEFT JOIN ended e ON e.conv_id IS NOT DISTINCT FROM g.conv_id
    """,
}
