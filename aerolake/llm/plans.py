"""Queries of the text and survivorship operators over the driver's tables, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from aerolake.llm import consensus, encoding, leakage, truncation
from aerolake.session import table


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return consensus.surviving_entries(table(spark, d, "level1_rows"), table(spark, d, "origins"))


def p2_conflicts(spark: SparkSession, d: str) -> DataFrame:
    return consensus.conflicting_columns(table(spark, d, "level1_rows"), table(spark, d, "origins"))


def p2_votes(spark: SparkSession, d: str) -> DataFrame:
    return consensus.consensus_entries(table(spark, d, "level1_rows"), table(spark, d, "origins"))


def p8_ids(spark: SparkSession, d: str) -> DataFrame:
    return encoding.encode_documents(table(spark, d, "documents"))


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    return leakage.leaked(table(spark, d, "documents"), table(spark, d, "eval_items"))


def p9_covered(spark: SparkSession, d: str) -> DataFrame:
    return leakage.covered(table(spark, d, "documents"), table(spark, d, "eval_items"))


def p10_found(spark: SparkSession, d: str) -> DataFrame:
    return truncation.truncated(table(spark, d, "documents"))


def p10_rates(spark: SparkSession, d: str) -> DataFrame:
    return truncation.truncation_rates(table(spark, d, "documents"))


QUERIES = {f.__name__: f for f in (p2_found, p2_conflicts, p2_votes, p8_ids, p9_found, p9_covered, p10_found, p10_rates)}

_GROUPS = r"""
    WITH rows AS (
        SELECT regexp_replace(lower(source), '[^\p{L}\p{N}]', '', 'g') AS g, date_trunc('second', "timestamp") AS s, row_id, l.origin,
               coalesce(trust_rank, 2147483647) AS trust, received_at,
               CASE WHEN value IS NOT NULL AND NOT isnan(value) AND NOT regexp_matches(abs(value)::DECIMAL(38, 6)::VARCHAR, '^9{3,}[.]9*0*$') THEN value::VARCHAR END AS v1,
               CASE WHEN aux IS NOT NULL AND NOT isnan(aux) AND NOT regexp_matches(abs(aux)::DECIMAL(38, 6)::VARCHAR, '^9{3,}[.]9*0*$') THEN aux::VARCHAR END AS v2,
               CASE WHEN NOT regexp_matches(abs(flag)::VARCHAR, '^9{3,}$') THEN flag::VARCHAR END AS v3,
               CASE WHEN lower(regexp_replace(note, '^\s+|\s+$', '', 'g')) NOT IN ('', '-', '--', '?', '.', 'none', 'null', 'nan', 'na', 'n/a', 'n.a.', 'nil', 'missing', 'unknown') THEN note END AS v4
        FROM level1_rows l LEFT JOIN origins o ON l.origin = o.origin WHERE "timestamp" IS NOT NULL AND source IS NOT NULL),
    cells AS (
        SELECT g, s, row_id, trust, received_at, unnest(['value', 'aux', 'flag', 'note']) AS column_name, unnest([v1, v2, v3, v4]) AS entry FROM rows)
"""

SQL = {
    "p2_found": _GROUPS
    + """
    SELECT min(row_id) AS group_row_id, column_name,
           first(row_id ORDER BY trust, received_at DESC NULLS LAST, row_id DESC) FILTER (WHERE entry IS NOT NULL) AS keep_row_id
    FROM cells GROUP BY g, s, column_name
    HAVING count(*) > 1 AND count(entry) > 0 AND (count(DISTINCT entry) > 1 OR count(entry) < count(*))
    """,
    "p2_conflicts": _GROUPS
    + """
    , named AS (
        SELECT g, s, column_name, count(DISTINCT entry) > 1 AS conflict, min(row_id) AS first_id FROM cells GROUP BY g, s, column_name HAVING count(*) > 1)
    SELECT min(first_id) AS group_row_id,
           string_agg(column_name, ',' ORDER BY list_position(['value', 'aux', 'flag', 'note'], column_name)) AS conflicting_columns
    FROM named WHERE conflict GROUP BY g, s
    """,
    "p9_found": r"""
    WITH d AS (SELECT doc_id, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') AS w FROM documents WHERE text IS NOT NULL),
    i AS (SELECT item_id, regexp_extract_all(lower(passage), '[\p{L}\p{N}]+') AS w FROM eval_items WHERE passage IS NOT NULL),
    dw AS (SELECT doc_id, array_to_string(w[n:n + 12], ' ') AS t FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS n FROM d WHERE len(w) >= 13)),
    iw AS (SELECT DISTINCT item_id, array_to_string(w[n:n + 12], ' ') AS t FROM (SELECT item_id, w, unnest(range(1, len(w) - 11)) AS n FROM i WHERE len(w) >= 13))
    SELECT DISTINCT doc_id, item_id FROM dw JOIN iw USING (t)
    """,
}
