"""Queries of the near-duplicate operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import line_dedup, simhash, weighted_samples
from .common import table

SHINGLE_WORDS = 3
DIFFERING_BITS = 3


def op7_simhash(spark: SparkSession, folder: str) -> DataFrame:
    marked = simhash.fingerprints(table(spark, folder, "documents"), shingle=SHINGLE_WORDS)
    return simhash.groups(marked, DIFFERING_BITS).select(
        F.col("id").alias("doc_id"),
        F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"),
        "component_id",
    )


def op8_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return line_dedup.cleaned(table(spark, folder, "documents")).select(
        "row.doc_id", "n_lines", "n_removed", F.sha2("new_text", 256).alias("text_sha256")
    )


def op12_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    found = weighted_samples.compared(table(spark, folder, "documents"))
    return found.select(
        F.col("id").alias("doc_id"),
        "n_chars",
        "edited_sha256",
        weighted_samples.written("samples").alias("fingerprint"),
        weighted_samples.written("edited_samples").alias("edited_fingerprint"),
        "near_edited",
        "near_next",
    )


OP8_SQL = r"""
    WITH lines AS (
        SELECT doc_id, text, generate_subscripts(own, 1) - 1 AS line, unnest(own) AS own
        FROM (SELECT doc_id, text, string_split(text, chr(10)) AS own FROM documents WHERE text IS NOT NULL)
    ), sets AS (
        SELECT doc_id, line, own, list_sort(list_distinct(list_filter(string_split(translate(own, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ' || chr(9) || chr(11) || chr(12) || chr(13), 'abcdefghijklmnopqrstuvwxyz    '), ' '), lambda w: w <> ''))) AS w
        FROM lines
    ), places AS (
        SELECT row_number() OVER (ORDER BY doc_id, line) AS place, * FROM sets WHERE len(w) >= 1
    ), words AS (
        SELECT place, len(w) AS n, unnest(w) AS word FROM places
    ), rare AS (
        SELECT place, n, word, row_number() OVER (PARTITION BY place ORDER BY f, word) AS spot
        FROM words JOIN (SELECT word, count(*) AS f FROM words GROUP BY word) USING (word)
    ), prefixes AS (
        SELECT * FROM rare WHERE spot <= n - (4 * n + 4) // 5 + 1
    ), candidates AS (
        SELECT DISTINCT a.place AS a, b.place AS b FROM prefixes a JOIN prefixes b ON a.word = b.word AND a.place < b.place
    ), removed AS (
        SELECT DISTINCT q.doc_id, q.line FROM candidates JOIN places p ON p.place = a JOIN places q ON q.place = b
        WHERE 9 * len(list_intersect(p.w, q.w)) >= 4 * (len(p.w) + len(q.w))
    )
    SELECT d.doc_id, CAST(coalesce(n_lines, 0) AS BIGINT) AS n_lines, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
           sha256(CASE WHEN d.text IS NOT NULL THEN coalesce(kept, '') END) AS text_sha256
    FROM documents d LEFT JOIN (
        SELECT l.doc_id, count(*) AS n_lines, count(r.line) AS n_removed,
               string_agg(own, chr(10) ORDER BY l.line) FILTER (WHERE r.line IS NULL) AS kept
        FROM lines l LEFT JOIN removed r ON l.doc_id = r.doc_id AND l.line = r.line GROUP BY l.doc_id
    ) t ON d.doc_id = t.doc_id
"""
