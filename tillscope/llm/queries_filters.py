"""Queries of the filters: benchmark decontamination, secrets."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontaminate, secrets
from .common import saved, table


def op3_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.report(table(spark, folder, "documents"), table(spark, folder, "benchmark")).select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        decontaminate.contaminated().alias("contaminated"),
    )


OP3_SQL = r"""
    WITH item_words AS (
        SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
        FROM benchmark
    ), item_lengths AS (
        SELECT item_id, w, least(13, len(w)) AS n FROM item_words WHERE len(w) > 0
    ), item_places AS (
        SELECT item_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM item_lengths
    ), spans AS (
        SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS span FROM item_places
    ), doc_words AS (
        SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
        FROM documents
    ), doc_places AS (
        SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i
        FROM doc_words, (SELECT DISTINCT n FROM spans) WHERE len(w) >= n
    ), hits AS (
        SELECT doc_id, i, p.n, item_id
        FROM (SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS span FROM doc_places) p
        JOIN spans ON p.n = spans.n AND p.span = spans.span
    ), covered AS (
        SELECT doc_id, count(DISTINCT place) AS n_hit
        FROM (SELECT doc_id, unnest(range(i, i + n)) AS place FROM (SELECT DISTINCT doc_id, i, n FROM hits)) GROUP BY doc_id
    ), named AS (
        SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
        FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id
    )
    SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
           CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
           coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
    FROM doc_words d LEFT JOIN covered c ON d.doc_id = c.doc_id LEFT JOIN named m ON d.doc_id = m.doc_id
"""


def op4_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Every candidate of every document with its judgement; values leave as digests."""
    docs = table(spark, folder, "documents")
    known = secrets.dictionary(docs)
    model = secrets.train(secrets.planted_findings(saved(secrets.planted(docs)), known))
    return secrets.judge(secrets.features(secrets.candidates(docs), known), model).select(
        F.col("id").alias("doc_id"),
        "place",
        "at",
        F.length("value").alias("n_chars"),
        F.sha2("value", 256).alias("value_sha256"),
        F.round("probability", 6).alias("probability"),
        "is_secret",
    )
