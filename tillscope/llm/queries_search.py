"""Query of the ranked lexical search."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import lexical
from .common import table

BEST = 10


def op11_lexical_search(spark: SparkSession, folder: str) -> DataFrame:
    return lexical.search(table(spark, folder, "documents"), table(spark, folder, "benchmark"), BEST)


OP11_SQL = r"""
    WITH doc_words AS (
        SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w
        FROM documents
    ), asked AS (
        SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
        FROM benchmark
    ), totals AS (
        SELECT count(*) AS n_docs, CAST(sum(len(w)) AS BIGINT) AS n_terms FROM doc_words WHERE len(w) > 0
    ), lengths AS (
        SELECT doc_id, 10 + (90 * CAST(len(w) AS BIGINT) * n_docs) // n_terms AS m FROM doc_words, totals WHERE len(w) > 0
    ), occurring AS (
        SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(w) AS term FROM doc_words)
        WHERE term IN (SELECT term FROM asked) GROUP BY doc_id, term
    ), weights AS (
        SELECT term, CAST(floor(1000 * ln((2 * n_docs + 2) / (2 * df + 1))) AS BIGINT) AS weight
        FROM (SELECT term, count(*) AS df FROM occurring GROUP BY term), totals
    ), scores AS (
        SELECT item_id, doc_id, CAST(sum(weight * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
        FROM occurring JOIN lengths USING (doc_id) JOIN weights USING (term) JOIN asked USING (term) GROUP BY item_id, doc_id
    )
    SELECT item_id, CAST(place AS INTEGER) AS rank, doc_id, score
    FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS place FROM scores WHERE score > 0)
    WHERE place <= 10
"""
