"""Query of the conversations' prefix trie."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import prefix_trie
from .common import table


def op13_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    return prefix_trie.trie(table(spark, folder, "conversations"))


# crc32 of the decimal id, bit by bit; then nodes are groups of equal lists of turns.
OP13_SQL = r"""
    WITH own AS (
        SELECT conv_id AS c, struct_pack(r := coalesce(role, ''), t := coalesce(text, '')) AS x,
               row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS k
        FROM conversations WHERE conv_id IS NOT NULL
    ), convs AS (
        SELECT c, list(x ORDER BY k) AS turns,
               xor(list_reduce(list_prepend(4294967295, list_transform(string_split(CAST(c AS VARCHAR), ''), lambda s: CAST(ord(s) AS BIGINT))),
                   lambda a, b: list_reduce(list_prepend(xor(a, b), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]), lambda v, z: xor(v >> 1, (v & 1) * 3988292384))), 4294967295) % 6 AS h
        FROM own GROUP BY c
    ), built AS (
        SELECT a.c, list_concat(coalesce(b.turns[1:a.h], []), a.turns[a.h + 1:]) AS s FROM convs a LEFT JOIN convs b ON b.c = a.c - a.c % 100
    ), entries AS (
        SELECT c, d, s[1:d] AS p, len(s) = d AS ends FROM (SELECT c, s, unnest(range(0, len(s) + 1)) AS d FROM built)
    ), nodes AS (
        SELECT d, p, min(c) AS conv_id, count(*) AS n_convs,
               sha256(coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (WHERE ends), '')) AS ends_sha256
        FROM entries GROUP BY d, p
    ), children AS (
        SELECT d - 1 AS d, p[1:d - 1] AS p, count(*) AS n_children FROM nodes WHERE d > 0 GROUP BY ALL
    ), own_sums AS (
        SELECT n.d, n.p, CASE WHEN n_children IS NULL THEN 1 ELSE 0 END AS leaf,
               CASE WHEN n.d > 0 THEN (n_convs - 1) * length(n.p[n.d].t) ELSE 0 END AS saving
        FROM nodes n LEFT JOIN children k ON k.d = n.d AND k.p = n.p
    ), sums AS (
        SELECT up AS d, p[1:up] AS p, sum(leaf) AS n_leaves, sum(saving) AS saved_tokens
        FROM (SELECT d, p, leaf, saving, unnest(range(0, d + 1)) AS up FROM own_sums) GROUP BY ALL
    )
    SELECT n.conv_id, n.d AS depth, u.conv_id AS parent_conv_id, n.n_convs, CAST(coalesce(n_children, 0) AS BIGINT) AS n_children,
           CAST(n_leaves AS BIGINT) AS n_leaves, CAST(saved_tokens AS BIGINT) AS saved_tokens, n.ends_sha256
    FROM nodes n JOIN sums s ON s.d = n.d AND s.p = n.p LEFT JOIN children k ON k.d = n.d AND k.p = n.p
         LEFT JOIN nodes u ON u.d = n.d - 1 AND u.p = n.p[1:n.d - 1]
"""
