"""Benchmark decontamination: windows of words that documents share with benchmark items.

Texts are lower-cased in A-Z; a word is a run of digits, a-z and characters beyond ASCII. A window is ``WINDOW``
consecutive words of an item; an item of fewer words, but not none, is one window. A document's word is hit if it stands in
an occurrence of any window.

The distinct windows are normalised and hashed, and broadcast as a hash set if they are few enough, under their longest
word. The documents' words are probed against it where the texts are; the window around a match is hashed, compared, and
verified word by word. Only hits and one narrow row for each
document are shuffled. All of it are DataFrame functions.

NULL and empty texts have no words and no hits. Rows that agree in id and text share their hits; each gives a row. Items
that share a window are all found; an item's id may be on several rows; items whose id is NULL hit words but are not
listed. Empty tables give no hits or no rows. Columns other than ids and texts are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import folded, saved, text_or_empty

WINDOW = 13
#: Windows are broadcast up to this number (about 200 bytes each); beyond it they are joined by shuffling.
BROADCAST_WINDOWS = 500_000
_APART = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    return F.array_remove(F.split(folded(text), _APART), "")


def hits(
    docs: DataFrame,
    items: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    broadcast_windows: int = BROADCAST_WINDOWS,
) -> tuple[DataFrame, DataFrame]:
    """Places of hits in documents, and items of windows.

    The first has doc_id, text_hash (xxhash64 of the text), at (a word's number from 0), n and digest of every occurrence
    of a window; the second digest, n and item_id.
    """
    spans = (
        items.select(F.col(item_id).alias("item_id"), words(text_or_empty(item_text)).alias("w"))
        .withColumn("n", F.least(F.lit(window), F.size("w")))
        .filter("n > 0")
        .select(
            "item_id",
            "n",
            F.explode(
                F.transform(
                    F.sequence(F.lit(1), F.size("w") - F.col("n") + 1),
                    lambda i: F.slice("w", i, F.col("n")),
                )
            ).alias("span"),
        )
        .select("item_id", "n", "span", F.xxhash64("span").alias("digest"))
        .distinct()
    )
    # Each window is looked for at its longest word, the first of those; that word is rarer than most.
    longest = F.aggregate("span", F.lit(""), lambda m, w: F.when(F.length(w) > F.length(m), w).otherwise(m))
    windows = (
        spans.select("n", "digest", "span")
        .distinct()
        .withColumn("pivot", longest)
        .select("n", "digest", "span", F.xxhash64("pivot").alias("pivot"), (F.array_position("span", F.col("pivot")) - 1).cast("int").alias("offset"))
    )
    docs = docs.select(
        F.col(id).alias("doc_id"),
        F.xxhash64(F.col(text).cast("string")).alias("text_hash"),
        words(text_or_empty(text)).alias("w"),
    )
    at = F.col("place") - F.col("offset")
    same = F.slice("w", at + 1, F.col("n"))
    fits = (at >= 0) & (at + F.col("n") <= F.size("w"))
    hit = F.when(fits, (F.xxhash64(same) == F.col("digest")) & (same == F.col("span")))
    key = ["doc_id", "text_hash"]
    if windows.count() <= broadcast_windows:
        found = (
            docs.select(*key, "w", F.posexplode("w").alias("place", "word"))
            .join(F.broadcast(windows), F.xxhash64("word") == F.col("pivot"))
            .filter(hit)
        )
    else:  # only places are shuffled to the windows, then texts to the places
        places = docs.select(*key, F.posexplode("w").alias("place", "word")).select(*key, "place", F.xxhash64("word").alias("pivot"))
        near = places.join(windows, "pivot").withColumnsRenamed({"doc_id": "of", "text_hash": "hash"})
        found = docs.join(
            near, F.col("doc_id").eqNullSafe(F.col("of")) & (F.col("text_hash") == F.col("hash"))
        ).filter(hit)
    found = found.select(*key, at.alias("at"), "n", "digest")
    return found, spans.select("digest", "n", "item_id", "span")


def report(
    docs: DataFrame,
    items: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    **options,
) -> DataFrame:
    """doc_id, text_hash, n_words, n_hit, and ``items`` (sorted ids as strings) of every document."""
    found, of_items = hits(docs, items, id, text, item_id, item_text, **options)
    found = saved(found.distinct())
    key = ["doc_id", "text_hash"]
    # How far a hit reaches beyond all hits that start before it; windows hold one document's hits.
    earlier = Window.partitionBy(*key).orderBy("at", "n").rowsBetween(Window.unboundedPreceding, -1)
    end = F.col("at") + F.col("n")
    reached = F.greatest(F.col("at"), F.coalesce(F.max(end).over(earlier), F.col("at")))
    covered = (
        found.select(*key, "at", F.greatest(end - reached, F.lit(0)).alias("fresh"))
        .groupBy(*key)
        .agg(F.sum("fresh").alias("n_hit"))
    )
    named = (
        found.select(*key, "digest", "n")
        .distinct()
        .join(of_items.select("digest", "n", F.col("item_id").cast("string").alias("item")), ["digest", "n"])
        .groupBy(*key)
        .agg(F.array_sort(F.collect_set("item")).alias("items"))
    )
    marks = covered.join(
        named.withColumnsRenamed({"doc_id": "of", "text_hash": "hash"}),
        F.col("doc_id").eqNullSafe(F.col("of")) & F.col("text_hash").eqNullSafe(F.col("hash")),
        "left",
    ).select(F.col("doc_id").alias("of"), F.col("text_hash").alias("hash"), "n_hit", "items")
    return (
        docs.select(
            F.col(id).alias("doc_id"),
            F.xxhash64(F.col(text).cast("string")).alias("text_hash"),
            F.size(words(text_or_empty(text))).cast("long").alias("n_words"),
        )
        .join(
            marks,
            F.col("doc_id").eqNullSafe(F.col("of")) & F.col("text_hash").eqNullSafe(F.col("hash")),
            "left",
        )
        .select(
            "doc_id",
            "text_hash",
            "n_words",
            F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
            F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        )
    )


def contaminated(least_share: int = 20) -> Column:
    """At least one word in ``least_share`` is hit."""
    return (F.col("n_hit") > 0) & (F.col("n_hit") * least_share >= F.col("n_words"))
