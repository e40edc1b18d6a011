"""A corpus pipeline of the training-data operators, from ``documents`` to token digests.

Documents that the quality classifier rejects go; lines that repeat earlier ones go; one document of each SimHash group
stays; documents contaminated by benchmark items go; the rest is encoded.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillscope.llm import (
    common,
    decontaminate,
    line_dedup,
    queries_duplicates,
    queries_models,
    queries_tokens,
    simhash,
)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    scored = queries_models.quality_scored(docs, docs, common.table(spark, sf_dir, "labels"))
    return scored.filter("score >= 0.5").select("row.*")


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents keep their rows; ``n_chars`` follows the text."""
    changed = {"text": F.col("new_text"), "n_chars": F.length("new_text").cast("long")}
    return line_dedup.cleaned(docs).select(
        *[changed.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns]
    )


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    marked = simhash.fingerprints(docs, shingle=queries_duplicates.SHINGLE_WORDS)
    return simhash.survivors(docs, simhash.groups(marked, queries_duplicates.DIFFERING_BITS))


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = decontaminate.report(docs, common.table(spark, sf_dir, "benchmark"))
    bad = found.filter(decontaminate.contaminated())
    return common.without(docs, bad.select(F.col("doc_id").alias("id"), "text_hash"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return queries_tokens.encoding_digests(docs)


STAGES = [
    ("quality classifier", quality),
    ("line dedup", lines),
    ("SimHash near-dedup", near_duplicates),
    ("benchmark decontamination", benchmark),
    ("BPE encoding and decoding", encode),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result but the last is written to the shared folder and read again."""
    docs = common.table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = common.saved(docs)
    return docs
