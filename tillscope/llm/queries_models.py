"""Queries of the classifiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import string_kernel, subwords
from .common import remainder, table


def _held_out(divisor: int, rest: int, id: str = "doc_id") -> Column:
    return F.coalesce(remainder(id, divisor) == rest, F.lit(False))


def quality_scored(docs: DataFrame, rows: DataFrame, labels: DataFrame) -> DataFrame:
    """``rows`` as the struct ``row`` with score; learned from ``docs`` with labels outside the held-out third."""
    usable = labels.filter((remainder("doc_id", 3) != 1) & F.col("quality").isin(0, 1))
    model = subwords.train(docs, usable, label="quality")
    if not model.classes:
        score = F.lit(0.5)
    else:
        score = F.col("probabilities")[model.classes.index(1)] if 1 in model.classes else F.lit(0.0)
    return subwords.score(rows, model).select("row", score.cast("double").alias("score"))


def quality_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted of every document."""
    return quality_scored(docs, docs.select("doc_id", "text"), labels).select(
        "row.doc_id",
        _held_out(3, 1, "row.doc_id").alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def op9_quality(spark: SparkSession, folder: str) -> DataFrame:
    return quality_scores(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op10_language(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    model = string_kernel.train(docs.filter(remainder("doc_id", 4) != 2))
    return string_kernel.predict(docs, model).select(
        F.col("id").alias("doc_id"), "lang_pred", "score"
    ).select("doc_id", _held_out(4, 2).alias("held_out"), "lang_pred", "score")
