"""Queries of the token operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, token_files
from .common import table, tokenizer_path, workspace

END_ID = 2


def _spec() -> str:
    with open(tokenizer_path(), encoding="utf-8") as f:
        return f.read()


def encoding_digests(docs: DataFrame) -> DataFrame:
    return bpe.encode(docs, _spec(), decoded=True).select(
        "doc_id",
        (F.length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op1_bpe_encoding(spark: SparkSession, folder: str) -> DataFrame:
    return encoding_digests(table(spark, folder, "documents"))


def op6_token_files(spark: SparkSession, folder: str) -> DataFrame:
    target = workspace(spark)
    token_files.write(table(spark, folder, "documents"), target, _spec(), END_ID)
    return token_files.read(spark, target).select(
        "doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32")
    )
