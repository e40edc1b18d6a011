"""Helpers that the operators share: tables, the shared folder, row keys, bounded samples."""

from __future__ import annotations

import gc
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

TOKENIZER = "byte_bpe_50k.json"
_OTHER_UPPER = r"[\p{IsUppercase}\p{Lt}\p{Cn}&&[^A-Z]]"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def tokenizer_path(name: str = TOKENIZER) -> str:
    """Place of a public tokenizer file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def workspace(spark: SparkSession) -> str:
    """A new folder inside the one that the whole cluster shares (``spark.checkpoint.dir``).

    Where that setting is absent, a local session gets a folder of its own; a cluster must name one.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if base is None:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the cluster shares")
        import tempfile

        base = tempfile.mkdtemp(prefix="shared-")
        spark.sparkContext.setCheckpointDir(base)
        base = spark.sparkContext.getCheckpointDir()
    return f"{base.rstrip('/')}/{uuid.uuid4().hex}"


def saved(df: DataFrame) -> DataFrame:
    """The frame written to the shared folder and read from there.

    Jobs that use it afterwards do not compute it again, also when executors are lost.
    """
    path = workspace(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def free_shuffles(spark: SparkSession) -> None:
    """Lets Spark delete the shuffle files of jobs that are done.

    It does so when the driver's garbage, in which their plans are, is collected; by itself that can take very long, and the
    files of all steps would lie on the executors' disks together.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def ascii_lower(text: Column) -> Column:
    """A-Z become a-z; other letters stay."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def folded(text: Column) -> Column:
    """A-Z as a-z. The built-in lower case does the same, at less cost, where no other sign has a lower case (or is unknown)."""
    plain = (F.octet_length(text) == F.length(text)) | ~text.rlike(_OTHER_UPPER)
    return F.when(plain, F.lower(text)).otherwise(ascii_lower(text))


def smallest(df: DataFrame, order: list[Column], limit: int) -> DataFrame:
    """A bounded, repeatable sample: the first rows by the given order."""
    return df.orderBy(*order).limit(limit)


def sample_per_class(rows: DataFrame, id: str, label: str, each: int) -> DataFrame:
    """At most ``each`` rows (id, label) of every label: those whose ids have the smallest hashes.

    The count of a label sets a bound on the hash that about three times ``each`` rows pass, so ranking sees few rows.
    """
    order = F.xxhash64(id)
    counts = rows.filter(F.col(label).isNotNull()).groupBy(label).count().collect()
    near = F.lit(False)
    for r in counts:
        bound = int(-(1 << 63) + (1 << 64) * min(1.0, (3 * each + 50) / r["count"])) - 1
        near = near | ((F.col(label) == r[label]) & (order <= F.lit(bound)))
    rank = F.row_number().over(Window.partitionBy(label).orderBy(order, id))
    return (
        rows.select(id, label)
        .filter(near)
        .withColumn("_rank", rank)
        .filter(F.col("_rank") <= each)
        .drop("_rank")
    )


def remainder(id: str, divisor: int) -> Column:
    """crc32 of the id as text, modulo the divisor; NULL ids have none."""
    return F.crc32(F.col(id).cast("string").cast("binary")) % divisor


#: Keys of documents are broadcast up to this number (16 bytes each); beyond it they are joined by a shuffle.
BROADCAST_KEYS = 1_000_000
_NULL_ID = -(1 << 63)


def key_columns(id: str, text: str) -> list[Column]:
    """What tells rows apart whose results may differ: the id, and a hash of the text."""
    return [
        F.coalesce(F.col(id).cast("long"), F.lit(_NULL_ID)).alias("_id"),
        F.xxhash64(F.col(text).cast("string")).alias("_hash"),
    ]


def keyed_rows(docs: DataFrame, id: str, text: str) -> DataFrame:
    """All columns as the struct ``row``, beside the key; so names of the input never clash with others."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    return docs.select(row, *key_columns(id, text))


def bounded(keys: DataFrame) -> DataFrame:
    """The keys, marked for broadcasting if their counted number is small."""
    return F.broadcast(keys) if keys.count() <= BROADCAST_KEYS else keys


def without(docs: DataFrame, keys: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows whose key is not among ``keys`` (columns id and text_hash)."""
    keys = saved(keys.select(F.coalesce("id", F.lit(_NULL_ID)).alias("_id"), F.col("text_hash").alias("_hash")).distinct())
    return keyed_rows(docs, id, text).join(bounded(keys), ["_id", "_hash"], "left_anti").select("row.*")
