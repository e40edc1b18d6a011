"""Fingerprints of documents by consistent weighted sampling.

A document is the multiset of its words (parted by ASCII white space); a word's weight w is how often it occurs. For each
sample a word has r and c from the gamma distribution of shape two, and b uniform, all made from a hash of the word, 16 bits
at a time: r from two uniform numbers, c by its quantile, both looked up in tables, so that no row needs a logarithm. With
t = floor(ln w / r + b) its value is ln c - r (t - b + 1); the word of least value, with its t, is the sample. Two documents
agree in a sample with the probability of their generalised Jaccard similarity: the sum of the lesser weights by that of the
greater ones. A sample keeps 24 bits that name word and t; the share of samples that agree estimates the similarity.

Everything runs on DataFrame functions: words are counted inside each text by sorting their hashes, values are rows' columns,
and the least ones are found by an aggregation that combines before the shuffle. A value holds its 24 bits below, so that the
least one brings them along.

Equal texts have equal fingerprints. Texts without words have none (an empty string); they are like each other, and unlike
any other. NULL texts are empty. Rows that agree in id and text are one document, and each gives the same row; rows that
share an id alone follow one another by a hash of the text. NULL ids come first. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import bounded, free_shuffles, saved

SAMPLES = 64
_GROUP = 8  # samples that one row computes
_LEVELS = 1 << 16
_NULL_ID = -(1 << 63)
_KEY = ["id", "hash"]


def keyed(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """id (NULL as the least number), hash of the text, and text."""
    held = F.coalesce(F.col(text).cast("string"), F.lit(""))
    return docs.select(F.coalesce(F.col(id).cast("long"), F.lit(_NULL_ID)).alias("id"), F.xxhash64(held).alias("hash"), held.alias("text"))


def samples(rows: DataFrame, key: list[str], text: str = "text", n: int = SAMPLES) -> DataFrame:
    """The columns of ``key`` and ``samples``, an array of n numbers, NULL for texts without words; one row for each key."""
    hashes = F.sort_array(F.transform(F.array_remove(F.split(text, "[ \t\n\r\x0b\f]+"), ""), lambda w: F.xxhash64(w)))
    differs = lambda i: F.coalesce(F.get("h", i) != F.get("h", i - 1), F.lit(True))
    ends = F.when(F.size("h") > 0, F.filter(F.sequence(F.lit(1), F.size("h")), differs))
    weight = F.col("end") - F.when(F.col("at") > 0, F.get("ends", F.col("at") - 1)).otherwise(0)
    tables = _tables(rows.sparkSession)
    words = (
        rows.select(*key, hashes.alias("h"))
        .select(*key, "h", ends.alias("ends"))
        .select(*key, "h", "ends", F.posexplode_outer("ends").alias("at", "end"))
        .select(*key, F.get("h", F.col("end") - 1).alias("word"), F.ln(weight.cast("double")).alias("ln_w"))
        .select("*", F.explode(F.array(*[F.lit(g) for g in range(0, n, _GROUP)])).alias("first"))
        .withColumns({c: tables.select(c).scalar() for c in ("u", "c")})
    )
    least = words.groupBy(*key, "first").agg(*[F.min(_value(k)).alias(f"v{k}") for k in range(_GROUP)])
    bits = F.when(F.col("v0").isNotNull(), F.array(*[F.col(f"v{k}").bitwiseAND(F.lit(0xFFFFFF)).cast("int") for k in range(_GROUP)]))
    parts = least.groupBy(*key).agg(F.collect_list(F.when(F.col("v0").isNotNull(), F.struct("first", bits.alias("bits")))).alias("p"))
    return parts.select(*key, F.when(F.size("p") > 0, F.flatten(F.transform(F.array_sort("p"), lambda x: x["bits"]))).alias("samples"))


def likeness(a: str | Column, b: str | Column) -> Column:
    """The share of samples that agree."""
    a, b = (F.col(x) if isinstance(x, str) else x for x in (a, b))
    same = F.size(F.filter(F.zip_with(a, b, lambda x, y: x == y), lambda x: x)) / F.size(a)
    return F.when(a.isNull() & b.isNull(), 1.0).when(a.isNull() | b.isNull(), 0.0).otherwise(same)


def written(found: str) -> Column:
    """Six hexadecimal digits for each sample."""
    return F.coalesce(F.array_join(F.transform(found, lambda x: F.lower(F.lpad(F.hex(x), 6, "0"))), ""), F.lit(""))


def successors(docs: DataFrame) -> DataFrame:
    """id, hash, n_chars, copies, next_id and next_hash of every document, in the order of ids; the first follows the last.

    ``docs`` comes from ``keyed``. Ranges of sorted ids are linked apart, and then to the first id of the next range.
    """
    ids = docs.groupBy(*_KEY, F.length("text").cast("long").alias("n_chars")).agg(F.count(F.lit(1)).alias("copies"))
    ranged = saved(ids.repartitionByRange("id", "hash").withColumn("part", F.spark_partition_id()))
    firsts = [r.first for r in ranged.groupBy("part").agg(F.min(F.struct("id", "hash")).alias("first")).orderBy("part").collect()]  # a row for each range
    parts = [r.part for r in ranged.select("part").distinct().orderBy("part").collect()]
    after = docs.sparkSession.createDataFrame(
        [(p, *firsts[(k + 1) % len(firsts)]) for k, p in enumerate(parts)], "part int, first_id long, first_hash long"
    )
    follows = F.lead(F.struct("id", "hash")).over(Window.partitionBy("part").orderBy("id", "hash"))
    return (
        ranged.withColumn("next", follows)
        .join(F.broadcast(after), "part")
        .select(*_KEY, "n_chars", "copies", F.coalesce("next.id", "first_id").alias("next_id"), F.coalesce("next.hash", "first_hash").alias("next_hash"))
    )


def edited(docs: DataFrame, linked: DataFrame) -> DataFrame:
    """id, hash and text of every document whose last half has given way to the beginning of the next document.

    Only halves move: what stays of a text, and what its forerunner takes of it.
    """
    half = F.floor(F.col("n_chars") / 2)
    stays = docs.select(*_KEY, F.substr("text", F.lit(1), (F.length("text") - F.floor(F.length("text") / 2)).cast("int")).alias("head"))
    wanted = linked.select(F.col("next_id").alias("id"), F.col("next_hash").alias("hash"), F.struct(F.col("id"), F.col("hash")).alias("of"), half.cast("int").alias("half"))
    taken = (
        docs.join(bounded(wanted), _KEY)
        .select("of.id", "of.hash", F.substr("text", F.lit(1), F.col("half")).alias("tail"))
        .dropDuplicates(_KEY)
    )
    return stays.join(taken, _KEY).select(*_KEY, F.concat("head", "tail").alias("text"))


def compared(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """id, n_chars, edited_sha256, samples, edited_samples, near_edited and near_next of every row."""
    docs, spark = keyed(docs, id, text), docs.sparkSession
    linked = saved(successors(docs))
    own = saved(samples(docs, _KEY))
    free_shuffles(spark)
    changed = edited(docs, linked).withColumn("sha", F.unhex(F.sha2("text", 256)))
    changed = samples(changed, [*_KEY, "sha"]).withColumnRenamed("samples", "edited_samples")
    following = own.select(F.col("id").alias("next_id"), F.col("hash").alias("next_hash"), F.col("samples").alias("next_samples"))
    return (
        linked.join(own, _KEY)
        .join(changed, _KEY)
        .join(following, ["next_id", "next_hash"])
        .select(
            F.when(F.col("id") != _NULL_ID, F.col("id")).alias("id"),
            "n_chars",
            F.lower(F.hex("sha")).alias("edited_sha256"),
            "samples",
            "edited_samples",
            likeness("samples", "edited_samples").alias("near_edited"),
            likeness("samples", "next_samples").alias("near_next"),
            F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("copy"),
        )
        .drop("copy")
    )


def _tables(spark: SparkSession) -> DataFrame:
    """One row: of the middles of equal parts of (0, 1), the logarithms, and those of the gamma quantiles."""
    p = (F.col("id") + 0.5) / _LEVELS
    # The distribution is 1 - (1 + x) / e^x; halving an interval finds x.
    start = F.struct(F.lit(0.0).alias("low"), F.lit(64.0).alias("high"))

    def halved(s: Column, _: Column) -> Column:
        x = (s["low"] + s["high"]) / 2
        below = 1 - (1 + x) * F.exp(-x) < p
        return F.struct(F.when(below, x).otherwise(s["low"]).alias("low"), F.when(below, s["high"]).otherwise(x).alias("high"))

    found = F.aggregate(F.sequence(F.lit(1), F.lit(50)), start, halved, lambda s: F.ln((s["low"] + s["high"]) / 2))
    rows = spark.range(_LEVELS).agg(F.collect_list(F.struct("id", F.ln(p).alias("u"), found.alias("c"))).alias("a")).select(F.sort_array("a").alias("a"))
    return saved(rows.select(F.transform("a", lambda x: x["u"]).alias("u"), F.transform("a", lambda x: x["c"]).alias("c")))


def _value(k: int) -> Column:
    """The value of a word in sample ``first`` + k, as a number that sorts alike, above the 24 bits of word and t."""
    h = F.xxhash64("word", F.col("first").cast("long") + F.lit(k + 1))
    level = lambda shift: F.shiftrightunsigned(h, shift).bitwiseAND(F.lit(_LEVELS - 1)).cast("int")
    r, b = -(F.get("u", level(0)) + F.get("u", level(16))), (level(48) + 0.5) / _LEVELS
    t = F.floor(F.col("ln_w") / r + b)
    value = F.get("c", level(32)) - r * (t - b + 1)  # between -128 and 128, as r is below 24 and ln w + r above r t
    name = (F.shiftrightunsigned("word", 40) + t * 0x9E3779).bitwiseAND(F.lit(0xFFFFFF))
    return F.shiftleft(F.floor((value + 128) * 2.0**30), 24).bitwiseOR(name)
