"""Near-duplicates by SimHash, found with the anchor points of a covering code.

Two fingerprints of 64 bits that differ in at most three bits agree up to one bit in one of their halves. The 32-bit
halves are covered by a code of radius one: the perfect Hamming code of length 31 on the lower bits, and both values of the
last bit. The anchor of a half is its code word. A fingerprint stands at its own anchors, and is replicated to every anchor
within the covering radius plus the threshold, that is two bits: 17 at most for each half. Fingerprints are compared
per anchor, so no pair within reach is missed.

Groups stay cheap: equal fingerprints are one node. Nodes with the same anchor in one half and the same other half are
within two bits of each other; they are linked to one of them, and pairs that such links connect are left out of the
comparison. Components are found over the remaining links.

NULL and empty texts have fingerprint zero, which is linked like any other. Rows whose id is NULL keep it; a group's
id is the smallest one that is not NULL. Repeated rows each give a row. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bounded, keyed_rows, saved, without
from .components import components
from .tokens import give_back, texts_of

MOST_BITS = 3
_HALF = 0xFFFFFFFF
_BLOCK = 1 << 15


def fingerprints(docs: DataFrame, id: str = "doc_id", text: str = "text", shingle: int = 3, seed: int = 42) -> DataFrame:
    """id, text_hash and fingerprint (a long) of every document.

    Words are what ASCII white space parts, with A-Z lower-cased; shingles of ``shingle`` words count as often as they
    occur; shorter texts have one shingle.
    """

    def marked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for data, offsets, _ in texts_of(batch.column(2)):
                held = data.tobytes().lower()
                for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
                    found.append(fingerprint(held[a:b], shingle, seed))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(np.array(found, np.uint64).view(np.int64))],
                names=["id", "text_hash", "fingerprint"],
            )
        give_back()

    return docs.select(
        F.col(id).cast("long").alias("id"),
        F.xxhash64(F.col(text).cast("string")).alias("text_hash"),
        F.col(text).cast("string").alias("text"),
    ).mapInArrow(marked, "id long, text_hash long, fingerprint long")


def fingerprint(text: bytes, shingle: int = 3, seed: int = 42) -> int:
    """Majority of the hashes' bits; of lower-cased UTF-8."""
    import xxhash

    words = text.split()
    if not words:
        return 0
    held = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words])
    n = min(shingle, len(words))
    starts = np.concatenate([[0], ends[:-n]]).tolist()
    digest, set_bits = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    ends = (ends[n - 1 :] - 1).tolist()
    for k in range(0, len(ends), _BLOCK):
        hashes = [digest(held[a:b], seed) for a, b in zip(starts[k : k + _BLOCK], ends[k : k + _BLOCK])]
        bits = np.unpackbits(np.array(hashes, ">u8").view(np.uint8).reshape(-1, 8), axis=1)
        set_bits += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(set_bits * 2 > len(ends)).tobytes(), "big")


def groups(marked: DataFrame, most_bits: int = MOST_BITS) -> DataFrame:
    """The rows of ``fingerprints`` with root, the component's smallest fingerprint, and component_id, its smallest id."""
    if not 0 <= most_bits <= MOST_BITS:
        raise ValueError(f"anchors serve up to {MOST_BITS} differing bits")
    marked = saved(marked)
    nodes = saved(marked.groupBy("fingerprint").agg(F.min("id").alias("least")))
    roots = components(_links(nodes.select("fingerprint"), most_bits))
    rooted = nodes.join(roots, nodes.fingerprint == roots.node, "left").select(
        "fingerprint", "least", F.coalesce("root", "fingerprint").alias("root")
    )
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = saved(rooted.join(least, "root").select("fingerprint", "root", "component_id"))
    return marked.join(named, "fingerprint")


def survivors(docs: DataFrame, grouped: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` without all but one document of each group; ``grouped`` comes from ``groups``.

    The document with the smallest id stays (of NULL ids none, if there is another one), of rows with one id the one with
    the smallest text hash, of equal rows one.
    """
    place = F.struct(F.col("id").isNull().alias("null"), "id", "text_hash")
    counted = saved(grouped.groupBy("root", "id", "text_hash").agg(F.count(F.lit(1)).alias("n")))
    first = counted.groupBy("root").agg(F.min(place).alias("first"))
    ranked = saved(counted.join(first, "root").select("id", "text_hash", "n", (place == F.col("first")).alias("stays")))
    leaving = ranked.filter("NOT stays OR n > 1").select("id", "text_hash")
    repeated = ranked.filter("stays AND n > 1").select(
        F.coalesce("id", F.lit(-(1 << 63))).alias("_id"), F.col("text_hash").alias("_hash")
    )
    once = keyed_rows(docs, id, text).join(bounded(repeated), ["_id", "_hash"], "left_semi").dropDuplicates(["_id", "_hash"])
    return without(docs, leaving, id, text).unionByName(once.select("row.*"))


def _links(nodes: DataFrame, most_bits: int) -> DataFrame:
    fp = F.col("fingerprint")
    halves = F.array(
        F.struct(F.lit(0).alias("side"), fp.bitwiseAND(F.lit(_HALF)).alias("own"), F.shiftrightunsigned(fp, 32).alias("other")),
        F.struct(F.lit(1).alias("side"), F.shiftrightunsigned(fp, 32).alias("own"), fp.bitwiseAND(F.lit(_HALF)).alias("other")),
    )
    cut = (
        nodes.select("fingerprint", F.explode(halves).alias("h"))
        .select("fingerprint", "h.side", "h.own", "h.other")
        .withColumn("syndrome", _syndrome(F.col("own")))
        .withColumn("anchor", F.col("own").bitwiseXOR(_bit(F.col("syndrome"))))
    )
    # Within two bits: the same anchor and the same other half.
    tight = (
        cut.groupBy("side", "anchor", "other")
        .agg(F.min("fingerprint").alias("b"), F.collect_list("fingerprint").alias("all"))
        .filter(F.size("all") > 1)
        .select(F.explode("all").alias("a"), "b")
    )
    if most_bits < 2:
        tight = tight.filter(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= most_bits)
        known = nodes.select(F.col("fingerprint").alias("node"), F.col("fingerprint").alias("root"))
    else:
        tight = saved(tight.filter("a <> b").distinct())
        known = components(tight)
    key = F.col("side").cast("long") * (1 << 32) + F.col("anchor")
    homes = cut.select(F.col("fingerprint").alias("a"), key.alias("key"))
    copies = cut.select(
        F.col("fingerprint").alias("b"), F.col("side"), F.explode(_anchors()).alias("anchor")
    ).select("b", key.alias("key"))
    homes, copies = _with_root(homes, known, "a"), _with_root(copies, known, "b")
    near = (
        homes.join(copies, "key")
        .filter("a < b AND root_a <> root_b")
        .filter(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= most_bits)
        .select("a", "b")
    )
    return near.union(tight.select("a", "b"))


def _with_root(rows: DataFrame, known: DataFrame, name: str) -> DataFrame:
    return rows.join(known, rows[name] == known.node, "left").select(
        "key", name, F.coalesce("root", name).alias(f"root_{name}")
    )


def _syndrome(half: Column) -> Column:
    """Of the lower 31 bits under the Hamming code whose check for bit position p (from 1) is p itself."""
    total = F.lit(0)
    for j in range(5):
        mask = sum(1 << (p - 1) for p in range(1, 32) if p >> j & 1)
        total = total + F.bit_count(half.bitwiseAND(F.lit(mask))) % 2 * (1 << j)
    return total.cast("int")


def _bit(position: Column) -> Column:
    """The bit at a position from 1; nothing at 0."""
    return F.when(position == 0, F.lit(0).cast("long")).otherwise(F.call_function("shiftleft", F.lit(1).cast("long"), position - 1))


def _anchors() -> Column:
    """Every anchor within two bits: the own one, the own one with the last bit turned, and those two flips away."""
    own, s, anchor = F.col("own"), F.col("syndrome"), F.col("anchor")
    pairs = F.filter(
        F.sequence(F.lit(1), F.lit(31)), lambda i: (s != 0) & (i.bitwiseXOR(s) > i)
    )
    flipped = F.transform(pairs, lambda i: own.bitwiseXOR(_bit(i)).bitwiseXOR(_bit(i.bitwiseXOR(s))))
    return F.concat(F.array(anchor, anchor.bitwiseXOR(F.lit(1 << 31))), flipped)
