"""A trie of conversations that share beginnings, from fingerprints that compose.

A sequence of turns has the fingerprint F = F' * BASE + t mod P of its last turn t and the sequence F' before it. With the
length it forms a monoid: F(xy) = F(x) * BASE^|y| + F(y). So fingerprints of all beginnings come from a scan whose parts are
combined afterwards, also inside one conversation of any length; and those of a conversation that is rebuilt from the head of
another one and its own rest are products of stored ones. Rebuilt texts are never made: an entry (conversation, depth) refers
to the stored turn that stands there.

Equal fingerprints of equal depth are a node. That they stand for equal sequences is verified: within a node all last turns
have the same digest and all parents are one node, and turns of one digest have the same role and text, as stored. Were one
of it not so, another base would be tried.

Sums over subtrees need no walk: the smallest members of the nodes below a node are members of it. A node's own sum is booked
on its smallest member; a conversation is the smallest member from some depth on to its end. So the sum over a node's subtree
is that of its members' bookings, less what its smallest member has booked above the node.

Turns are ordered by number, NULL first, turns of one number by a digest. NULL roles and texts are empty. Rows without
conversation id belong to none and are left out. Repeated rows are turns of their own. An empty table has no nodes. The
columns are renamed on reading, so others do not matter.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import saved

_P = (1 << 127) - 1  # a prime
_BASES = (0x5DEECE66D1CE4E5B9A3C1F0B7E15163, 0x2545F4914F6CDD1D8B72E6F4A09D3C7, 0x1B873593CC9E2D5185EBCA6B27D4EB3)
_EMPTY = bytes(16)
_SCANNED = "part int, conv long, at long, print binary, digest binary, chars long"
_NODE = ["depth", "print"]


def trie(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", group: int = 100, heads: int = 6) -> DataFrame:
    """conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens and ends_sha256 of every node.

    Conversation c is rebuilt from the first h turns of conversation c - c % ``group``, and its own turns after its first h;
    h is the unsigned crc32 of its decimal id, modulo ``heads``. The remainder has the sign of c.
    """
    words = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role, text)]
    digest = F.unhex(F.sha2(F.concat(F.length(words[0]).cast("string"), F.lit(":"), *words), 256))
    rows = turns.filter(F.col(conv).isNotNull()).select(
        F.col(conv).cast("long").alias("conv"), F.col(turn).cast("long").alias("turn"), words[0].alias("role"), words[1].alias("text"), digest.alias("digest")
    )
    if not rows.select("digest", "role", "text").distinct().groupBy("digest").count().filter("count > 1").isEmpty():
        raise RuntimeError("two turns have the same digest")
    rows = rows.select("conv", "turn", "digest", F.length("text").cast("long").alias("chars"))
    for base in _BASES:
        entries = saved(_entries(rows, base, group, heads))
        nodes = saved(
            entries.groupBy(*_NODE).agg(
                F.min("conv").alias("conv"),
                F.count(F.lit(1)).alias("n_convs"),
                F.max("chars").alias("chars"),
                F.min("parent").alias("parent"),
                ((F.min("parent") == F.max("parent")) & (F.min("digest") == F.max("digest"))).alias("same"),
            )
        )
        if nodes.filter("depth > 0 AND NOT same").isEmpty():
            return _summed(entries, nodes)
    raise RuntimeError("different sequences have the same fingerprints")


def _entries(rows: DataFrame, base: int, group: int, heads: int) -> DataFrame:
    """conv, depth, print, parent (print), digest, chars and ends of every beginning of every rebuilt conversation."""
    placed = saved(_placed(rows, base))
    head = F.crc32(F.col("conv").cast("string").cast("binary")) % heads
    convs = placed.groupBy("conv").agg(F.max("at").alias("own_turns"), F.max(F.when(F.col("at") == head, F.col("print"))).alias("own_print")).withColumn("h", head)
    # The rows of the first turns, at most ``heads`` - 1 of each conversation; those of groups' first ones are heads.
    first = placed.filter((F.col("at") < heads) & (F.col("conv") % group == 0))
    whole = first.groupBy("conv").agg(F.max("at").alias("turns")).select(F.col("conv").alias("base"), "turns")
    convs = (
        convs.withColumn("base", F.col("conv") - F.col("conv") % group)
        .join(whole, "base", "left")
        .withColumn("taken", F.least("h", F.coalesce("turns", F.lit(0))))
        .join(first.select(F.col("conv").alias("base"), F.col("at").alias("taken"), F.col("print").alias("head_print")), ["base", "taken"], "left")
    )
    empty = F.lit(_EMPTY)
    convs = saved(
        convs.select(
            "conv", "base", "h", "taken", (F.col("taken") + F.greatest(F.col("own_turns") - F.col("h"), F.lit(0))).alias("length"),
            F.when(F.col("taken") > 0, F.col("head_print")).otherwise(empty).alias("head_print"),
            F.when(F.col("h") > 0, F.col("own_print")).otherwise(empty).alias("own_print"),
        )
    )
    own = convs.select("conv", "h", "taken", "length", "head_print", "own_print")
    heads_of = (
        convs.join(first.select(F.col("conv").alias("base"), "at", "print", "digest", "chars"), "base")
        .filter("at <= taken")
        .select("conv", "length", F.col("at").alias("depth"), "print", F.lit(None).cast("long").alias("after"), empty.alias("head_print"), empty.alias("own_print"), "digest", "chars")
    )
    rest = (
        placed.join(own, "conv")
        .filter("at > h")
        .select("conv", "length", (F.col("taken") + F.col("at") - F.col("h")).alias("depth"), "print", (F.col("at") - F.col("h")).alias("after"), "head_print", "own_print", "digest", "chars")
    )
    roots = convs.select("conv", "length", F.lit(0).cast("long").alias("depth"), empty.alias("print"), F.lit(None).cast("long").alias("after"), empty.alias("head_print"), empty.alias("own_print"), F.lit(None).cast("binary").alias("digest"), F.lit(0).cast("long").alias("chars"))
    inverse = pow(base, -1, _P)

    def composed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, prints, parents = batch.to_pydict(), [], []
            for p, n, a, b, t in zip(*(rows[c] for c in ("print", "after", "head_print", "own_print", "digest"))):
                f = int.from_bytes(p)
                if n is not None:  # the head's product takes the place of that of the own first turns
                    f = (f + (int.from_bytes(a) - int.from_bytes(b)) * pow(base, n, _P)) % _P
                prints.append(f.to_bytes(16))
                parents.append(None if t is None else ((f - _value(t)) * inverse % _P).to_bytes(16))
            ends = [d == n for d, n in zip(rows["depth"], rows["length"])]
            yield pa.RecordBatch.from_arrays(
                [pa.array(rows["conv"], pa.int64()), pa.array(rows["depth"], pa.int64()), pa.array(prints, pa.binary()), pa.array(parents, pa.binary()), pa.array(rows["digest"], pa.binary()), pa.array(rows["chars"], pa.int64()), pa.array(ends)],
                names=["conv", "depth", "print", "parent", "digest", "chars", "ends"],
            )

    return heads_of.union(rest).union(roots).mapInArrow(composed, "conv long, depth long, print binary, parent binary, digest binary, chars long, ends boolean")


def _value(digest: bytes) -> int:
    return int.from_bytes(digest[:16]) % _P


def _placed(rows: DataFrame, base: int) -> DataFrame:
    """conv, at (from 1), print (of the turns up to there), digest and chars of every turn.

    Ranges of the sorted turns are scanned apart, so one conversation may span many; what stands before a range is multiplied
    to the left afterwards.
    """
    # Equal turns may stand in any order, so they can be spread over ranges.
    spread = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(1 << 20))
    order = ["conv", F.asc_nulls_first("turn"), "digest"]
    ranged = rows.withColumn("spread", spread).repartitionByRange(*order, "spread").sortWithinPartitions(*order).select("conv", "digest", "chars")

    def scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, now, n, f = TaskContext.get().partitionId(), None, 0, 0
        for batch in batches:
            convs, at, prints = batch.column(0).to_pylist(), [], []
            for c, t in zip(convs, batch.column(1).to_pylist()):
                if c != now:
                    now, n, f = c, 0, 0
                n, f = n + 1, (f * base + _value(t)) % _P
                at.append(n)
                prints.append(f.to_bytes(16))
            yield pa.RecordBatch.from_arrays(
                [pa.array([part] * len(at), pa.int32()), batch.column(0), pa.array(at, pa.int64()), pa.array(prints, pa.binary()), batch.column(1), batch.column(2)],
                names=["part", "conv", "at", "print", "digest", "chars"],
            )

    local = saved(ranged.mapInArrow(scanned, _SCANNED))
    ends = local.groupBy("part").agg(F.min("conv").alias("first"), F.max(F.struct("conv", "at", "print")).alias("last")).collect()  # a row for each range
    carried, now, n, f = {}, None, 0, 0
    for r in sorted(ends, key=lambda r: r.part):
        if r.first == now:
            carried[r.part] = (now, n, f)
        whole = r.first == r.last.conv == now
        now, n, f = r.last.conv, r.last.at + (n if whole else 0), (int.from_bytes(r.last.print) + (f * pow(base, r.last.at, _P) if whole else 0)) % _P

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts, convs, at, prints = (batch.column(k).to_pylist() for k in range(4))
            for k, (part, c) in enumerate(zip(parts, convs)):
                before = carried.get(part)
                if before and before[0] == c:
                    prints[k] = ((before[2] * pow(base, at[k], _P) + int.from_bytes(prints[k])) % _P).to_bytes(16)
                    at[k] += before[1]
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(at, pa.int64()), pa.array(prints, pa.binary()), batch.column(4), batch.column(5)], names=["conv", "at", "print", "digest", "chars"])

    return local.mapInArrow(joined, "conv long, at long, print binary, digest binary, chars long")


def _summed(entries: DataFrame, nodes: DataFrame) -> DataFrame:
    children = nodes.filter("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("parent").alias("print")).agg(F.count(F.lit(1)).alias("n_children"))
    booked = saved(
        nodes.join(children, _NODE, "left").select(
            *_NODE, "parent", "conv", "n_convs", F.coalesce("n_children", F.lit(0).cast("long")).alias("n_children"),
            F.col("n_children").isNull().cast("long").alias("leaf"), ((F.col("n_convs") - 1) * F.col("chars")).alias("saving"),
        )
    )
    totals = booked.groupBy("conv").agg(F.sum("leaf").alias("leaves"), F.sum("saving").alias("savings"))
    members = entries.select("conv", *_NODE).join(totals, "conv").groupBy(*_NODE).agg(F.sum("leaves").alias("leaves"), F.sum("savings").alias("savings"))
    above = _running(booked.select("conv", *_NODE, "leaf", "saving"))
    parents = nodes.select((F.col("depth") + 1).alias("depth"), F.col("print").alias("parent"), F.col("conv").alias("parent_conv_id"))
    return (
        booked.join(members, _NODE)
        .join(above, _NODE)
        .join(_ends(entries), _NODE, "left")
        .join(parents, ["depth", "parent"], "left")
        .select(
            F.col("conv").alias("conv_id"),
            "depth",
            "parent_conv_id",
            "n_convs",
            "n_children",
            (F.col("leaves") - F.col("leaves_above")).alias("n_leaves"),
            (F.col("savings") - F.col("savings_above")).alias("saved_tokens"),
            F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"),
        )
    )


def _running(booked: DataFrame) -> DataFrame:
    """Of every node, what its smallest member has booked at lesser depths; ranges are summed apart and then combined."""
    part = F.spark_partition_id().alias("part")
    ranged = saved(booked.repartitionByRange("conv", "depth").select("*", part))
    inside = Window.partitionBy("part", "conv").orderBy("depth").rowsBetween(Window.unboundedPreceding, -1)
    before = Window.partitionBy("conv").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = ranged.groupBy("part", "conv").agg(F.sum("leaf").alias("leaf"), F.sum("saving").alias("saving"))
    earlier = parts.select("part", "conv", *[F.sum(c).over(before).alias(f"{c}_before") for c in ("leaf", "saving")]).filter("leaf_before IS NOT NULL")
    zero = lambda c: F.coalesce(c, F.lit(0).cast("long"))
    own = ranged.select("part", "conv", *_NODE, *[F.sum(c).over(inside).alias(f"{c}_inside") for c in ("leaf", "saving")])
    return own.join(earlier, ["part", "conv"], "left").select(
        *_NODE,
        (zero(F.col("leaf_inside")) + zero(F.col("leaf_before"))).alias("leaves_above"),
        (zero(F.col("saving_inside")) + zero(F.col("saving_before"))).alias("savings_above"),
    )


def _ends(entries: DataFrame) -> DataFrame:
    """ends_sha256 of every node at which conversations end.

    The digest runs over their ids one after the other, so a node's ids pass one task; it holds one batch of them at a time.
    """

    def digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state, out = None, None, []
        for batch in batches:
            for node in zip(*(batch.column(k).to_pylist() for k in range(3))):
                if node[:2] != now:
                    if now is not None:
                        out.append((*now, state.hexdigest()))
                    now, state = node[:2], hashlib.sha256(str(node[2]).encode())
                else:
                    state.update(b",%d" % node[2])
            if out:
                yield _digests(out)
                out = []
        if now is not None:
            yield _digests([(*now, state.hexdigest())])

    last = entries.filter("ends").select(*_NODE, "conv")
    return last.repartition(*_NODE).sortWithinPartitions(*_NODE, "conv").mapInArrow(digested, "depth long, print binary, ends_sha256 string")


def _digests(rows: list[tuple]) -> pa.RecordBatch:
    depth, prints, digests = zip(*rows)
    return pa.RecordBatch.from_arrays([pa.array(depth, pa.int64()), pa.array(prints, pa.binary()), pa.array(digests)], names=["depth", "print", "ends_sha256"])
