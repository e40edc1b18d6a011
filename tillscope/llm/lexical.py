"""Ranked lexical search by pipelined term partitioning.

Terms are runs of letters and digits (ASCII, A-Z lower-cased, and all beyond ASCII). The terms of the items are dealt to a few
owners, the rarest to the first, by about equal numbers of postings. Bundles of items pass the owners one after the other: a
bundle carries the sparse accumulators of a block of documents, the owner's postings of that block meet it by cogroup, and
integer contributions are added. What cannot reach the block's best any more, even with all terms to come, is dropped; this
loses nothing, as the final selection takes the best of the blocks' best.

A block is a bounded number of documents and postings of one task, however ids and copies are spread. Items are told apart by
id and text; equal rows count once. If they have more terms than ``BUNDLE_TERMS``, they are dealt to several bundles, each
with a pass over the documents.

NULL and empty texts have no terms and do not count. Every row is a document of its own, also if ids repeat; equal scores go
by ascending id, NULL ids first. An empty table of either kind gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import ascii_lower, saved, text_or_empty
from .tokens import give_back, texts_of

BUNDLE_TERMS = 100_000
OWNERS = 4
_PATTERN = r"([^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+)"
_BLOCK_DOCUMENTS, _BLOCK_POSTINGS = 2048, 1 << 18
_CELLS = 1 << 22  # of accumulators that are held at once
_MOST = 1_000_000  # a contribution is less, for each unit of a term's weight
_BLOCKS = "block long, n_docs long, n_terms long, ids array<long>, lengths binary, at binary, term binary, tf binary"
_POSTINGS = "block long, ids array<long>, at binary, term binary, gain binary"
_BUNDLE = "block long, item binary, at binary, score binary, ids array<long>"
#: Bytes of terms are kept, A-Z are lower-cased, all others part them.
_SIGNS = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b > 127 else 32 for b in range(256))


def search(docs: DataFrame, items: DataFrame, k: int = 10, id: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text", bundle_terms: int = BUNDLE_TERMS, owners: int = OWNERS) -> DataFrame:
    """item_id, rank, doc_id and score of the ``k`` best documents of every item."""
    held = text_or_empty(item_text)
    asked = saved(
        items.select(F.col(item).cast("long").alias("item_id"), F.xxhash64(held).alias("text_hash"), F.explode(F.array_distinct(F.regexp_extract_all(ascii_lower(held), F.lit(_PATTERN), 1))).alias("term")).distinct()
    )
    bundles = max(1, math.ceil(asked.count() / bundle_terms))
    docs = docs.select(F.col(id).cast("long").alias("id"), F.col(text).cast("string").alias("text"))
    number = F.pmod(F.xxhash64("item_id", "text_hash"), F.lit(bundles))
    best = reduce(DataFrame.union, [_ranked(docs, asked.filter(number == b), k, owners) for b in range(bundles)])
    order = Window.partitionBy("item_id", "text_hash").orderBy(F.desc("score"), F.asc_nulls_first("doc_id"), "block", "at")
    return best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")


def _ranked(docs: DataFrame, asked: DataFrame, k: int, owners: int) -> DataFrame:
    """The best of each block for the items of one bundle, which has a bounded number of terms."""
    rows = asked.collect()
    names = sorted({(r.item_id is not None, r.item_id or 0, r.text_hash) for r in rows})
    place = {x: n for n, x in enumerate(names)}
    vocabulary = {t: n for n, t in enumerate(sorted({r.term for r in rows}))}
    terms_of = [[] for _ in names]
    for r in rows:
        terms_of[place[r.item_id is not None, r.item_id or 0, r.text_hash]].append(vocabulary[r.term])
    blocks = saved(_indexed(docs, {t.encode(): n for t, n in vocabulary.items()}))
    sums = blocks.agg(F.sum("n_docs").alias("n"), F.sum("n_terms").alias("t")).first()
    n_docs, n_terms = sums.n or 0, sums.t or 0
    df = np.zeros(len(vocabulary), np.int64)
    for r in _frequencies(blocks).collect():  # one row for each term of the bundle
        df[r.term] = r.df
    weight = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(d) + 1))) for d in df], np.int64)
    order = np.lexsort((np.arange(len(df)), df))
    owner = np.zeros(len(df), np.int64)
    owner[order] = np.minimum((np.cumsum(df[order]) - df[order]) * owners // max(1, int(df.sum())), owners - 1)

    bundle = blocks.select("block", *[F.lit(b"").alias(c) for c in ("item", "at", "score")], F.lit(None).cast("array<long>").alias("ids"))
    for stage in range(owners):
        of_term: dict[int, list[int]] = {}
        still = np.zeros(len(names), np.int64)
        for n, own in enumerate(terms_of):
            still[n] = sum(int(weight[t]) for t in own if owner[t] > stage) * _MOST
            for t in own:
                if owner[t] == stage:
                    of_term.setdefault(t, []).append(n)
        postings = _owned(blocks, owner == stage, n_docs, n_terms)
        add = _adder(of_term, weight, still, k, last=stage + 1 == owners)
        bundle = bundle.groupBy("block").cogroup(postings.groupBy("block")).applyInArrow(add, _BUNDLE)

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                which = np.frombuffer(r["item"], np.int32)
                own = [names[n] for n in which]
                columns = [
                    pa.array([x[1] if x[0] else None for x in own], pa.int64()), pa.array([x[2] for x in own], pa.int64()), pa.array([r["block"]] * len(own), pa.int64()),
                    pa.array(np.frombuffer(r["at"], np.int32)), pa.array(r["ids"], pa.int64()), pa.array(np.frombuffer(r["score"], np.int64)),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["item_id", "text_hash", "block", "at", "doc_id", "score"])

    return bundle.mapInArrow(listed, "item_id long, text_hash long, block long, at int, doc_id long, score long")


def _indexed(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """Blocks of documents: ids, numbers of terms, and postings of the terms wanted (document's place, term, occurrences)."""

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number, ids, lengths, found, held = TaskContext.get().partitionId() << 33, [], [], [], 0

        def block() -> pa.RecordBatch:
            sizes = [len(t) for t, _ in found]
            at = np.repeat(np.arange(len(ids), dtype=np.int32), sizes)
            packed = [np.array(lengths, np.int64), at, *(np.concatenate(x).astype(np.int32) for x in zip(*found))]
            return pa.RecordBatch.from_arrays(
                [pa.array([number]), pa.array([sum(n > 0 for n in lengths)]), pa.array([sum(lengths)]), pa.array([ids], pa.list_(pa.int64())), *[pa.array([x.tobytes()], pa.binary()) for x in packed]],
                names=["block", "n_docs", "n_terms", "ids", "lengths", "at", "term", "tf"],
            )

        for batch in batches:
            own = batch.column(0).to_pylist()
            for data, offsets, first in texts_of(batch.column(1)):
                for k, (a, b) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist())):
                    words = data[a:b].tobytes().translate(_SIGNS).split()
                    terms = np.array([n for n in map(vocabulary.get, words) if n is not None], np.int32)
                    found.append(np.unique(terms, return_counts=True))
                    ids.append(own[first + k])
                    lengths.append(len(words))
                    held += len(found[-1][0])
                    if len(ids) == _BLOCK_DOCUMENTS or held >= _BLOCK_POSTINGS:
                        yield block()
                        number, ids, lengths, found, held = number + 1, [], [], [], 0
        if ids:
            yield block()
        give_back()

    return docs.mapInArrow(index, _BLOCKS)


def _frequencies(blocks: DataFrame) -> DataFrame:
    """term and df, the number of documents that hold it."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df = np.zeros(0, np.int64)
        for batch in batches:
            for held in batch.column(0).to_pylist():
                own = np.bincount(np.frombuffer(held, np.int32), minlength=len(df))
                own[: len(df)] += df
                df = own
        terms = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(terms.astype(np.int32)), pa.array(df[terms].astype(np.int64))], names=["term", "df"])

    return blocks.select("term").mapInArrow(counted, "term int, df long").groupBy("term").agg(F.sum("df").alias("df"))


def _owned(blocks: DataFrame, owned: np.ndarray, n_docs: int, n_terms: int) -> DataFrame:
    """An owner's postings, with what each adds for a weight of one."""

    def chosen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                lengths = np.frombuffer(r["lengths"], np.int64)
                at, term, tf = (np.frombuffer(r[c], np.int32) for c in ("at", "term", "tf"))
                own = owned[term]
                at, term, tf = at[own], term[own], tf[own].astype(np.int64)
                m = 10 + (90 * lengths * n_docs) // max(1, n_terms)
                gain = (1_000_000_000 * tf) // (1000 * tf + 8 * m[at])
                packed = [pa.array([x.tobytes()], pa.binary()) for x in (at, term, gain)]
                yield pa.RecordBatch.from_arrays([pa.array([r["block"]]), pa.array([r["ids"]], pa.list_(pa.int64())), *packed], names=["block", "ids", "at", "term", "gain"])

    return blocks.mapInArrow(chosen, _POSTINGS)


def _adder(of_term: dict[int, list[int]], weight: np.ndarray, still: np.ndarray, k: int, last: bool):
    """Adds an owner's contributions to the bundle of a block, and drops what cannot be among its ``k`` best any more.

    The last owner's bundle holds the best alone, with their ids.
    """

    def add(bundle: pa.Table, postings: pa.Table) -> pa.Table:
        (state,), (own,) = bundle.to_pylist(), postings.to_pylist()
        ids = own["ids"]
        at, term, gain = np.frombuffer(own["at"], np.int32), np.frombuffer(own["term"], np.int32), np.frombuffer(own["gain"], np.int64)
        order = np.argsort(term, kind="stable")
        at, term, gain = at[order], term[order], gain[order]
        item, held, score = np.frombuffer(state["item"], np.int32), np.frombuffer(state["at"], np.int32), np.frombuffer(state["score"], np.int64)
        bounds = np.flatnonzero(np.diff(term, prepend=-1, append=-1)) if len(term) else np.zeros(1, np.int64)
        rank = np.lexsort((np.arange(len(ids)), [i or 0 for i in ids], [i is not None for i in ids]))
        place = np.argsort(rank)
        out = []
        step = max(1, _CELLS // max(1, len(ids)))
        for first in range(0, len(still), step):
            cells = np.zeros((min(step, len(still) - first), len(ids)), np.int64)
            here = (item >= first) & (item < first + len(cells))
            cells[item[here] - first, held[here]] = score[here]
            for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
                t = int(term[a])
                of = [n - first for n in of_term.get(t, ()) if first <= n < first + len(cells)]
                if of:
                    cells[np.ix_(of, at[a:b])] += weight[t] * gain[a:b]
            for n, row in enumerate(cells):
                near = np.flatnonzero(row)
                if len(near) > k:
                    least = np.partition(row[near], len(near) - k)[len(near) - k]
                    near = near[row[near] + still[first + n] >= least]
                    if last:
                        near = near[np.lexsort((place[near], -row[near]))[:k]]
                out.append((np.full(len(near), first + n, np.int32), near.astype(np.int32), row[near]))
        item, held, score = (np.concatenate(x) for x in zip(*out)) if out else (np.zeros(0, np.int32), np.zeros(0, np.int32), np.zeros(0, np.int64))
        columns = [pa.array([state["block"]]), *[pa.array([x.tobytes()], pa.binary()) for x in (item, held, score)]]
        own = [ids[n] for n in held.tolist()] if last else None
        return pa.Table.from_arrays([*columns, pa.array([own], pa.list_(pa.int64()))], names=["block", "item", "at", "score", "ids"])

    return add
