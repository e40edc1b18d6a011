"""Approximate nearest neighbours by inner product, with learned partitions.

1. A bounded sample gives a graph of nearest neighbours, which is cut into balanced parts: the graph is halved again and
   again along its smoothest direction, and swaps of vectors between the halves then lower the number of cut edges.
2. A softmax classifier learns from the sample in which parts a vector's neighbours lie.
   An added coordinate gives all vectors the norm of the longest, so that their nearness to a query follows the angle.
3. Every vector is indexed in its most probable part. A query goes to its most probable parts, at least ``probes``, and more
   until they hold enough vectors. Where it is not given, ``probes`` is the least number that finds ``TARGET`` of the
   neighbours of a quarter of the sample that the classifier has not seen. All parts make the search exact.
4. Parts are compared in blocks of bounded size, of vectors and of queries, as matrix products in double precision. Inner
   products of the best are computed anew, each in the same order of additions, so that equal vectors tie exactly.

NULL or zero vectors and those with NULL or non-finite components take no part, nor do rows without id, nor vectors of
another length than the most frequent one (of equally frequent ones the longest). Rows that share an id count once, with
the smallest vector. Ties go to the smaller id. Fewer candidates than wanted are all returned. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import saved, smallest
from .subwords import softmax

SAMPLE = 4096
PARTS = 16
#: Recall that the number of probes is chosen for, on vectors held out; the loss between sample and table needs the margin.
TARGET = 0.975
_BLOCK, _QUERIES, _AT_ONCE = 20_000, 4_000, 64


@dataclass
class Router:
    """Probabilities of the parts for a vector; ``longest`` is the norm of the longest vector."""

    layer: np.ndarray
    bias: np.ndarray
    longest: float = 0.0
    probes: int = 1

    def probabilities(self, x: np.ndarray, query: bool = False) -> np.ndarray:
        return softmax(_unit(x, self.longest, query) @ self.layer + self.bias)


def _unit(x: np.ndarray, longest: float, query: bool) -> np.ndarray:
    """Unit vectors with a further coordinate: nothing for a query, what the norm lacks for others."""
    norms = np.linalg.norm(x, axis=1, keepdims=True)
    if query:
        return np.hstack([x / np.maximum(norms, 1e-300), np.zeros_like(norms)])
    lacking = np.sqrt(np.maximum(1 - (norms / longest) ** 2, 0)) if longest else np.zeros_like(norms)
    return np.hstack([x / (longest or 1), lacking])


def usable(rows: DataFrame, id: str, vector: str) -> DataFrame:
    """id and vector of the rows that take part."""
    x = F.col(vector).cast("array<double>")
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    rows = rows.filter(F.col(id).isNotNull() & x.isNotNull() & finite & F.exists(x, lambda v: v != 0))
    rows = rows.groupBy(F.col(id).cast("long").alias("id")).agg(F.min(x).alias("vector"))
    rows = saved(rows)
    size = rows.groupBy(F.size("vector").alias("size")).count().orderBy(F.desc("count"), F.desc("size")).first()
    return rows.filter(F.size("vector") == (size.size if size else 0))


def fit(vectors: DataFrame, sample: int = SAMPLE, parts: int = PARTS, neighbours: int = 10, seed: int = 1) -> Router:
    """Learns from at most ``sample`` vectors; the driver holds them."""
    norm = F.sqrt(F.aggregate("vector", F.lit(0.0), lambda t, v: t + v * v))
    longest = vectors.agg(F.max(norm)).first()[0]
    rows = smallest(vectors, [F.xxhash64("id"), F.col("id")], sample).toArrow()
    if not rows.num_rows:
        return Router(np.zeros((0, 1)), np.zeros(1))
    x = np.array(rows["vector"].to_pylist(), np.float64)
    held = np.arange(len(x)) % 4 == 3
    levels = max(0, min(int(np.log2(parts)), int(np.log2(max((~held).sum() / 64, 1)))))
    known, asked = x[~held], x[held]
    k = min(neighbours, len(known) - 1)
    near = _nearest_rows(known, known, k, own=True)
    edges = np.zeros((len(known), len(known)), np.float32)
    np.put_along_axis(edges, near, 1, axis=1)
    edges = np.maximum(edges, edges.T)
    part = balanced_parts(edges, levels, np.random.default_rng(seed))
    # What is to be learned: the part of a vector, and those of its neighbours where it is a query.
    own = np.eye(1 << levels)[part]
    around = own[near].sum(axis=1) + 1e-9
    both = np.vstack([_unit(known, longest, False), _unit(known, longest, True)])
    router = _learn(both, np.vstack([own, around / around.sum(axis=1, keepdims=True)]))
    router.longest = longest
    router.probes = 1 << levels
    if len(asked) and k > 0:
        indexed = router.probabilities(known).argmax(axis=1)
        rank = np.argsort(np.argsort(-router.probabilities(asked, query=True), axis=1, kind="stable"), axis=1)
        needed = np.take_along_axis(rank, indexed[_nearest_rows(asked, known, k, own=False)], axis=1) + 1
        router.probes = next(p for p in range(1, (1 << levels) + 1) if (needed <= p).mean() >= TARGET)
    return router


def _nearest_rows(queries: np.ndarray, rows: np.ndarray, k: int, own: bool) -> np.ndarray:
    """Places of the k rows of the largest inner products; ``own`` leaves the query itself out."""
    near = np.zeros((len(queries), max(k, 0)), int)
    for first in range(0, len(queries) if k > 0 else 0, 512):
        alike = -(queries[first : first + 512] @ rows.T)
        if own:
            alike[np.arange(len(alike)), np.arange(first, first + len(alike))] = np.inf
        near[first : first + 512] = np.argpartition(alike, k - 1, axis=1)[:, :k]
    return near


def balanced_parts(edges: np.ndarray, levels: int, rng: np.random.Generator) -> np.ndarray:
    """Parts of equal size (up to one) of a graph, that few edges cut."""
    part = np.zeros(len(edges), int)
    for _ in range(levels):
        whole = part.copy()
        for p in range(whole.max() + 1):
            of = np.flatnonzero(whole == p)
            part[of] = 2 * p + _halved(edges[np.ix_(of, of)], rng)
    return part


def _halved(edges: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    n, degree = len(edges), edges.sum(axis=1) + 1
    v = rng.normal(size=n)
    for _ in range(60):  # towards the smoothest vector that is not constant
        v = v - (v @ degree) / degree.sum()
        v = (edges @ v + v) / degree * 0.5 + v * 0.5
        v /= np.linalg.norm(v) or 1
    side = np.zeros(n, int)
    side[np.argsort(v, kind="stable")[n // 2 :]] = 1
    for _ in range(20):
        sign = 2.0 * side - 1
        gain = -(edges @ sign) * sign  # cut edges less inner ones
        a, b = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
        a, b = a[np.argsort(-gain[a], kind="stable")], b[np.argsort(-gain[b], kind="stable")]
        m = min(len(a), len(b), max(1, n // 50))
        better = (gain[a[:m]] + gain[b[:m]] - 2 * edges[a[:m], b[:m]]) > 0
        if not better.any():
            break
        trial = side.copy()
        trial[a[:m][better]], trial[b[:m][better]] = 1, 0
        if _cut(edges, trial) >= _cut(edges, side):
            break
        side = trial
    return side


def _cut(edges: np.ndarray, side: np.ndarray) -> float:
    return float(side @ edges @ (1 - side))


def _learn(x: np.ndarray, target: np.ndarray, steps: int = 300, rate: float = 0.05) -> Router:
    layer, bias = np.zeros((x.shape[1], target.shape[1])), np.zeros(target.shape[1])
    moments = [np.zeros_like(layer), np.zeros_like(layer), np.zeros_like(bias), np.zeros_like(bias)]
    for t in range(1, steps + 1):
        wrong = (softmax(x @ layer + bias) - target) / len(x)
        for k, (at, slope) in enumerate(((layer, x.T @ wrong + 1e-5 * layer), (bias, wrong.sum(axis=0)))):
            m, v = moments[2 * k], moments[2 * k + 1]
            m += 0.1 * (slope - m)
            v += 0.001 * (slope * slope - v)
            at -= rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-9)
    return Router(layer, bias)


def search(vectors: DataFrame, is_query: Column, router: Router, k: int = 20, probes: int | None = None) -> DataFrame:
    """query_id, rank, id and score of the k nearest vectors of every row for which ``is_query`` (of id) holds."""
    bias, probes = router.bias, probes or router.probes

    def indexed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                p = router.probabilities(_matrix(batch.column(1)))
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array(p.argmax(axis=1).astype(np.int32))], names=["id", "vector", "part"]
                )

    base = saved(vectors.mapInArrow(indexed, "id long, vector array<double>, part int"))
    held = np.zeros(len(bias), np.int64)
    for r in base.groupBy("part").count().collect():  # one row for each part
        held[r.part] = r["count"]

    def routed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            p = router.probabilities(_matrix(batch.column(1)), query=True)
            order = np.argsort(-p, axis=1, kind="stable")
            enough = (np.cumsum(held[order], axis=1) >= k + 1).argmax(axis=1) + 1
            enough[held.sum() < k + 1] = len(held)
            counts = np.minimum(np.maximum(enough, probes), len(held))
            rows = np.repeat(np.arange(len(order)), counts)
            chosen = np.concatenate([o[:c] for o, c in zip(order, counts)])
            some = batch.take(pa.array(rows))
            yield pa.RecordBatch.from_arrays(
                [some.column(0), some.column(1), pa.array(chosen.astype(np.int32))], names=["id", "vector", "part"]
            )

    queries = saved(
        base.filter(is_query).select("id", "vector").mapInArrow(routed, "id long, vector array<double>, part int")
    )
    asked = {r.part: r["count"] for r in queries.groupBy("part").count().collect()}
    blocks = vectors.sparkSession.createDataFrame(
        [(p, max(1, -(-int(n) // _BLOCK)), max(1, -(-asked.get(p, 0) // _QUERIES))) for p, n in enumerate(held)],
        "part int, blocks int, groups int",
    )
    salt = lambda n: F.pmod(F.xxhash64("id"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    blocks = F.broadcast(blocks)  # one row for each part
    left = base.join(blocks, "part").select("part", salt("blocks").alias("block"), every("groups").alias("group"), "id", "vector")
    right = queries.join(blocks, "part").select("part", every("blocks").alias("block"), salt("groups").alias("group"), "id", "vector")
    key = ["part", "block", "group"]
    found = left.groupBy(*key).cogroup(right.groupBy(*key)).applyInArrow(
        lambda b, q: _nearest(b, q, k), "query_id long, id long, score double"
    )
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select("query_id", "rank", "id", "score")


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1)


def _nearest(base: pa.Table, queries: pa.Table, k: int) -> pa.Table:
    ids, of, scores = [], [], []
    if base.num_rows and queries.num_rows:
        base = base.sort_by("id")
        base_ids = base["id"].to_numpy()
        x, q = _matrix(base["vector"].combine_chunks()), _matrix(queries["vector"].combine_chunks())
        query_ids = queries["id"].to_numpy()
        for first in range(0, len(q), _AT_ONCE):
            products = q[first : first + _AT_ONCE] @ x.T
            for n, row in enumerate(products):
                query, own = q[first + n], query_ids[first + n]
                at = int(np.searchsorted(base_ids, own))
                if at < len(row) and base_ids[at] == own:
                    row[at] = -np.inf
                if len(row) > k:
                    least = np.partition(row, len(row) - k)[len(row) - k]
                    slack = 1e-12 * (1 + float(np.abs(query).sum()) * float(np.abs(x).max()))
                    near = np.flatnonzero((row >= least - slack) & (row > -np.inf))
                else:
                    near = np.flatnonzero(row > -np.inf)
                exact = (x[near] * query).sum(axis=1)
                near, exact = (v[np.lexsort((base_ids[near], -exact))[:k]] for v in (near, exact))
                ids.append(base_ids[near])
                scores.append(exact)
                of.append(np.full(len(near), own))
    join = lambda v, kind: np.concatenate(v).astype(kind) if v else np.zeros(0, kind)
    return pa.table({"query_id": join(of, np.int64), "id": join(ids, np.int64), "score": join(scores, np.float64)})
