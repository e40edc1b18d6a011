"""Text classification by supervised subword embeddings.

A text's features are its words, their character n-grams and pairs of neighbouring words, each hashed to a row of a table
of vectors; a pair of equal words always has the same row. A word and its n-grams are averaged, these averages and the
pairs are averaged over the text, and a softmax layer turns the mean into class probabilities. Vectors and layer are
learned together by stochastic gradient descent in numpy, on a bounded sample of labelled texts (``per_class`` of each
class). Scoring reads whole texts, in batches of bytes, with the vectors already multiplied by the layer.

NULL and empty texts have no features and get the probabilities of the bias. Without labelled texts all classes are
equally likely.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StructField, StructType

from .common import sample_per_class
from .tokens import give_back, is_space, ragged, texts_of

BUCKETS = 1 << 17
NGRAMS = (3, 4)
_SLICE = 1 << 20
_ODD = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xC2B2AE3D27D4EB4F)


@dataclass
class Model:
    classes: list
    vectors: np.ndarray
    layer: np.ndarray
    bias: np.ndarray

    def table(self) -> np.ndarray:
        return (self.vectors @ self.layer).astype(np.float32)


def train(
    docs: DataFrame,
    labels: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    label: str = "label",
    per_class: int = 1500,
    dims: int = 16,
    epochs: int = 5,
    rate: float = 0.3,
    seed: int = 1,
) -> Model:
    """Learns from the labelled documents; the driver holds at most twice ``per_class`` texts of each class.

    A document with several labels counts under each. Repeated rows count as often as they stand, up to that bound.
    """
    labels = labels.select(F.col(id).cast("long").alias("id"), F.col(label).alias("label")).distinct()
    chosen = sample_per_class(labels, "id", "label", per_class).cache()
    classes = sorted(r.label for r in chosen.select("label").distinct().collect())
    rows = (
        docs.select(F.col(id).cast("long").alias("id"), F.col(text).cast("string").alias("text"))
        .join(F.broadcast(chosen), "id")  # bounded by per_class and the number of classes
        .select("id", "label", "text")
        .limit(2 * per_class * max(len(classes), 1))
        .toArrow()
        .sort_by([("id", "ascending"), ("label", "ascending")])
    )
    chosen.unpersist()
    rng = np.random.default_rng(seed)
    model = Model(
        classes,
        rng.uniform(-1 / dims, 1 / dims, (BUCKETS, dims)).astype(np.float32),
        np.zeros((dims, len(classes)), np.float32),
        np.zeros(len(classes), np.float32),
    )
    if rows.num_rows:
        target = np.searchsorted(classes, rows["label"].to_numpy())
        _descend(model, *_sparse(rows["text"]), target, epochs, rate, rng)
    return model


def score(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """Every row as the struct ``row``, with ``probabilities`` (array of double, in the order of ``model.classes``)."""
    spread = docs.sparkSession.sparkContext.broadcast((model.table(), model.bias))
    place = docs.columns.index(text)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, bias = spread.value
        for batch in batches:
            texts = pc.struct_field(batch.column(0), place).cast(pa.string())
            # Rows go back slice by slice: the executor holds what comes back as a whole, beside what it sends.
            for data, offsets, first in texts_of(texts, _SLICE):
                p = softmax((_means(table, data, offsets) + bias).astype(np.float64))
                bounds = np.arange(len(p) + 1, dtype=np.int32) * p.shape[1]
                lists = pa.ListArray.from_arrays(pa.array(bounds), pa.array(p.ravel()))
                rows = batch.column(0).slice(first, len(p))
                yield pa.RecordBatch.from_arrays([rows, lists], names=["row", "probabilities"])
        give_back()

    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    schema = StructType([StructField("row", docs.schema), StructField("probabilities", ArrayType(DoubleType()))])
    return docs.select(row).mapInArrow(scored, schema)


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True)) if x.shape[1] else x
    return e / e.sum(axis=1, keepdims=True)


def words_of(data: np.ndarray, offsets: np.ndarray) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """Distinct words, the number of each word in the slice, and where each text's words start and end."""
    at_cut = np.zeros(len(data) + 1, bool)
    space = is_space(data)
    at_cut[1:-1] = space[1:] & ~space[:-1]
    at_cut[offsets] = True
    cuts = np.flatnonzero(at_cut)
    if len(cuts) < 2:
        return [], np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    pieces = pa.Array.from_buffers(
        pa.large_binary(), len(cuts) - 1, [None, pa.py_buffer(cuts), pa.py_buffer(data)]
    ).dictionary_encode()
    words = [w.strip(b" \t\n\r\v\f") for w in pieces.dictionary.to_pylist()]
    which = pieces.indices.to_numpy().astype(np.int64)
    real = np.array([bool(w) for w in words])[which]  # a text may end with white space, or be nothing else
    upto = np.concatenate([[0], np.cumsum(real)])
    return words, which[real], upto[np.searchsorted(cuts, offsets)]


def _features(words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A hash of each word; the buckets of each word and its n-grams, and their number."""
    if not words:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    sizes = np.array([len(w) + 2 for w in words], np.int64)
    data = np.frombuffer(b"<" + b"><".join(words) + b">", np.uint8).astype(np.uint64) + np.uint64(1)
    starts = np.cumsum(sizes) - sizes
    with np.errstate(over="ignore"):
        powers = np.cumprod(np.full(len(data), _ODD))
        # Position-free polynomial hash of a whole word: divide by the power at its start, by multiplying.
        sums = np.concatenate([[np.uint64(0)], np.cumsum(data * powers)])
        inverse = np.uint64(pow(int(_ODD), -1, 1 << 64))
        back = np.cumprod(np.full(len(data), inverse))
        whole = (sums[starts + sizes] - sums[starts]) * back[starts] * _MIX
        found, owner = [whole >> np.uint64(64 - 17)], [np.arange(len(words))]
        of = np.repeat(np.arange(len(words)), sizes)
        for n in NGRAMS:
            if len(data) < n:
                continue
            h = data[: len(data) - n + 1] * np.uint64(n)
            for k in range(1, n):
                h = h * _ODD + data[k : len(data) - n + 1 + k]
            inside = of[: len(h)] == of[n - 1 :]
            found.append((h[inside] * _MIX) >> np.uint64(64 - 17))
            owner.append(of[: len(h)][inside])
    owner = np.concatenate(owner)
    order = np.argsort(owner, kind="stable")
    buckets = np.concatenate(found).astype(np.int64)[order]
    return whole, buckets, np.bincount(owner, minlength=len(words))


def _pairs(whole: np.ndarray, which: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of neighbouring words, and where each text's pairs start and end."""
    with np.errstate(over="ignore"):
        h = whole[which]
        mixed = (h[:-1] * _ODD + h[1:]) * _MIX
        mixed[h[:-1] == h[1:]] = _MIX
    inner = np.ones(max(len(which) - 1, 0), bool)
    inner[bounds[1:-1][(bounds[1:-1] > 0) & (bounds[1:-1] < len(which))] - 1] = False
    upto = np.concatenate([[0], np.cumsum(inner)])
    ends = upto[np.clip(bounds - 1, 0, len(inner))]
    ends = np.where(bounds == 0, 0, ends)
    return (mixed[inner] >> np.uint64(64 - 17)).astype(np.int64), ends


def _sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    upto = np.concatenate([np.zeros((1, values.shape[1])), np.cumsum(values, axis=0, dtype=np.float64)])
    return upto[bounds[1:]] - upto[bounds[:-1]]


def _means(table: np.ndarray, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    words, which, bounds = words_of(data, offsets)
    whole, buckets, counts = _features(words)
    ends = np.concatenate([[0], np.cumsum(counts)])
    each = _sums(table[buckets], ends) / np.maximum(counts, 1)[:, None]
    pairs, pair_bounds = _pairs(whole, which, bounds) if len(which) else (which, bounds)
    total = _sums(each[which], bounds) + _sums(table[pairs], pair_bounds)
    n = np.diff(bounds) + np.diff(pair_bounds)
    return total / np.maximum(n, 1)[:, None]


def _sparse(texts: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buckets and weights of all texts, one behind the other, and where each text starts and ends."""
    ids, weights, sizes = [], [], []
    for data, offsets, _ in texts_of(texts.combine_chunks()):
        words, which, bounds = words_of(data, offsets)
        whole, buckets, counts = _features(words)
        starts = np.cumsum(counts) - counts
        pairs, pair_bounds = _pairs(whole, which, bounds) if len(which) else (which, bounds)
        for k in range(len(offsets) - 1):
            own, times = np.unique(which[bounds[k] : bounds[k + 1]], return_counts=True)
            two = pairs[pair_bounds[k] : pair_bounds[k + 1]]
            f = np.concatenate([buckets[ragged(starts[own], counts[own])], two])
            w = np.concatenate([np.repeat(times / counts[own], counts[own]), np.ones(len(two))])
            found, place = np.unique(f, return_inverse=True)
            ids.append(found.astype(np.int32))
            weights.append((np.bincount(place, w, len(found)) / max(times.sum() + len(two), 1)).astype(np.float32))
            sizes.append(len(found))
    return np.concatenate(ids), np.concatenate(weights), np.concatenate([[0], np.cumsum(sizes)])


def _descend(model, ids, weights, bounds, target, epochs, rate, rng, batch=32) -> None:
    n, k = len(target), len(model.classes)
    share = n / (k * np.maximum(np.bincount(target, minlength=k), 1))  # classes weigh alike
    steps = epochs * -(-n // batch)
    step = 0
    for _ in range(epochs):
        for some in np.array_split(rng.permutation(n), -(-n // batch)):
            lr = rate * (1 - step / steps)
            step += 1
            sizes = bounds[some + 1] - bounds[some]
            at = ragged(bounds[some], sizes)
            f, w, of = ids[at], weights[at], np.repeat(np.arange(len(some)), sizes)
            rows = model.vectors[f] * w[:, None]
            hidden = _sums(rows, np.concatenate([[0], np.cumsum(sizes)])).astype(np.float32)
            wrong = softmax(hidden @ model.layer + model.bias)
            wrong[np.arange(len(some)), target[some]] -= 1
            wrong = (wrong * share[target[some]][:, None]).astype(np.float32)
            touched, place = np.unique(f, return_inverse=True)
            pull = np.stack([np.bincount(place, w * wrong[of, c], len(touched)) for c in range(k)], axis=1)
            model.vectors[touched] -= lr * 4 * (pull @ model.layer.T).astype(np.float32)
            model.layer -= lr * hidden.T @ wrong
            model.bias -= lr * 0.1 * wrong.mean(axis=0)
