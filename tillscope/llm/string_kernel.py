"""Language identification with a string kernel.

Two texts are as alike as the n-grams of one to three bytes that both hold: the number of shared ones over the geometric
mean of both numbers (a blended-spectrum kernel of presence). N-grams are lower-cased in A-Z and hashed to ``DIMS`` places.
Landmark texts of every language span a Nyström approximation of the kernel; on its coordinates a ridge regression for each
language against the rest is solved in closed form. Scoring multiplies batches of presence rows with the landmarks.

A NULL text and a text without any letter are ``und`` with score 0. So is every text if there was nothing to learn from.
Ties between languages go to the first in alphabetical order.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import sample_per_class
from .tokens import give_back, texts_of

DIMS = 1 << 14
UNKNOWN = "und"
_BATCH = 256


@dataclass
class Model:
    languages: list[str]
    landmarks: np.ndarray  # presence of n-grams, one landmark a column, over the root of its number of n-grams
    weights: np.ndarray  # from kernel values to languages
    bias: np.ndarray


def train(
    docs: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
    per_language: int = 600,
    landmarks: int = 40,
    ridge: float = 1e-2,
) -> Model:
    """Learns from at most ``per_language`` texts of each language; ``landmarks`` of each are landmarks.

    Rows without language or text are left out.
    """
    rows = docs.select(
        F.col(id).cast("long").alias("id"), F.col(lang).cast("string").alias("lang"), F.col(text).cast("string").alias("text")
    )
    chosen = sample_per_class(rows.select("id", "lang"), "id", "lang", per_language).distinct().cache()
    n = chosen.count()
    found = (
        rows.filter(F.col("text").isNotNull())
        .join(F.broadcast(chosen), ["id", "lang"])  # bounded by per_language and the number of languages
        .limit(2 * max(n, 1))
        .toArrow()
        .sort_by([("lang", "ascending"), ("id", "ascending"), ("text", "ascending")])
    )
    chosen.unpersist()
    if not found.num_rows:
        return Model([], np.zeros((DIMS, 0), np.float32), np.zeros((0, 0)), np.zeros(0))
    languages, target = np.unique(found["lang"].to_numpy(zero_copy_only=False).astype(str), return_inverse=True)
    texts = found["text"].combine_chunks()
    picked = np.concatenate([np.flatnonzero(target == k)[:landmarks] for k in range(len(languages))])
    base = np.concatenate(list(_presence(texts.take(pa.array(picked)))))
    points = (base / _root(base)[:, None]).T.astype(np.float32)
    kernel = np.concatenate([_alike(p, points) for p in _presence(texts)])
    values, vectors = np.linalg.eigh((kernel[picked] + kernel[picked].T).astype(np.float64) / 2)
    kept = values > 1e-6 * values.max()
    to_coordinates = vectors[:, kept] / np.sqrt(values[kept])
    x = kernel @ to_coordinates
    y = np.eye(len(languages))[target]
    share = np.sqrt(len(y) / (len(languages) * y.sum(axis=0)))[target][:, None]  # languages weigh alike
    middle = np.average(x, axis=0, weights=share[:, 0] ** 2)
    a, b = (x - middle) * share, (y - 1 / len(languages)) * share
    solved = np.linalg.solve(a.T @ a + ridge * len(y) / x.shape[1] * np.eye(x.shape[1]), a.T @ b)
    return Model(languages.tolist(), points, to_coordinates @ solved, 1 / len(languages) - middle @ solved)


def predict(docs: DataFrame, model: Model, id: str = "doc_id", text: str = "text") -> DataFrame:
    """id, lang_pred and score (the regression's value, held between 0 and 1) of every document."""
    spread = docs.sparkSession.sparkContext.broadcast(
        (model.languages, model.landmarks, model.weights, model.bias)
    )
    schema = "id long, lang_pred string, score double"

    def predicted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        languages, points, weights, bias = spread.value
        letter, names = re.compile(r"[^\W\d_]"), np.array([*languages, UNKNOWN])
        for batch in batches:
            texts = batch.column(1)
            known = np.array([t is not None and bool(letter.search(t)) for t in texts.to_pylist()], bool)
            best, score = np.full(len(texts), len(names) - 1), np.zeros(len(texts))
            if len(names) > 1 and len(texts):
                values = np.concatenate(
                    [_alike(p, points) @ weights + bias for p in _presence(texts)]
                )
                best = np.where(known, values.argmax(axis=1), best)
                score = np.where(known, np.clip(values.max(axis=1), 0, 1), 0)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(names[best].tolist(), pa.string()), pa.array(score, pa.float64())],
                names=["id", "lang_pred", "score"],
            )
        give_back()

    chosen = docs.select(F.col(id).cast("long").alias("id"), F.col(text).cast("string").alias("text"))
    return chosen.mapInArrow(predicted, schema)


def _presence(texts: pa.Array) -> Iterator[np.ndarray]:
    """Which n-grams each text holds, in blocks of texts."""
    lower = np.arange(256, dtype=np.uint32)
    lower[65:91] += 32
    for data, offsets, _ in texts_of(texts):
        one = lower[data] + np.uint32(1)
        with np.errstate(over="ignore"):
            grams = [one * np.uint32(0x9E3779B1)]
            for n in (1, 2):
                before = grams[-1]
                grams.append(before[: max(len(before) - 1, 0)] * np.uint32(0x01000193) + one[n:] * np.uint32(0x85EBCA6B))
            grams = [(g >> np.uint32(3)) * np.uint32(0xC2B2AE35) >> np.uint32(18) for g in grams]
        for first in range(0, len(offsets) - 1, _BATCH):
            last = min(first + _BATCH, len(offsets) - 1)
            rows = np.zeros((last - first, DIMS), np.float32)
            for k in range(first, last):
                for n, g in enumerate(grams):
                    rows[k - first][g[offsets[k] : max(offsets[k + 1] - n, offsets[k])]] = 1
            yield rows


def _root(rows: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(rows.sum(axis=1), 1))


def _alike(rows: np.ndarray, points: np.ndarray) -> np.ndarray:
    return (rows @ points) / _root(rows)[:, None]
