import zlib

import numpy as np
import pytest

from tillscope.llm import neighbours, queries_models, queries_vectors, string_kernel, subwords

DATA = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def documents(spark):
    return {r.doc_id: r for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()}


def remainder(id, n):
    return zlib.crc32(str(id).encode()) % n


def test_quality_on_held_out_labels(spark, documents):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{DATA}/labels.parquet").collect()}
    found = queries_models.op9_quality(spark, DATA).collect()
    assert sorted(r.doc_id for r in found) == sorted(documents)
    assert all(r.held_out == (remainder(r.doc_id, 3) == 1) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in found)
    held = [r.predicted == labels[r.doc_id] for r in found if r.held_out and r.doc_id in labels]
    assert np.mean(held) >= 0.95


def test_language_on_held_out_documents(spark, documents):
    found = queries_models.op10_language(spark, DATA).collect()
    assert sorted(r.doc_id for r in found) == sorted(documents)
    held = [r.lang_pred == documents[r.doc_id].lang for r in found if r.held_out]
    assert np.mean(held) >= 0.98


def test_classifiers_on_odd_rows(spark):
    texts = [None, "", "12 34", "the of and", "Straße über und", "x" * 200_000, "\x00", "é"]
    rows = [(k, t, ["en", "de", None][k % 3], "clash") for k, t in enumerate(texts)] + [(None, "the", "en", "clash"), (3, "the of and", "en", "clash")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, row string")
    model = string_kernel.train(docs)
    found = {r.id: r.lang_pred for r in string_kernel.predict(docs, model).collect()}
    assert {k for k, p in found.items() if p == "und"} == {0, 1, 2, 6}
    untrained = string_kernel.predict(docs, string_kernel.train(docs.limit(0))).collect()
    assert {(r.lang_pred, r.score) for r in untrained} == {("und", 0.0)} and len(untrained) == len(rows)

    labels = spark.createDataFrame([(3, 1), (3, 1), (4, 0), (5, None), (99, 1)], "doc_id long, quality int")
    scored = queries_models.quality_scores(docs, labels).collect()
    assert len(scored) == len(rows) and all(0 <= r.score <= 1 for r in scored)
    assert len(subwords.train(docs, labels.filter("quality = 7"), label="quality").classes) == 0
    assert {r.score for r in queries_models.quality_scores(docs, labels.limit(0)).collect()} == {0.5}
    assert queries_models.quality_scores(docs.limit(0), labels).count() == 0


def nearest(rows, k=20):
    ids, x = np.array([r[0] for r in rows]), np.array([r[1] for r in rows], np.float64)
    out = {}
    for n in np.flatnonzero(ids % 20 == 0):
        scores = (x * x[n]).sum(axis=1)
        order = [m for m in np.lexsort((ids, -scores)) if m != n][:k]
        out[int(ids[n])] = [(int(ids[m]), scores[m]) for m in order]
    return out


@pytest.mark.parametrize("folder", ["sf0.01", "sf0.1"])
def test_recall_on_the_given_table(spark, folder):
    folder = f"/root/testdata/{folder}"
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect()]
    exact = {(q, i): s for q, top in nearest(rows).items() for i, s in top}
    got = {(r.query_id, r.vec_id): r.score for r in queries_vectors.op5_nearest_neighbours(spark, folder).collect()}
    assert len(got) == len(exact)
    assert len(exact.keys() & got.keys()) / len(exact) >= 0.9


def test_recall_of_vectors_of_varying_length(spark):
    rng = np.random.default_rng(5)
    rows = [(k, (rng.normal(size=12) * np.exp(rng.normal())).tolist()) for k in range(4000)]
    vectors = neighbours.usable(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), "vec_id", "embedding")
    from pyspark.sql import functions as F

    router, exact = neighbours.fit(vectors), {(q, i) for q, top in nearest(rows).items() for i, _ in top}
    got = {(r.query_id, r.id) for r in neighbours.search(vectors, F.col("id") % 20 == 0, router).collect()}
    assert len(exact & got) / len(exact) >= 0.9
    whole = {(r.query_id, r.id) for r in neighbours.search(vectors, F.col("id") % 20 == 0, router, probes=len(router.bias)).collect()}
    assert whole == exact


def test_recall_against_brute_force(spark):
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(40, 16))
    rows = [(k, (centres[k % 40] + 0.6 * rng.normal(size=16)).tolist()) for k in range(6000)]
    vectors = neighbours.usable(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), "vec_id", "embedding")
    from pyspark.sql import functions as F

    found = neighbours.search(vectors, F.col("id") % 20 == 0, neighbours.fit(vectors)).collect()
    expected = nearest(rows)
    exact = {(q, i): s for q, top in expected.items() for i, s in top}
    got = {(r.query_id, r.id): r.score for r in found}
    assert len(got) == 20 * len(expected)
    assert len(exact.keys() & got.keys()) / len(exact) >= 0.9
    assert all(exact[k] == pytest.approx(got[k], abs=1e-12) for k in exact.keys() & got.keys())
    ranks = {}
    for r in found:
        ranks.setdefault(r.query_id, []).append((r.rank, -r.score, r.id))
    assert all(sorted(v) == sorted(v, key=lambda t: t[1:]) for v in ranks.values())


def test_odd_vectors_and_ties(spark):
    same = [0.25, -0.5, 1.0]
    rows = [(k, same, "clash") for k in range(60)] + [(100, None, "c"), (120, [0.0] * 3, "c"), (140, [1.0, None, 0.0], "c"), (160, [float("nan"), 1.0, 1.0], "c")]
    rows += [(180, [float("inf"), 1.0, 1.0], "c"), (200, [1.0, 1.0], "c"), (None, same, "c"), (20, same, "c"), (220, [9.0, 0.0, 0.0], "c")]
    vectors = neighbours.usable(spark.createDataFrame(rows, "vec_id long, embedding array<float>, vector string"), "vec_id", "embedding")
    from pyspark.sql import functions as F

    found = neighbours.search(vectors, F.col("id") % 20 == 0, neighbours.fit(vectors)).collect()
    by = {}
    for r in sorted(found, key=lambda r: r["rank"]):
        by.setdefault(r.query_id, []).append(r.id)
    assert sorted(by) == [0, 20, 40, 220]
    assert by[20] == [220, *[k for k in range(20)]][:20]
    assert by[220] == list(range(20))
    assert neighbours.search(vectors.limit(0), F.lit(True), neighbours.fit(vectors.limit(0))).count() == 0


def test_balanced_parts():
    rng = np.random.default_rng(0)
    group = rng.permutation(np.repeat(np.arange(4), 25))
    edges = ((group[:, None] == group[None, :]) & (rng.random((100, 100)) < 0.3)).astype(np.float32)
    edges = np.maximum(edges, edges.T)
    part = neighbours.balanced_parts(edges, 2, rng)
    assert np.bincount(part).tolist() == [25, 25, 25, 25]
    assert sum(len(set(part[group == g])) for g in range(4)) <= 6


def test_registered_query_answers_every_query_vector(spark):
    folder = "/root/testdata/sf0.001"
    n = spark.read.parquet(f"{folder}/embeddings.parquet").count()
    found = queries_vectors.op5_nearest_neighbours(spark, folder).groupBy("query_id").count().collect()
    assert {r["count"] for r in found} == {min(20, n - 1)}
