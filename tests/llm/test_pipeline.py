import hashlib

import numpy as np
from tokenizers import Tokenizer

import __spark_entry__ as entry
import corpus_pipeline
from tillscope.llm import common, queries_models, registry
from tillscope.llm.common import tokenizer_path

from ..oracle import connect, normalized
from .test_duplicates import plain_fingerprint, plain_removed, roots
from .test_filters import plain_report

DATA = "/root/testdata/sf0.001"


def test_stages_against_brute_force(spark):
    docs = common.table(spark, DATA, "documents")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    scores = {r.doc_id: r.predicted for r in queries_models.quality_scores(docs, common.table(spark, DATA, "labels")).collect()}
    rows = [r for r in rows if scores[r[0]]]
    rows = [(i, "\n".join(x for n, x in enumerate(t.split("\n")) if n not in g)) for (i, t), g in zip(rows, plain_removed(rows))]
    prints = {i: plain_fingerprint(t) for i, t in rows}
    nodes = set(prints.values())
    root = roots(nodes, [(a, b) for a in nodes for b in nodes if a < b and (a ^ b).bit_count() <= 3])
    least = {}
    for i, p in prints.items():
        least[root[p]] = min(i, least.get(root[p], i))
    rows = [(i, t) for i, t in rows if least[root[prints[i]]] == i]
    items = [(r.item_id, r.text) for r in common.table(spark, DATA, "benchmark").collect()]
    bad = {int(i) for i, n, hit, _ in plain_report(rows, items) if hit and 20 * hit >= n}
    library = Tokenizer.from_file(tokenizer_path())
    expected = {}
    for i, t in rows:
        if i not in bad:
            ids = library.encode(t, add_special_tokens=False).ids
            expected[i] = (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(t.encode()).hexdigest())
    found = corpus_pipeline.run(spark, DATA).collect()
    assert {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in found} == expected
    assert len(found) == len(expected)


def test_stages_keep_the_columns(spark):
    docs = common.table(spark, DATA, "documents").limit(30).selectExpr("*", "1 AS row", "'x' AS text_hash")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = common.saved(stage(spark, docs, DATA))
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars", "row", "text_hash"]


def test_sql_of_the_queries(spark):
    connection = connect(DATA)
    for name, sql in registry.ORACLE_SQL.items():
        found = entry.queries()[name](spark, DATA)
        relation = connection.sql(sql)
        expected = normalized(relation.fetchall(), relation.columns)
        assert normalized([tuple(r) for r in found.collect()], found.columns) == expected, name


def test_registry_names_each_operator_once():
    numbers = sorted(int(n[2:].split("_")[0]) for n in registry.QUERIES)
    assert numbers == list(range(1, 14))
    assert entry.queries()["pipeline"] is corpus_pipeline.run
