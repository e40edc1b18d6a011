import math
import re
from collections import Counter

import numpy as np
import pytest

from tillscope.llm import lexical


def terms(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def plain_search(docs, items, k=10):
    counts = [(i, Counter(terms(t))) for i, t in docs]
    counts = [(i, c) for i, c in counts if c]
    n, total = len(counts), sum(sum(c.values()) for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    out = []
    for item, text in {(i, t or "") for i, t in items}:
        scored = []
        for i, c in counts:
            m = 10 + 90 * sum(c.values()) * n // total
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m)) for t in set(terms(text)) if c[t])
            if score > 0:
                scored.append((-score, i is not None, i or 0))
        out += [(str(item), rank, str(i if known else None), -s) for rank, (s, known, i) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out)


@pytest.mark.parametrize("block, cells, bundle_terms, owners", [(2048, 1 << 22, 100_000, 4), (7, 40, 25, 3), (3, 1, 100_000, 1)])
def test_search_against_brute_force(spark, monkeypatch, block, cells, bundle_terms, owners):
    monkeypatch.setattr(lexical, "_BLOCK_DOCUMENTS", block)
    monkeypatch.setattr(lexical, "_CELLS", cells)
    rng = np.random.default_rng(6)
    words = [f"w{k}" for k in range(60)] + ["The", "the", "Über", "ünder", "été9", "日本", "x_y", "a-b", "É"]
    odds = 1 / np.arange(1, len(words) + 1)
    make = lambda n: " ".join(rng.choice(words, n, p=odds / odds.sum()))
    docs = [(k, make(int(rng.integers(1, 60)))) for k in range(90)]
    docs += [(200 + k, docs[3][1]) for k in range(30)] + [(5, make(4)), (None, docs[7][1]), (None, docs[7][1]), (301, None), (302, ""), (303, " .,"), (304, "w1 " * 40_000)]
    items = [(k, make(6)) for k in range(9)] + [(3, "another text w9"), (7, None), (8, ""), (None, "w2 w3"), (20, "unseen"), (21, docs[3][1]), (21, docs[3][1])]
    d = spark.createDataFrame([(i, t, "clash", 1) for i, t in docs], "doc_id long, text string, block string, score int").repartition(3)
    b = spark.createDataFrame([(i, t, "clash") for i, t in items], "item_id long, text string, term string")
    found = lexical.search(d, b, bundle_terms=bundle_terms, owners=owners).collect()
    assert sorted((str(r.item_id), r["rank"], str(r.doc_id), r.score) for r in found) == plain_search(docs, items)
    if owners == 4:
        assert lexical.search(d.limit(0), b).count() == 0
        assert lexical.search(d, b.limit(0)).count() == 0
