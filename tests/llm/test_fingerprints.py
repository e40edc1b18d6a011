import hashlib
import re
from collections import Counter

import numpy as np

from tillscope.llm import queries_duplicates, weighted_samples

FOLDER = "/root/testdata/sf0.01"


def words(text):
    return Counter(w for w in re.split("[ \t\n\r\x0b\f]+", text or "") if w)


def alike(a, b):
    a, b = words(a), words(b)
    return sum((a & b).values()) / max(1, sum((a | b).values())) if a or b else 1.0


def edits(rows):
    """Of each distinct row in order: the row, its edited text and the next text."""
    order = sorted({(i is not None, i or 0, t or "") for i, t in rows})
    out = {}
    for k, (known, i, text) in enumerate(order):
        after = order[(k + 1) % len(order)][2]
        half = len(text) // 2
        out[i if known else None, text] = (text[: len(text) - half] + after[:half], after)
    return out


def test_registered_query_against_brute_force(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    expected = edits(texts.items())
    found = queries_duplicates.op12_fingerprints(spark, FOLDER).collect()
    assert sorted(r.doc_id for r in found) == sorted(texts)
    by_text, off_edited, off_next = {}, [], []
    for r in found:
        text = texts[r.doc_id] or ""
        edited, after = expected[r.doc_id, text]
        assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        assert by_text.setdefault(text, r.fingerprint) == r.fingerprint
        off_edited.append(r.near_edited - alike(text, edited))
        off_next.append(r.near_next - alike(text, after))
    prints = {r.doc_id: r.fingerprint for r in found}
    after = dict(zip(sorted(prints), [*sorted(prints)[1:], min(prints)]))
    for r in found:
        both = (prints[r.doc_id], prints[after[r.doc_id]])
        same = [a == b for a, b in zip(*(re.findall("......", p) for p in both))]
        assert r.near_next == (sum(same) / 64 if all(both) else float(both[0] == both[1]))
    # Errors of 64 samples: about 0.06 for one pair, without a bias over 1,000.
    for off in (off_edited, off_next):
        assert abs(np.mean(off)) < 0.006
        assert np.sqrt(np.mean(np.square(off))) < 0.065


def test_weights_count(spark):
    # Each pair has words of its own, so that errors of pairs are independent.
    rng, texts = np.random.default_rng(2), []
    for pair in range(60):
        letters = [f"{c}{pair}" for c in "abcdefgh"]
        texts += [" ".join(rng.choice(letters, 200, p=rng.dirichlet(np.ones(8) * 0.7))) for _ in range(2)]
    docs = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "id long, text string")
    found = {r.id: r.samples for r in weighted_samples.samples(docs, ["id"], n=256).collect()}
    off = [np.mean(np.array(found[k]) == np.array(found[k + 1])) - alike(texts[k], texts[k + 1]) for k in range(0, 120, 2)]
    assert abs(np.mean(off)) < 0.012 and np.std(off) < 0.05


def test_odd_rows(spark):
    rows = [(4, "one two"), (1, None), (2, ""), (3, " \t\n"), (None, "é🙂 x"), (None, "other"), (7, "x " * 30_000), (7, "seven b"), (7, "seven b"), (9, "one two")]
    docs = spark.createDataFrame([(i, t, "clash", 1) for i, t in rows], "doc_id long, text string, hash string, samples int").repartition(3)
    found = weighted_samples.compared(docs).collect()
    expected = edits(rows)
    # Rows that share an id follow by a hash of their text, here checked only where ids differ.
    assert sorted((str(r.id), r.n_chars) for r in found) == sorted((str(i), len(t or "")) for i, t in rows)
    by = {r.id: r for r in found if r.id in (1, 2, 3, 4, 9)}
    for i, t in rows:
        if i in (1, 2, 3):
            assert by[i].edited_sha256 == hashlib.sha256(expected[i, t or ""][0].encode()).hexdigest()
    assert by[1].samples is None and by[1].near_next == 1.0 and by[3].near_next == 0.0
    assert by[4].samples == by[9].samples
    one = weighted_samples.compared(docs.filter("doc_id = 4")).collect()
    assert [(r.id, r.near_next) for r in one] == [(4, 1.0)]
    assert weighted_samples.compared(docs.limit(0)).count() == 0


def test_ranges_without_broadcast(spark, monkeypatch):
    from tillscope.llm import common

    rows = [(k * 3, f"text number {k} " * (k % 7)) for k in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    monkeypatch.setattr(common, "BROADCAST_KEYS", 0)
    expected = edits(rows)
    found = {r.id: r.edited_sha256 for r in weighted_samples.compared(docs).collect()}
    assert found == {i: hashlib.sha256(expected[i, t][0].encode()).hexdigest() for i, t in rows}
