import re
from collections import defaultdict

import numpy as np
import xxhash
from pyspark.sql import functions as F

from tillscope.llm import line_dedup, simhash
from tillscope.llm.components import components


def plain_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    n = min(3, len(words))
    hashes = [xxhash.xxh64_intdigest(" ".join(words[k : k + n]).encode(), 42) for k in range(len(words) - n + 1)] if words else []
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def roots(nodes, links):
    parent = {n: n for n in nodes}

    def find(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in links:
        a, b = sorted((find(a), find(b)))
        parent[b] = a
    return {n: find(n) for n in nodes}


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def test_fingerprints(spark):
    texts = ["", None, "One", "one TWO", "a b c", "a b c\td\x0be", "É é x y z " * 40, "w " * 70_000, "ÀB the of"]
    rows = [(k, t, "clash") for k, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fingerprint string")
    found = {r.id: r.fingerprint for r in simhash.fingerprints(docs).collect()}
    assert found == {k: signed(plain_fingerprint(t)) for k, t in enumerate(texts)}


def test_groups_lose_no_link(spark):
    rng = np.random.default_rng(5)
    prints = [0, (1 << 64) - 1]
    for _ in range(60):
        x = int(rng.integers(0, 1 << 63)) * 2 + 1
        for _ in range(6):
            prints.append(x)
            for b in rng.choice(64, int(rng.integers(1, 5)), replace=False):
                x ^= 1 << int(b)
    rows = [(None if k % 50 == 7 else k, k, signed(p)) for k, p in enumerate(prints)] + [(900, 1, 0), (900, 1, 0)]
    marked = spark.createDataFrame(rows, "id long, text_hash long, fingerprint long")
    nodes = {r[2] for r in rows}
    for bits in (3, 1):
        links = [(a, b) for a in nodes for b in nodes if a < b and ((a ^ b) & ((1 << 64) - 1)).bit_count() <= bits]
        root = roots(nodes, links)
        least = defaultdict(lambda: None)
        for id, _, p in rows:
            if id is not None:
                least[root[p]] = min(id, least[root[p]] if least[root[p]] is not None else id)
        found = simhash.groups(marked, bits).collect()
        expected = sorted((str(i), h, p, root[p], least[root[p]]) for i, h, p in rows)
        assert sorted((str(r.id), r.text_hash, r.fingerprint, r.root, r.component_id) for r in found) == expected


def test_one_of_each_group_survives(spark):
    text = "the quick brown fox jumps over the lazy dog again and again"
    rows = [(3, text, 1), (1, text, 2), (1, text, 2), (None, text, 3), (4, "something else altogether here", 4), (None, None, 5), (9, "", 6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, row int")
    kept = simhash.survivors(docs, simhash.groups(simhash.fingerprints(docs))).collect()
    assert sorted((r.doc_id, r.row) for r in kept) == [(1, 2), (4, 4), (9, 6)]
    none = docs.limit(0)
    assert simhash.survivors(none, simhash.groups(simhash.fingerprints(none))).count() == 0


def test_components_of_chains_and_stars(spark):
    rng = np.random.default_rng(2)
    chain = [(k, k + 1) for k in range(100, 160)]
    star = [(7, k) for k in range(200, 260)]
    other = [tuple(map(int, rng.integers(300, 420, 2))) for _ in range(70)]
    links = chain + star + other
    nodes = {n for e in links if e[0] != e[1] for n in e}
    found = components(spark.createDataFrame(links, "a long, b long")).collect()
    expected = roots(nodes, [e for e in links if e[0] != e[1]])
    assert {r.node: r.root for r in found} == {n: r for n, r in expected.items() if n != r}


def words_of(line):
    return frozenset(w for w in re.split("[ \t\r\v\f]+", re.sub("[A-Z]", lambda m: m[0].lower(), line)) if w)


def plain_removed(rows):
    """Numbers of removed lines of each row."""
    places = [((-(1 << 63) if id is None else id), n, words_of(x)) for id, t in rows for n, x in enumerate((t or "").split("\n"))]
    out = []
    for id, text in rows:
        gone = set()
        for n, line in enumerate((text or "").split("\n")):
            own = words_of(line)
            at = (-(1 << 63) if id is None else id, n)
            if own and any((i, m) < at and w and 9 * len(w & own) >= 4 * (len(w) + len(own)) for i, m, w in places):
                gone.add(n)
        out.append(gone)
    return out


def test_lines_against_brute_force(spark, monkeypatch):
    rng = np.random.default_rng(11)
    vocabulary = [f"w{k}" for k in range(400)] + ["Ünï", "THE", "of"]

    def line():
        return list(rng.choice(vocabulary, int(rng.integers(3, 40))))

    pool, rows = [line() for _ in range(25)], []
    for id in range(45):
        own = []
        for _ in range(int(rng.integers(1, 7))):
            x = list(pool[rng.integers(len(pool))]) if rng.random() < 0.7 else line()
            for _ in range(int(rng.integers(0, 4))):
                x[rng.integers(len(x))] = str(rng.choice(vocabulary))
            own.append("\t".join(x) if rng.random() < 0.1 else " ".join(x))
        rows.append((id, "\n".join(own)))
    rows += [(None, rows[3][1]), (7, rows[9][1]), (8, rows[8][1]), (60, ""), (61, None), (62, "\n\n"), (63, "word " * 3000)]
    docs = spark.createDataFrame([(i, t, "clash", 1) for i, t in rows], "doc_id long, text string, line string, removed int")
    expected = sorted(
        (str(i), str(t if not g else "\n".join(x for n, x in enumerate(t.split("\n")) if n not in g)), len(t.split("\n")) if t is not None else 0, len(g))
        for (i, t), g in zip(rows, plain_removed(rows))
    )
    for limit in (line_dedup.BROADCAST_DOCUMENTS, 0):
        monkeypatch.setattr(line_dedup, "BROADCAST_DOCUMENTS", limit)
        found = line_dedup.cleaned(docs).collect()
        assert sorted((str(r.row.doc_id), str(r.new_text), r.n_lines, r.n_removed) for r in found) == expected
    assert line_dedup.cleaned(docs.limit(0)).count() == 0


def test_repeated_lines_of_few_words_go(spark):
    chinese = "\u8fd9\u662f\u4e00\u6bb5\u91cd\u590d\u7684\u6587\u5b57" * 9
    rows = [(1, f"{chinese}\nAll rights\none two three four\n\na b c"), (2, f"{chinese}\nall  RIGHTS\nfive four three two one\n\na b d"), (3, "rights\n \nc b a")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.id: sorted(r.removed) for r in line_dedup.marked(docs).collect()}
    assert found == {2: [0, 1, 2], 3: [2]}
    assert line_dedup.marked(docs, least_words=5).count() == 0


def test_rows_that_share_an_id_keep_their_own_lines(spark):
    # Words whose hashes are of one class of the sketch, so that sketches and places agree where sets differ.
    base = "a b c d e f g h"
    by = defaultdict(list)
    for k in range(400):
        by[xxhash.xxh64_intdigest(f"v{k}".encode(), 42) & 63].append(f"v{k}")
    p, q, r = next(v for v in by.values() if len(v) > 2)[:3]
    rows = [(1, f"{base} {p}"), (1, f"{base} {q}"), (2, f"{base} {p} xx"), (3, f"{base} {q} yy"), (None, f"i j k l m {p}"), (None, f"i j k l m {q}")]
    rows += [(None, f"i j k l m {q}"), (None, None), (4, f"m l k j i {q}"), (5, f"i j k l m {r}"), (6, f"one {r}"), (6, f"one {q}"), (7, f"one {r}\none {q}\none {p}")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = sorted((str(x.row.doc_id), str(x.row.text), x.n_removed) for x in line_dedup.cleaned(docs).collect())
    assert found == sorted((str(i), str(t), len(g)) for (i, t), g in zip(rows, plain_removed(rows)))
    assert sum(n for _, _, n in found) >= 5


def test_large_group_of_near_copies(spark):
    rng = np.random.default_rng(3)
    words = [f"w{k}" for k in range(60)]
    rows = []
    for id in range(300):
        own = list(words)
        for k in rng.choice(60, 4, replace=False):
            own[k] = f"x{id}_{k}"
        rows.append((id, " ".join(own)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.id: sorted(r.removed) for r in line_dedup.marked(docs).collect()}
    assert found == {i: sorted(g) for (i, _), g in zip(rows, plain_removed(rows)) if g}


def test_only_a_to_z_lose_their_case(spark):
    lines = ["Über ALLE Äpfel und Öl", "über alle äpfel UND öl", "ÜBER", "über", "İstanbul ΟΔΟΣ Ⅻ ⓩ", "ǅ x  y", "\t A\r\x0bB \f"]
    found = spark.createDataFrame([(k, x) for k, x in enumerate(lines)], "k long, line string").select(
        "k", line_dedup._words(F.col("line")).alias("words")
    )
    assert {r.k: frozenset(r.words) - {""} for r in found.collect()} == {k: words_of(x) for k, x in enumerate(lines)}


def test_long_lines_of_frequent_words_are_no_candidates(spark):
    rng = np.random.default_rng(12)
    rows = [(id, " ".join(f"w{k}" for k in rng.choice(900, 150, replace=False))) for id in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("doc_id AS doc", "xxhash64(text) AS hash", "text")
    entries = line_dedup._entries(line_dedup._sets(docs).withColumn("sid", F.col("doc")))
    assert entries.count() > 5000
    assert line_dedup._full_candidates(entries, entries).select("b_sid").distinct().count() <= 2


def test_many_changed_documents(spark, monkeypatch):
    rows = [(k, f"line {k % 9} of some\nother {k}") for k in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    monkeypatch.setattr(line_dedup, "BROADCAST_DOCUMENTS", 100)  # 31 documents change: beyond a quarter, below the whole
    found = {r.row.doc_id: r.n_removed for r in line_dedup.cleaned(docs).collect()}
    assert found == {k: int(k >= 9) for k in range(40)}
