import hashlib
import zlib
from collections import defaultdict

import pytest

from tillscope.llm import prefix_trie, queries_trie


def plain_trie(rows):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            digest = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()
            own[conv].append(((turn is not None, turn or 0, digest), (role, text)))
    own = {c: [t for _, t in sorted(v)] for c, v in own.items()}
    members, ends = defaultdict(list), defaultdict(list)
    for c in sorted(own):
        h = zlib.crc32(str(c).encode()) % 6
        base = c - (c % 100 if c >= 0 else -(-c % 100))
        built = tuple(own.get(base, [])[:h] + own[c][h:])
        for d in range(len(built) + 1):
            members[built[:d]].append(c)
        ends[built].append(c)
    children, leaves, saved = defaultdict(int), defaultdict(int), defaultdict(int)
    for s in members:
        if s:
            children[s[:-1]] += 1
    for s, m in members.items():
        for d in range(len(s) + 1):
            leaves[s[:d]] += not children[s]
            saved[s[:d]] += (len(m) - 1) * len(s[-1][1]) if s else 0
    return sorted(
        (m[0], len(s), members[s[:-1]][0] if s else -1, len(m), children[s], leaves[s], saved[s], hashlib.sha256(",".join(map(str, ends[s])).encode()).hexdigest())
        for s, m in members.items()
    )


def found_in(df):
    return sorted(
        (r.conv_id, r.depth, -1 if r.parent_conv_id is None else r.parent_conv_id, r.n_convs, r.n_children, r.n_leaves, r.saved_tokens, r.ends_sha256) for r in df.collect()
    )


def conversations():
    rows = []
    for c in [*range(30), *range(100, 160), 205, 206, 207, 300, 301, -7, -107]:
        for t in range((c * 7) % 9 + 1):
            rows.append((c, t, "user" if t % 2 == 0 else "assistant", f"text {t}" if c % 3 else f"own {c % 5} {t}"))
    rows += [(400, k, "user", f"long {k % 3}") for k in range(700)] + [(401, k, "user", f"long {k % 3}") for k in range(650)]
    rows += [(500, 1, None, None), (500, None, "user", "null first"), (500, None, "user", "null first"), (500, 1, "", ""), (501, 3, "a", "b"), (501, 3, "ab", ""), (501, 3, "", "ab")]
    return rows + [(None, 1, "user", "x"), (502, None, None, None), (502, None, None, None)]


def test_trie_against_brute_force(spark):
    rows = conversations()
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "conv_id long, turn long, role string, text string, depth int, print string").repartition(4)
    assert found_in(prefix_trie.trie(df)) == plain_trie(rows)
    assert prefix_trie.trie(df.limit(0)).count() == 0


def test_another_base_where_fingerprints_agree(spark, monkeypatch):
    rows = conversations()[:60]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    monkeypatch.setattr(prefix_trie, "_BASES", (1, *prefix_trie._BASES))  # with base one, order does not matter
    swapped = [(600, 0, "user", "a"), (600, 1, "user", "b"), (700, 0, "user", "b"), (700, 1, "user", "a")]
    both = df.union(spark.createDataFrame(swapped, df.schema))
    assert found_in(prefix_trie.trie(both)) == plain_trie(rows + swapped)
    monkeypatch.setattr(prefix_trie, "_BASES", (1,))
    with pytest.raises(RuntimeError, match="fingerprints"):
        prefix_trie.trie(both)


def test_registered_query_against_brute_force(spark):
    folder = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert found_in(queries_trie.op13_prefix_trie(spark, folder)) == plain_trie(rows)
