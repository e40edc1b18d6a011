import hashlib
import tracemalloc
import zlib

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from tillscope.llm import bpe, queries_tokens, token_files, tokens
from tillscope.llm.common import tokenizer_path, workspace
from tillscope.llm.tokens import Codec, Vocabulary, texts_of

ODD = [
    "", " ", "  a", "a  b\n\n c", "x　 y", "é  è   z", "<|endoftext|>", "a <|endoftext|> b<|endoftext|>  c",
    "it's  'll", "\x1c \x1d", "\x85 x", "日本 語  あ", "a\xa0 b", "\t\tfoo\r\n\r\nbar ", "🙂 🙂  x", "ß́ ß", "\x00", "<|endof text|>",
]


@pytest.fixture(scope="module")
def spec():
    with open(tokenizer_path(), encoding="utf-8") as f:
        return f.read()


@pytest.fixture(scope="module")
def library(spec):
    return Tokenizer.from_str(spec)


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(3)
    words = ["the", "Grüße", "erwhou", "2024", "!!", "naïve", "<|endoftext|>", "\n", "\n\n", "  ", "don't", "日本語", "x" * 50]
    passage = " ".join(rng.choice(words, 900))
    texts = [*ODD, None]
    texts += [" ".join(rng.choice(words, n)) for n in (5, 300, 2000)]
    texts += [passage, passage, "A" + passage, passage[:700] + "?" + passage[700:], "".join(rng.choice(words, 500)) + passage]
    texts += ["a" * 9000, "é" * 5000, " " * 4000, "<|endoftext|>" * 400, passage * 9]
    out = [(k * 7 % 101, t, "clash", b"k") for k, t in enumerate(texts)]
    return out + [(None, passage, "clash", b"k"), (None, None, "clash", b"k"), out[-1], out[25]]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, ids string, key binary")


def test_batches_encode_like_the_library(spec, library):
    codec, vocabulary, found = Codec(Vocabulary(spec)), Vocabulary(spec), []
    for _ in range(2):
        found = []
        for data, offsets, _ in texts_of(pa.array([*ODD, None])):
            ids, counts = codec.encode(data, offsets)
            found += np.split(ids, np.cumsum(counts)[:-1])
    for ids, text in zip(found, [*ODD, ""]):
        expected = library.encode(text, add_special_tokens=False).ids
        assert ids.tolist() == expected, repr(text)
        assert vocabulary.decode(ids) == library.decode(expected, skip_special_tokens=False)


def test_codec_that_forgets_gives_the_same_ids(spec):
    rng = np.random.default_rng(8)
    texts = [" ".join(f"w{k}" for k in rng.integers(0, 400, 300)) for _ in range(30)]
    steady, short = Codec(Vocabulary(spec)), Codec(Vocabulary(spec), remembered=250)
    for text in texts:
        (data, offsets, _), = texts_of(pa.array([text, ""]))
        assert [a.tolist() for a in short.encode(data, offsets)] == [a.tolist() for a in steady.encode(data, offsets)]
    assert len(short.known) < 400 and len(short.known) == len(short.lengths)


def test_chunks_give_the_ids_of_whole_texts(spec, library, docs, rows):
    found = bpe.encode(docs, spec, decoded=True).collect()
    key = lambda id, ids, text: (id is None, id or 0, ids, text)
    expected = []
    for id, text, *_ in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids
        expected.append(key(id, np.array(ids, "<u4").tobytes(), library.decode(ids, skip_special_tokens=False)))
    assert sorted(key(r.doc_id, bytes(r.ids), r.decoded) for r in found) == sorted(expected)
    decoded = bpe.decode(bpe.encode(docs, spec), spec).collect()
    assert sorted(key(r.doc_id, bytes(r.ids), r.decoded) for r in decoded) == sorted(expected)


def test_chunks_without_broadcast_owners(spec, docs, monkeypatch):
    expected = sorted(bytes(r.ids) for r in bpe.encode(docs, spec).collect())
    monkeypatch.setattr(bpe, "BROADCAST_OWNERS", 0)
    monkeypatch.setattr(bpe, "_HELD_PER_TASK", 1)
    assert sorted(bytes(r.ids) for r in bpe.encode(docs, spec).collect()) == expected


def test_files_hold_all_documents_in_order(spark, spec, library, docs, rows):
    folder = workspace(spark)
    token_files.write(docs, folder, spec, end_id=2)
    found = sorted(token_files.read(spark, folder).collect(), key=lambda r: r.start)
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, (r[1] or "").encode()))
    start = 0
    for r, (id, text, *_) in zip(found, order, strict=True):
        ids = np.array(library.encode(text or "", add_special_tokens=False).ids + [2], "<u4")
        assert (r.doc_id, r.start, r.n_tokens, zlib.crc32(r.ids)) == (id, start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)


def test_empty_tables(spark, spec):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert bpe.encode(none, spec).count() == 0
    folder = workspace(spark)
    token_files.write(none, folder, spec, end_id=2)
    assert token_files.read(spark, folder).count() == 0


def test_chunk_keys_tell_ids_apart():
    data = np.frombuffer(b"text", np.uint8)
    assert len({bpe._key(1, data), bpe._key(2, data), bpe._key(None, data)}) == 3
    assert hashlib.blake2b(b"text", digest_size=16).digest() == bpe._key(None, data)


def test_rows_of_other_ids_or_texts_have_other_keys(spark):
    rows = [(1, "text"), (2, "text"), (None, "text"), (1, "1:text"), (11, "text"), (None, "1:text"), (-1, "text")]
    docs = spark.createDataFrame([*rows, *rows], "doc_id long, text string")
    keys = docs.select(bpe._row_key().alias("key")).groupBy("key").count().collect()
    assert [(len(r.key), r["count"]) for r in keys] == [(16, 2)] * len(rows)


def test_chunk_cuts_take_little_memory_and_are_the_same_in_blocks(monkeypatch):
    data = np.random.default_rng(5).integers(32, 127, 4_000_000).astype(np.uint8)
    offsets = np.array([0, 10, 1_500_000, len(data)])
    tracemalloc.start()
    cuts = bpe.chunk_cuts(data, offsets)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 3 * len(data)
    for size in (1 << 30, 1000, 33):
        monkeypatch.setattr(bpe, "_BLOCK_BYTES", size)
        assert bpe.chunk_cuts(data[:300_000], np.array([0, 10, 300_000])).tolist() == [c for c in cuts if c < 300_000]


def test_one_python_step_in_a_stage(spark, spec):
    """Two would run side by side, each in a worker of its own, which doubles the memory of an executor's workers."""
    passage = " ".join(f"word{k}" for k in range(2000))
    docs = spark.createDataFrame([(k, f"{passage} {k}") for k in range(4)], "doc_id long, text string")
    encoded = bpe.encode(docs, spec)
    depth = lambda line: len(line) - len(line.lstrip(" :+-|"))
    above = []  # depths of steps in Python with no exchange below them so far
    for line in encoded._jdf.queryExecution().sparkPlan().toString().split("\n"):
        above = [d for d in above if d < depth(line)]
        if "MapInArrow" in line:
            assert not above
            above.append(depth(line))
        elif "SortMergeJoin" in line or "Exchange" in line or "Aggregate" in line:
            above = []
    assert encoded.count() == 4


def test_registered_queries_against_the_library(spark, library):
    folder = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    ids = {i: library.encode(t, add_special_tokens=False).ids for i, t in texts.items()}
    digest = lambda data: hashlib.sha256(data).hexdigest()
    found = {r.doc_id: r for r in queries_tokens.op1_bpe_encoding(spark, folder).collect()}
    assert {i: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for i, r in found.items()} == {
        i: (len(x), digest(np.array(x, "<u4").tobytes()), digest(library.decode(x, skip_special_tokens=False).encode())) for i, x in ids.items()
    }
    start, expected = 0, {}
    for i in sorted(ids):
        x = [*ids[i], queries_tokens.END_ID]
        expected[i] = (start, len(x), zlib.crc32(np.array(x, "<u4").tobytes()))
        start += len(x)
    assert {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in queries_tokens.op6_token_files(spark, folder).collect()} == expected


def test_learning_looks_at_each_piece_once(spec, library, monkeypatch):
    seen, looked = [], tokens._joinable
    monkeypatch.setattr(tokens, "_joinable", lambda w: seen.append(w) or looked(w))
    codec, text = Codec(Vocabulary(spec)), "a b  c\n日本 語 it's a b"
    (data, offsets, _), = texts_of(pa.array([text, text]))
    ids, counts = codec.encode(data, offsets)
    assert ids.tolist() == library.encode(text, add_special_tokens=False).ids * 2 and counts[0] == counts[1]
    assert len(seen) == len(set(seen)) == len(codec.known)
