"""BPE encoding and decoding that encodes chunks shared between documents only once.

1. A rolling hash over 32 bytes cuts each text into content-defined chunks of about 1 KB, so equal passages give equal
   chunks wherever they stand. Chunks are counted by their 128-bit digests.
2. One document of those that hold a shared chunk encodes it; its ids are joined to all documents that hold it.
   Other chunks are encoded where their document is.
3. Joins are repaired: the words around a join are encoded anew, in a window that grows until its ends agree with token
   ends of the chunks at both sides. What lies between windows is taken from the chunks as it is.

The ids equal those of the whole text. NULL and empty texts have no ids; repeated rows each give a row; rows whose id is
NULL keep it; columns other than id and text are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import saved
from .tokens import Codec, Vocabulary, give_back, ragged, safe_points, texts_of

_WINDOW = 32
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
_MEAN_BITS = 10
_HELD_PER_TASK = 5000
#: Keys of documents that encode shared chunks are broadcast up to this number (16 bytes each).
BROADCAST_OWNERS = 1_000_000
_SLICE_BYTES = 1 << 20
#: Packed texts are taken apart so many bytes at a time.
_PACKED_BYTES = 1 << 18
#: The codec keeps the words of so many of these parts.
_RECENT = 32
#: Texts are hashed so many bytes at a time.
_BLOCK_BYTES = 1 << 17


def encode(
    docs: DataFrame, spec: str, id: str = "doc_id", text: str = "text", decoded: bool = False
) -> DataFrame:
    """doc_id and ids (little-endian unsigned 32-bit, as bytes) of every document.

    With ``decoded`` also the text that the ids give, decoded where they are made.
    ``spec`` is the JSON of a byte-level tokenizer. Texts cross the network once, compressed; ids of shared chunks once
    for each document that holds them.
    """
    vocabulary = Vocabulary(spec)
    docs = docs.select(F.col(id).cast("long").alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    docs = docs.withColumn("key", _row_key())
    chunks = saved(docs.select("key", "text").mapInArrow(_chunk_digests, "key binary, seq int, digest binary"))
    # A chunk held by many documents is dealt over so many tasks.
    salts = F.ceil(F.col("n") / _HELD_PER_TASK).cast("int").alias("salts")
    shared = saved(
        chunks.groupBy("digest")
        .agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("key", "seq")).alias("owner"))
        .filter("n > 1")
        .select("digest", "owner", salts)
    )
    held = chunks.join(shared, "digest").select(
        "key",
        "seq",
        "digest",
        "salts",
        F.pmod(F.xxhash64("key"), F.col("salts")).cast("int").alias("salt"),
        (F.struct("key", "seq") == F.col("owner")).alias("owned"),
    )
    owned = saved(
        held.filter("owned")
        .groupBy("key")
        .agg(F.collect_set(F.struct("seq", "digest", "salts")).alias("owned"))
    )
    owners = docs.select("key", "text")
    if owned.count() <= BROADCAST_OWNERS:  # else all texts are shuffled once more
        owners = owners.join(F.broadcast(owned.select("key")), "key", "left_semi")
    # Texts are not packed here: two steps in Python would run side by side in a task, each in a worker of its own.
    encoded = (
        owners.join(owned, "key")
        .select("text", "owned")
        .mapInArrow(lambda b: _encode_owned(b, vocabulary), "digest binary, ids binary, salts int")
        .dropDuplicates(["digest"])
        .select("digest", "ids", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"))
    )
    given = (
        held.select("key", "seq", "digest", "salt")
        .join(encoded, ["digest", "salt"])
        .groupBy("key")
        .agg(F.collect_set(F.struct("seq", "ids")).alias("given"))
    )
    packed = docs.mapInArrow(_packed, "doc_id long, key binary, packed binary")
    return (
        packed.join(given, "key", "left")
        .select("doc_id", "packed", "given")
        .mapInArrow(
            lambda b: _assembled(b, vocabulary, decoded),
            "doc_id long, ids binary" + ", decoded string" * decoded,
        )
    )


def decode(encoded: DataFrame, spec: str) -> DataFrame:
    """doc_id, ids and decoded, the text of the ids."""

    vocabulary = Vocabulary(spec)

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some in _slices(batch, 1):
                decoded = [vocabulary.decode(np.frombuffer(x.as_buffer(), "<u4")) for x in some.column(1)]
                yield pa.RecordBatch.from_arrays(
                    [*some.columns, pa.array(decoded, pa.string())], names=["doc_id", "ids", "decoded"]
                )

    return encoded.select("doc_id", "ids").mapInArrow(texts, "doc_id long, ids binary, decoded string")


def chunk_cuts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Offsets at which chunks start, in a buffer of texts; whether there is a cut depends on the 32 bytes before it."""
    starts = np.unique(offsets[:-1])
    if len(data) <= _WINDOW:
        return starts
    # In blocks that overlap by a window, as the numbers take eight bytes for each byte of text.
    blocks = range(0, len(data) - _WINDOW, _BLOCK_BYTES)
    places = np.concatenate([_rolling_cuts(data[a : a + _BLOCK_BYTES + _WINDOW - 1]) + a for a in blocks])
    places = places[places < len(data)]
    places = places[(data[places] & 0xC0) != 0x80]  # whole characters
    begun = offsets[np.searchsorted(offsets, places, "right") - 1]
    return np.union1d(starts, places[places - begun >= _WINDOW])


def _rolling_cuts(data: np.ndarray) -> np.ndarray:
    """Ends of the windows whose hash asks for a cut."""
    rolling, width, factor = (data.astype(np.uint64) + np.uint64(1)) * _MULTIPLIER, 1, _MULTIPLIER
    with np.errstate(over="ignore"):
        while width < _WINDOW:
            rolling = rolling[:-width] * factor + rolling[width:]
            width, factor = width * 2, factor * factor
        return np.flatnonzero((rolling >> np.uint64(64 - _MEAN_BITS)) == 0) + _WINDOW


def _key(of: int | None, data: np.ndarray) -> bytes:
    """Digest of bytes, apart for each id."""
    return hashlib.blake2b(data, digest_size=16, key=b"" if of is None else b"%d" % of).digest()


def _row_key() -> Column:
    """Rows that agree in id and text share it, and have the same result."""
    own = F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.col("text"))
    return F.substring(F.unhex(F.sha2(own, 256)), 1, 16)


def _chunk_digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for data, offsets, first in texts_of(batch.column(1), _SLICE_BYTES):
            cuts = np.union1d(chunk_cuts(data, offsets), offsets)
            counts = np.diff(np.searchsorted(cuts, offsets))
            of = first + np.repeat(np.arange(len(counts)), counts)
            seqs = ragged(np.zeros(len(counts), np.int64), counts)
            digests = [_key(None, data[a:b]) for a, b in zip(cuts[:-1], cuts[1:])]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(of)), pa.array(seqs, pa.int32()), pa.array(digests, pa.binary())],
                names=["key", "seq", "digest"],
            )
    give_back()


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    import zstandard

    pack = zstandard.ZstdCompressor(level=3).compress
    for batch in batches:
        for data, offsets, first in texts_of(batch.column(1), _SLICE_BYTES):
            some = batch.slice(first, len(offsets) - 1)
            texts = [pack(data[a:b].tobytes()) for a, b in zip(offsets[:-1], offsets[1:])]
            yield pa.RecordBatch.from_arrays(
                [some.column(0), some.column(2), pa.array(texts, pa.binary())], names=["doc_id", "key", "packed"]
            )
    give_back()


def _slices(batch: pa.RecordBatch, column: int) -> Iterator[pa.RecordBatch]:
    """The batch in parts of about ``_PACKED_BYTES`` of the given binary column."""
    upto = np.cumsum(pc.binary_length(batch.column(column)).to_numpy())
    first = 0
    while first < batch.num_rows:
        before = upto[first - 1] if first else 0
        last = max(int(np.searchsorted(upto, before + _PACKED_BYTES, "right")), first + 1)
        yield batch.slice(first, last - first)
        first = last


def _unpacked(packed: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes of all texts, their offsets, and all chunk starts with the end."""
    import zstandard

    unpack = zstandard.ZstdDecompressor().decompress
    texts = [unpack(x) for x in packed]
    offsets = np.concatenate([[0], np.cumsum([len(x) for x in texts])]).astype(np.int64)
    data = np.frombuffer(b"".join(texts), np.uint8)
    return data, offsets, np.union1d(chunk_cuts(data, offsets), offsets)


def _encode_owned(batches: Iterator[pa.RecordBatch], vocabulary: Vocabulary) -> Iterator[pa.RecordBatch]:
    import zstandard

    codec, pack = None, zstandard.ZstdCompressor(level=1).compress
    for batch in batches:
        codec = codec or Codec(vocabulary, batches=_RECENT)
        for data, offsets, first in texts_of(batch.column(0), _SLICE_BYTES):
            cuts = np.union1d(chunk_cuts(data, offsets), offsets)
            places = np.searchsorted(cuts, offsets)
            digests, spans, salts = [], [], []
            for place, own in zip(places, batch.column(1).slice(first, len(offsets) - 1).to_pylist()):
                for x in own:
                    c = place + x["seq"]
                    digests.append(x["digest"])
                    salts.append(x["salts"])
                    spans.append(data[cuts[c] : cuts[c + 1]])
            ids = _encode_spans(codec, spans)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(digests, pa.binary()),
                    pa.array([pack(x.astype("<u4").tobytes()) for x in ids], pa.binary()),
                    pa.array(salts, pa.int32()),
                ],
                names=["digest", "ids", "salts"],
            )
    del codec
    give_back()


def _encode_spans(codec: Codec, spans: list[np.ndarray]) -> list[np.ndarray]:
    if not spans:
        return []
    offsets = np.concatenate([[0], np.cumsum([len(s) for s in spans])]).astype(np.int64)
    ids, counts = codec.encode(np.concatenate(spans), offsets)
    return np.split(ids, np.cumsum(counts)[:-1])


def _assembled(
    batches: Iterator[pa.RecordBatch], vocabulary: Vocabulary, decoded: bool
) -> Iterator[pa.RecordBatch]:
    import zstandard

    codec, unpack = None, zstandard.ZstdDecompressor().decompress
    for batch in batches:
        codec = codec or Codec(vocabulary, batches=_RECENT)
        for some in _slices(batch, 1):
            rows = some.to_pylist()
            data, offsets, cuts = _unpacked([r["packed"] for r in rows])
            places = np.searchsorted(cuts, offsets)
            chunks: list[np.ndarray | None] = [None] * (len(cuts) - 1)
            for i, r in enumerate(rows):
                for x in r["given"] or []:
                    chunks[places[i] + x["seq"]] = np.frombuffer(unpack(x["ids"]), "<u4")
            own = [c for c, ids in enumerate(chunks) if ids is None]
            for c, ids in zip(own, _encode_spans(codec, [data[cuts[c] : cuts[c + 1]] for c in own])):
                chunks[c] = ids
            found = _joined(codec, data, offsets, cuts, places, chunks)
            columns = {
                "doc_id": pa.array([r["doc_id"] for r in rows], pa.int64()),
                "ids": pa.array(found, pa.binary()),
            }
            if decoded:
                texts = [vocabulary.decode(np.frombuffer(x, "<u4")) for x in found]
                columns["decoded"] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_pydict(columns)
            del rows, data, chunks, found, columns
    del codec
    give_back()


def _joined(codec, data, offsets, cuts, places, chunks) -> list[bytes]:
    """Ids of each document, from those of its chunks."""
    safe = safe_points(data)
    plans, windows = [], []
    for i in range(len(offsets) - 1):
        a, b = offsets[i], offsets[i + 1]
        plan, at = [], a  # pieces: a chunk's range of ids, or the number of a window
        for c in range(places[i], places[i + 1]):
            start, end = cuts[c], cuts[c + 1]
            if at >= end:  # the window before reaches past this chunk
                continue
            ends = np.concatenate([[0], np.cumsum(codec.sizes[chunks[c]])]) + start
            low = int(np.searchsorted(ends, at))
            if ends[low] != at:  # no token of the chunk starts where the window ends: the window grows
                later = safe[np.searchsorted(safe, at, "right") :]
                at = next((int(s) for s in later if s >= end or s in ends), b)
                windows[-1][1] = min(at, b)
                at = windows[-1][1]
                if at >= end:
                    continue
                low = int(np.searchsorted(ends, at))
            if end == b:
                plan.append((c, low, len(chunks[c])))
                at = b
                continue
            k = int(np.searchsorted(safe, end, "right")) - 1
            while k >= 0 and safe[k] > at and ends[np.searchsorted(ends, safe[k])] != safe[k]:
                k -= 1
            left = int(safe[k]) if k >= 0 and safe[k] > at else int(at)
            if left > at:
                plan.append((c, low, int(np.searchsorted(ends, left))))
            k = int(np.searchsorted(safe, end))
            right = min(int(safe[k]) if k < len(safe) else b, b)
            if left == at and windows and plan and plan[-1][0] == -1 and windows[-1][1] == left:
                windows[-1][1] = right  # two joins in one word: one window
            elif right > left:
                windows.append([left, right])
                plan.append((-1, len(windows) - 1, 0))
            at = right
        plans.append(plan)
    ids = _encode_spans(codec, [data[a:b] for a, b in windows])
    return [
        b"".join((ids[x] if c < 0 else chunks[c][x:y]).astype("<u4").tobytes() for c, x, y in plan)
        for plan in plans
    ]
