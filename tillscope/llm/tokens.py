"""Byte-level BPE in batches: each distinct piece of a batch is encoded once.

A position between a visible character and a following ASCII white-space character always starts a new word of the
byte-level pre-tokenizer, whatever stands around it: no alternative of its pattern reaches across such a place, and the
look-ahead concerns white space only. Cutting texts there and encoding the pieces apart gives the ids of the whole.
"""

from __future__ import annotations

import ctypes
import hashlib
import os
import sys
import types
from collections import deque
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa

SLICE_BYTES = 2 << 20


def is_space(data: np.ndarray) -> np.ndarray:
    return (data == 32) | ((data >= 9) & (data <= 13))


def safe_points(data: np.ndarray) -> np.ndarray:
    """Offsets at which UTF-8 text can be cut without changing its ids; ascending, the ends not among them."""
    if len(data) < 2:
        return np.zeros(0, np.int64)
    visible = (data >= 0x21) & (data <= 0x7E)
    # Two-byte characters from U+00C0 on hold no white space.
    visible[1:] |= (data[1:] >= 0x80) & (data[:-1] >= 0xC3) & (data[:-1] <= 0xDF)
    return np.flatnonzero(is_space(data[1:]) & visible[:-1]) + 1


def texts_of(
    column: pa.Array, slice_bytes: int = SLICE_BYTES
) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """Slices of a string column as (bytes, offsets of the texts, index of the first); NULL is empty.

    A slice holds whole texts, and more than ``slice_bytes`` only where one text does.
    """
    column = column.fill_null("") if column.null_count else column
    column = column.cast(pa.large_string())
    if not len(column):
        return
    offsets = np.frombuffer(column.buffers()[1], np.int64)[
        column.offset : column.offset + len(column) + 1
    ]
    held = column.buffers()[2]
    data = np.frombuffer(held, np.uint8) if held is not None and held.size else np.zeros(0, np.uint8)
    first = 0
    while first < len(column):
        last = int(np.searchsorted(offsets, offsets[first] + slice_bytes, "right")) - 1
        last = min(max(last, first + 1), len(column))
        yield data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first], first
        first = last


def give_back() -> None:
    """Returns unused memory of a Python worker, which outlives its task, to the system."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # not glibc
        pass


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices of ranges laid one behind the other."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total) + np.repeat(starts - (ends - lengths), lengths)


class Vocabulary:
    """The bytes of each id."""

    def __init__(self, spec: str):
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_str(spec)
        letters = _byte_letters()
        self.spec = spec
        self.words = [
            b"".join(letters.get(c) or c.encode() for c in tokenizer.id_to_token(i) or "")
            for i in range(tokenizer.get_vocab_size())
        ]
        self.sizes = np.array([len(w) for w in self.words], np.int64)

    def decode(self, ids: np.ndarray) -> str:
        return b"".join(map(self.words.__getitem__, ids.tolist())).decode("utf-8", "replace")


class Codec:
    """Encodes batches of UTF-8 texts, for a byte-level tokenizer."""

    def __init__(self, vocabulary: Vocabulary, remembered: int = 100_000, batches: int = 8):
        """Beyond ``remembered`` pieces only those of the last ``batches`` stay in memory, which changes no result."""
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(vocabulary.spec)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.sizes = vocabulary.sizes
        self.known: dict[bytes, int] = {}
        self.flat = np.zeros(0, np.uint32)
        self.lengths = np.zeros(0, np.int64)
        self.recent: deque[np.ndarray] = deque(maxlen=batches)
        self.remembered = remembered

    def _forget(self) -> None:
        """Keeps the pieces of the latest batches, up to half of what may be remembered."""
        keep, at = np.zeros(len(self.lengths), bool), len(self.recent)
        while at and keep.sum() < self.remembered // 2:
            at -= 1
            keep[self.recent[at]] = True
        if keep.sum() > self.remembered // 2:
            keep[:] = False
        starts = np.cumsum(self.lengths) - self.lengths
        self.flat, self.lengths = self.flat[ragged(starts[keep], self.lengths[keep])], self.lengths[keep]
        place = np.cumsum(keep) - 1
        self.known = {w: int(place[n]) for w, n in self.known.items() if keep[n]}
        self.recent.clear()

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in one array, and the number of ids of each."""
        if not len(data):
            return np.zeros(0, np.uint32), np.zeros(len(offsets) - 1, np.int64)
        # A text's start is a cut too, so no piece reaches into the next text; an empty text has no piece.
        at_cut = np.zeros(len(data) + 1, bool)
        at_cut[safe_points(data)] = True
        at_cut[offsets] = True
        cuts = np.flatnonzero(at_cut)
        pieces = pa.Array.from_buffers(
            pa.large_binary(), len(cuts) - 1, [None, pa.py_buffer(cuts), pa.py_buffer(data)]
        ).dictionary_encode()
        distinct = pieces.dictionary.to_pylist()
        if len(self.known) > self.remembered:
            self._forget()
        self._learn([w for w in distinct if w not in self.known])
        known = np.fromiter(map(self.known.__getitem__, distinct), np.int64, len(distinct))
        self.recent.append(known)
        which = known[pieces.indices.to_numpy()]
        sizes = self.lengths[which]
        starts = (np.cumsum(self.lengths) - self.lengths)[which]
        upto = np.concatenate([[0], np.cumsum(sizes)])
        return self.flat[ragged(starts, sizes)], np.diff(upto[np.searchsorted(cuts, offsets)])

    def _learn(self, words: list[bytes]) -> None:
        """Encodes pieces. Those that meet in safe points are encoded together and parted by size."""
        marks = list(map(_joinable, words))
        joined = list(compress(words, marks))
        apart = [w for w, mark in zip(words, marks) if not mark]
        ids, lengths = [self.flat], [self.lengths]
        for k in range(0, len(joined), 8_000):  # the library takes some hundred bytes a token meanwhile
            some = joined[k : k + 8_000]
            found = self.tokenizer.encode_batch_fast(
                [b"".join(some).decode()], add_special_tokens=False
            )[0].ids
            found = np.array(found, np.uint32)
            ends = np.cumsum(np.fromiter(map(len, some), np.int64, len(some)))
            upto = np.searchsorted(np.cumsum(self.sizes[found]), ends, "right")
            ids.append(found)
            lengths.append(np.diff(upto, prepend=0))
        for k in range(0, len(apart), 5_000):
            some = [w.decode() for w in apart[k : k + 5_000]]
            for e in self.tokenizer.encode_batch_fast(some, add_special_tokens=False):
                ids.append(np.array(e.ids, np.uint32))
                lengths.append(np.array([len(e.ids)], np.int64))
        self.known.update(zip(joined + apart, range(len(self.known), len(self.known) + len(words))))
        self.flat, self.lengths = np.concatenate(ids), np.concatenate(lengths)


def worker_codec(vocabulary: Vocabulary) -> Codec:
    """The codec of this Python worker, which serves its tasks one after the other and keeps what it has learned."""
    held = sys.modules.setdefault("_worker_codec", types.ModuleType("_worker_codec"))
    key = hashlib.blake2b(vocabulary.spec.encode()).digest()
    if getattr(held, "key", None) != key:
        held.codec, held.key = Codec(vocabulary, remembered=600_000), key
    return held.codec


def _joinable(word: bytes) -> bool:
    """Whether the piece starts with white space and ends with a visible character."""
    return (word[0] == 32 or 9 <= word[0] <= 13) and (
        0x21 <= word[-1] <= 0x7E or (word[-1] >= 0x80 and 0xC3 <= word[-2] <= 0xDF)
    )


def _byte_letters() -> dict[str, bytes]:
    """The letter that stands for each byte in byte-level vocabularies.

    Printable Latin-1 bytes stand for themselves; the others get the letters from U+0100 on, in order.
    """
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): bytes([b]) for b in plain} | {
        chr(256 + k): bytes([b]) for k, b in enumerate(others)
    }
