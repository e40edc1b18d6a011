"""Token ids as flat files of unsigned integers, with 64-bit offsets of the documents.

A folder holds, for each part in ascending order of documents,

* ``ids-*``: the ids, little-endian ``uint16`` (``uint32`` for vocabularies of over 65,536),
* ``docs-*``: the document ids, ``int64``; those of NULL come first and are counted in the index,
* ``offsets-*``: ``uint64`` places of the documents among the ids of **all** parts, and the end of the last one,

and ``index.json``, which lists the parts. All files can be memory-mapped. Task attempts write files of their own names;
only those that successful tasks report enter the index, so lost executors leave at most files that nobody reads.

Documents are sorted by id, equal ids by text. NULL and empty texts have the end id alone; an empty table gives an index
without parts. Columns other than id and text are ignored.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .tokens import Vocabulary, give_back, texts_of, worker_codec

_WRITTEN = "part int, ids string, docs string, n_docs long, n_null long, n_tokens long, lengths string"
_PART = "part int, ids string, docs string, lengths string, n_docs long, n_null long, base long, n_tokens long"
_READ_TOKENS = 1 << 20
_SLICE = 6 << 20


def write(docs: DataFrame, folder: str, spec: str, end_id: int, id: str = "doc_id", text: str = "text") -> None:
    """Encodes all documents into files under ``folder``, a URI or path that the whole cluster shares.

    ``spec`` is the JSON of a tokenizer. The driver sees one line per part, never documents.
    """
    spark = docs.sparkSession
    vocabulary = Vocabulary(spec)
    wide = "<u2" if max(len(vocabulary.words), end_id + 1) <= 1 << 16 else "<u4"

    def write_part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        codec, part = None, TaskContext.get().partitionId()
        store, root = pyarrow.fs.FileSystem.from_uri(folder)
        names = {k: f"{k}-{part:06d}-{uuid.uuid4().hex}.bin" for k in ("ids", "docs", "lengths")}
        files, n_docs, n_null, n_tokens = {}, 0, 0, 0
        for batch in batches:
            if not codec:
                codec = worker_codec(vocabulary)
                files = {k: store.open_output_stream(f"{root}/{v}") for k, v in names.items()}
            for data, offsets, first in texts_of(batch.column(1), _SLICE):
                ids, counts = codec.encode(data, offsets)
                ends = np.cumsum(counts)
                files["ids"].write(np.insert(ids, ends, end_id).astype(wide).tobytes())
                files["lengths"].write((counts + 1).astype("<u8").tobytes())
                of = batch.column(0)[first : first + len(counts)]
                files["docs"].write(of.fill_null(0).to_numpy(zero_copy_only=False).astype("<i8").tobytes())
                n_docs, n_null, n_tokens = n_docs + len(of), n_null + of.null_count, n_tokens + len(ids) + len(of)
        for f in files.values():
            f.close()
        if files:
            row = [part, names["ids"], names["docs"], n_docs, n_null, n_tokens, names["lengths"]]
            yield _rows(_WRITTEN, [row])
        del codec
        give_back()

    store, root = pyarrow.fs.FileSystem.from_uri(folder)
    store.create_dir(root, recursive=True)
    ordered = (
        docs.select(F.col(id).cast("long").alias("id"), F.col(text).cast("string").alias("text"))
        .repartitionByRange("id", F.xxhash64("text"))
        .sortWithinPartitions("id", "text")
    )
    parts, base = [], 0
    for r in sorted(ordered.mapInArrow(write_part, _WRITTEN).collect(), key=lambda r: r.part):
        parts.append([r.part, r.ids, r.docs, r.lengths, r.n_docs, r.n_null, base, r.n_tokens])
        base += r.n_tokens

    def write_offsets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = pyarrow.fs.FileSystem.from_uri(folder)
        for batch in batches:
            for r in batch.to_pylist():
                with store.open_input_file(f"{root}/{r['lengths']}") as f:
                    lengths = np.frombuffer(f.read(), "<u8")
                name = f"offsets-{r['part']:06d}-{uuid.uuid4().hex}.bin"
                with store.open_output_stream(f"{root}/{name}") as f:
                    f.write((np.concatenate([[0], np.cumsum(lengths)]) + r["base"]).astype("<u8").tobytes())
                yield _rows("part int, offsets string", [[r["part"], name]])

    named = _spread(spark, parts).mapInArrow(write_offsets, "part int, offsets string").collect()
    offsets = {r.part: r.offsets for r in named}
    listed = [
        {"ids": p[1], "docs": p[2], "offsets": offsets[p[0]], "n_docs": p[4], "n_null": p[5], "base": p[6], "n_tokens": p[7]}
        for p in parts
    ]
    with store.open_output_stream(f"{root}/index.json") as f:
        f.write(json.dumps({"dtype": wide, "parts": listed}).encode())


def read(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, start, n_tokens and ids (little-endian 32-bit, as bytes) of every document, from the files."""
    store, root = pyarrow.fs.FileSystem.from_uri(folder)
    with store.open_input_stream(f"{root}/index.json") as f:
        index = json.loads(f.read())
    wide = index["dtype"]
    schema = "doc_id long, start long, n_tokens long, ids binary"

    def read_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = pyarrow.fs.FileSystem.from_uri(folder)
        for batch in batches:
            for r in batch.to_pylist():
                offsets = _mapped(store, f"{root}/{r['lengths']}", "<u8")
                docs = _mapped(store, f"{root}/{r['docs']}", "<i8")
                ids = _mapped(store, f"{root}/{r['ids']}", wide)
                local = offsets.astype(np.int64) - r["base"]
                first = 0
                while first < len(docs):
                    last = int(np.searchsorted(local, local[first] + _READ_TOKENS, "right")) - 1
                    last = min(max(last, first + 1), len(docs))
                    some = np.asarray(ids[local[first] : local[last]]).astype("<u4")
                    bounds = (local[first : last + 1] - local[first]) * 4
                    held = pa.Array.from_buffers(
                        pa.large_binary(), last - first, [None, pa.py_buffer(bounds), pa.py_buffer(some)]
                    ).cast(pa.binary())
                    null = np.arange(first, last) < r["n_null"]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.array(docs[first:last]), mask=null),
                            pa.array(np.array(offsets[first:last]).astype(np.int64)),
                            pa.array(np.diff(local[first : last + 1])),
                            held,
                        ],
                        names=["doc_id", "start", "n_tokens", "ids"],
                    )
                    first = last

    parts = [
        [k, p["ids"], p["docs"], p["offsets"], p["n_docs"], p["n_null"], p["base"], p["n_tokens"]]
        for k, p in enumerate(index["parts"])
    ]
    return _spread(spark, parts).mapInArrow(read_parts, schema)


def _spread(spark: SparkSession, parts: list[list]) -> DataFrame:
    return spark.createDataFrame(parts, _PART).repartition(max(len(parts), 1))


def _mapped(store: pyarrow.fs.FileSystem, path: str, kind: str) -> np.ndarray:
    """A memory map of a file; in a remote store, its contents."""
    if isinstance(store, pyarrow.fs.LocalFileSystem):
        return np.memmap(path, kind, "r")
    with store.open_input_file(path) as f:
        return np.frombuffer(f.read(), kind)


def _rows(schema: str, rows: list[list]) -> pa.RecordBatch:
    kinds = {"int": pa.int32(), "long": pa.int64(), "string": pa.string()}
    fields = [f.split() for f in schema.split(", ")]
    return pa.RecordBatch.from_arrays(
        [pa.array([r[k] for r in rows], kinds[kind]) for k, (_, kind) in enumerate(fields)],
        names=[name for name, _ in fields],
    )
