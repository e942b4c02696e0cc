"""Operator 10: token ids as flat unsigned integer files with 64-bit document offsets.

Layout of a token folder, written by ``write_token_files``:

* ``<shard>.bin``: the ids of the shard's documents, end to end, unsigned little-endian
  integers of the width in the manifest (2 bytes where the vocabulary allows it, else 4);
* ``<shard>.off``: unsigned little-endian 64-bit offsets into the shard, one more than it
  has documents, counted in ids;
* ``<shard>.doc``: the signed 64-bit document ids;
* ``manifest.json``: the shards in ascending document order, each with its base: the ids
  of all shards before it, a prefix sum over the shards. A document's place in the whole
  is the base plus its offset.

Documents are range-partitioned by id, so a shard is one task's slice of the order, and
only one row per shard reaches the driver. A task writes under a name of its own and only
the names that finished tasks report enter the manifest, so a task that is run again does
no harm. Readers map the files into memory where they are local.

Defined cases: NULL text is empty and gives the end id alone; rows without doc_id come
first and are stored as -2**63; equal doc_ids stand in the order of their texts; an empty
table gives an empty manifest and no rows; other columns are ignored.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shared_dir
from .common import table
from .registry import query
from .tokens import encoded

NO_ID = -(2**63)
_SHARD = "part int, shard string, documents long, tokens long"
_BASED = _SHARD + ", base long, width int"
_DOCUMENT = "doc_id long, start long, n_tokens long, ids binary"


def _write_shard(folder: str, path: str, cut: str, end_id: int, width: int):
    kind = np.dtype(f"<u{width}")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = fs.FileSystem.from_uri(folder)
        shard, out, doc_ids, sizes = uuid.uuid4().hex, None, [], []
        for batch, ids, lengths in encoded(batches, path, cut):
            if out is None:
                out = store.open_output_stream(f"{root}/{shard}.bin")
            ends = np.cumsum(lengths)
            out.write(np.insert(ids, ends, end_id).astype(kind).tobytes())
            sizes.append(lengths + 1)
            doc_ids.append(batch.column("doc_id").fill_null(NO_ID).to_numpy().astype("<i8"))
        if out is None:
            return
        out.close()
        offsets = np.concatenate([[0], np.cumsum(np.concatenate(sizes))]).astype("<u8")
        ids_of_documents = np.concatenate(doc_ids)
        for name, values in (("off", offsets), ("doc", ids_of_documents)):
            with store.open_output_stream(f"{root}/{shard}.{name}") as file:
                file.write(values.tobytes())
        part = TaskContext.get().partitionId()
        row = {"part": part, "shard": shard, "documents": len(ids_of_documents), "tokens": int(offsets[-1])}
        yield pa.RecordBatch.from_pylist([row], schema=_SHARD_ARROW)

    return write


_SHARD_ARROW = pa.schema(
    [("part", pa.int32()), ("shard", pa.string()), ("documents", pa.int64()), ("tokens", pa.int64())]
)


def _qualified(folder: str) -> str:
    return folder if "://" in folder or folder.startswith("file:") else f"file://{folder}"


def write_token_files(
    docs: DataFrame, folder: str, tokenizer: str, cut: str, end_id: int, vocabulary: int
) -> list[dict]:
    """Encode every text, append ``end_id``, write the folder; returns the manifest's shards."""
    folder = _qualified(folder)
    width = 2 if max(vocabulary - 1, end_id) < 2**16 else 4
    store, root = fs.FileSystem.from_uri(folder)
    store.create_dir(root, recursive=True)
    ordered = (
        docs.select(F.col("doc_id").cast("long"), "text")
        .repartitionByRange("doc_id")
        .sortWithinPartitions("doc_id", "text")
    )
    wrote = ordered.mapInArrow(_write_shard(folder, tokenizer, cut, end_id, width), _SHARD)
    shards = [r.asDict() for r in sorted(wrote.collect(), key=lambda r: r.part)]
    base = 0
    for shard in shards:
        shard |= {"base": base, "width": width}
        base += shard["tokens"]
    with store.open_output_stream(f"{root}/manifest.json") as file:
        file.write(json.dumps({"end_id": end_id, "shards": shards}).encode())
    return shards


def _mapped(store: fs.FileSystem, path: str, kind: str) -> np.ndarray:
    if isinstance(store, fs.LocalFileSystem):
        return np.memmap(path, dtype=kind, mode="r")
    with store.open_input_file(path) as file:
        return np.frombuffer(file.read(), dtype=kind)


def _read_shards(folder: str):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = fs.FileSystem.from_uri(folder)
        for shard in (r for batch in batches for r in batch.to_pylist()):
            name = f"{root}/{shard['shard']}"
            ids = _mapped(store, f"{name}.bin", f"<u{shard['width']}")
            offsets = _mapped(store, f"{name}.off", "<u8").astype(np.int64)
            doc_ids = _mapped(store, f"{name}.doc", "<i8")
            at = 0
            while at < len(doc_ids):
                stop = int(np.searchsorted(offsets, offsets[at] + (1 << 20), side="right")) - 1
                stop = min(max(stop, at + 1), len(doc_ids))
                values = ids[offsets[at] : offsets[stop]].astype("<u4").tobytes()
                cuts = ((offsets[at : stop + 1] - offsets[at]) * 4).astype(np.int32)
                blobs = pa.BinaryArray.from_buffers(
                    pa.binary(), stop - at, [None, pa.py_buffer(cuts), pa.py_buffer(values)]
                )
                part = np.array(doc_ids[at:stop])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(part, pa.int64(), mask=part == NO_ID),
                        pa.array(offsets[at:stop] + shard["base"], pa.int64()),
                        pa.array(np.diff(offsets[at : stop + 1]), pa.int64()),
                        blobs,
                    ],
                    names=["doc_id", "start", "n_tokens", "ids"],
                )
                at = stop

    return read


def read_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """The documents of a token folder: place, length and ids (unsigned 32-bit, little-endian)."""
    folder = _qualified(folder)
    store, root = fs.FileSystem.from_uri(folder)
    with store.open_input_file(f"{root}/manifest.json") as file:
        shards = json.loads(file.read())["shards"]
    frame = spark.createDataFrame(shards, _BASED)
    if shards:
        frame = frame.repartitionByRange(len(shards), "part")
    return frame.mapInArrow(_read_shards(folder), _DOCUMENT)


@query("op10_token_files")
def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    folder = shared_dir(spark, "token-files")
    path = public_tokenizers.path("word_bpe_49k.json")
    write_token_files(table(spark, sf_dir, "documents"), folder, path, "words", 2, 49_408)
    documents = read_token_files(spark, folder)
    return documents.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
