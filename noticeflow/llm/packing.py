"""Operator 8: pack documents into sequences in the order of a space-filling curve.

A document's token ids are counted into a signed hashed vector of ``DIMENSIONS`` entries,
the vector is scaled to length one and projected to ``AXES`` coordinates, and these give
its place on a Hilbert curve. Documents are range-sorted by that place and laid end to
end along the curve, so that a sequence holds texts that resemble each other.

Every range is packed by one task as a stream: a sequence is cut at ``length`` ids, and
the rest of the stream is cut into sequences whose lengths are powers of two, which need
no padding. No padding is left at all.

The ids are computed once and written to the shared folder; sorting starts from there.
Equal texts have one place on the curve, so the range sort goes on by a row number, which
splits any number of copies over tasks.

Defined cases: NULL text is empty and gives the end id alone; equal rows are packed each;
NULL doc_id is carried along; a document longer than a sequence is cut; an empty table
gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import written
from .common import mixed, table, text_chunks
from .registry import query
from .tokens import encoded

DIMENSIONS, AXES, BITS = 64, 4, 15
_TOKENIZED = "row long, doc_id long, place long, n_ids long, ids binary"
_PIECE = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"


def hilbert_keys(points: np.ndarray, bits: int) -> np.ndarray:
    """Places on the Hilbert curve of integer points (rows), ``bits`` per coordinate.

    John Skilling's transform ("Programming the Hilbert curve", 2004), on all points at once.
    """
    x = [c.astype(np.int64) for c in points.T]
    n = len(x)
    q = 1 << (bits - 1)
    while q > 1:
        low = q - 1
        for i in range(n):
            high = (x[i] & q) != 0
            swap = np.where(high, 0, (x[0] ^ x[i]) & low)
            x[0] = np.where(high, x[0] ^ low, x[0] ^ swap)
            x[i] = x[i] ^ swap
        q >>= 1
    for i in range(1, n):
        x[i] = x[i] ^ x[i - 1]
    flip = np.zeros_like(x[0])
    q = 1 << (bits - 1)
    while q > 1:
        flip = np.where((x[n - 1] & q) != 0, flip ^ (q - 1), flip)
        q >>= 1
    x = [c ^ flip for c in x]
    key = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for c in x:
            key = (key << 1) | ((c >> b) & 1)
    return key


def curve_places(ids: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The place on the curve of each document, from flat ids."""
    # Slot and sign depend on the id alone.
    kinds = mixed(np.arange(1, int(ids.max(initial=0)) + 2, dtype=np.uint64))
    slots = (kinds % np.uint64(DIMENSIONS)).astype(np.int64)
    signs = np.where(kinds >> np.uint64(63), -1.0, 1.0)
    at = np.repeat(np.arange(len(lengths)) * DIMENSIONS, lengths)
    at += slots[ids]
    vectors = np.bincount(at, signs[ids], len(lengths) * DIMENSIONS).reshape(-1, DIMENSIONS)
    size = np.linalg.norm(vectors, axis=1, keepdims=True)
    axes = np.random.default_rng(8).normal(size=(DIMENSIONS, AXES))
    spread = vectors / np.maximum(size, 1.0) @ axes
    # Coordinates of random unit vectors are close to normal; four deviations either way.
    cells = np.clip((spread / 8.0 + 0.5) * 2**BITS, 0, 2**BITS - 1).astype(np.int64)
    return hilbert_keys(cells, BITS)


def _tokenize(path: str, cut: str, end_id: int, width: int):
    kind = np.dtype(f"<u{width}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 33
        for batch, ids, lengths in encoded(batches, path, cut):
            ids = np.insert(ids, np.cumsum(lengths), end_id)
            lengths = lengths + 1
            cuts = np.concatenate([[0], np.cumsum(lengths)]) * kind.itemsize
            blobs = pa.BinaryArray.from_buffers(
                pa.binary(),
                batch.num_rows,
                [None, pa.py_buffer(cuts.astype(np.int32)), pa.py_buffer(ids.astype(kind).tobytes())],
            )
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.arange(row, row + batch.num_rows)),
                    batch.column("doc_id"),
                    pa.array(curve_places(ids, lengths)),
                    pa.array(lengths),
                    blobs,
                ],
                names=["row", "doc_id", "place", "n_ids", "ids"],
            )
            row += batch.num_rows

    return run


class _Packer:
    """Cuts a stream of documents into sequences and collects their pieces."""

    def __init__(self, length: int, width: int):
        self.length, self.kind = length, np.dtype(f"<u{width}")
        self.held: list[tuple] = []
        self.filled = 0
        self.sequence = TaskContext.get().partitionId() << 36
        self.out: list[tuple] = []

    def add(self, doc_id: int | None, blob: bytes) -> None:
        ids = np.frombuffer(blob, self.kind).astype("<u4")
        at = 0
        while at < len(ids):
            stop = min(len(ids), at + self.length - self.filled)
            self.held.append((doc_id, at, ids[at:stop], len(ids)))
            self.filled += stop - at
            at = stop
            if self.filled == self.length:
                self._emit(self.held)
                self.held, self.filled = [], 0

    def _emit(self, pieces: list[tuple]) -> None:
        offset = 0
        for doc_id, start, ids, tokens in pieces:
            self.out.append((doc_id, start, len(ids), ids.tobytes(), tokens, self.sequence, offset))
            offset += len(ids)
        self.sequence += 1

    def finish(self) -> None:
        """Cut what is left into sequences of descending powers of two."""
        left = self.held
        while left:
            room, taken, rest = 1 << (self.filled.bit_length() - 1), [], []
            self.filled -= room
            for doc_id, start, ids, tokens in left:
                here = min(room, len(ids))
                if here:
                    taken.append((doc_id, start, ids[:here], tokens))
                if here < len(ids):
                    rest.append((doc_id, start + here, ids[here:], tokens))
                room -= here
            self._emit(taken)
            left = rest
        self.held = []

    def batch(self) -> pa.RecordBatch:
        columns = list(zip(*self.out)) or [()] * len(_PIECE_ARROW)
        self.out = []
        arrays = [pa.array(c, f.type) for c, f in zip(columns, _PIECE_ARROW)]
        return pa.RecordBatch.from_arrays(arrays, schema=_PIECE_ARROW)


_PIECE_ARROW = pa.schema(
    [
        (name, pa.binary() if kind == "binary" else pa.int64())
        for name, kind in (field.split() for field in _PIECE.split(", "))
    ]
)


def _pack(length: int, width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = _Packer(length, width)
        for batch in text_chunks(batches, "ids"):
            for doc_id, blob in zip(batch.column("doc_id").to_pylist(), batch.column("ids").to_pylist()):
                packer.add(doc_id, blob)
            yield packer.batch()
        packer.finish()
        yield packer.batch()

    return run


def pack(
    docs: DataFrame, tokenizer: str, cut: str, end_id: int, vocabulary: int, length: int = 1024
) -> DataFrame:
    """Pieces of the packed sequences, with their ids as unsigned 32-bit little-endian integers."""
    width = 2 if max(vocabulary - 1, end_id) < 2**16 else 4
    source = docs.select(F.col("doc_id").cast("long"), "text")
    encoded = written(source.mapInArrow(_tokenize(tokenizer, cut, end_id, width), _TOKENIZED), "tokens")
    ordered = encoded.repartitionByRange("place", "row").sortWithinPartitions("place", "row")
    return ordered.select("doc_id", "ids").mapInArrow(_pack(length, width), _PIECE)


def pack_documents(docs: DataFrame) -> DataFrame:
    """Packing with the public byte-level vocabulary, as the contract has it."""
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.json")
    pieces = pack(docs, path, "spaced", 0, 50_257)
    return pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


@query("op8_curve_packing")
def op8_curve_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"))
