"""What the text operators share: words, byte-bounded batches, stable row order."""

from __future__ import annotations

import contextlib
import ctypes
import gc
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A word is a run of anything but these: blank, tab, line feed, vertical tab, form feed, return.
WORD = r"[^\x20\x09-\x0D]+"

CHUNK_BYTES = 2 << 20


def table(spark, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def unused(name: str, columns: list[str]) -> str:
    """A column name like ``name`` that a table does not have."""
    while name.lower() in (c.lower() for c in columns):
        name += "_"
    return name


def crc_mod(column: str, divisor: int) -> Column:
    """crc32 of a value's text form modulo ``divisor``; -1 for NULL."""
    digest = F.crc32(F.col(column).cast("string").cast("binary"))
    return F.coalesce(F.pmod(digest, F.lit(divisor)), F.lit(-1)).cast("int")


def give_back() -> None:
    """Return unused memory of this worker process, which serves other operators later."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # not all systems' C libraries have it
        ctypes.CDLL(None).malloc_trim(0)


def text_chunks(
    batches: Iterable[pa.RecordBatch], column: str = "text", limit: int = CHUNK_BYTES
) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that a piece holds at most ``limit`` bytes of a column.

    A single longer value stays whole, in a piece of its own. Before the first and after
    the last piece the process gives back what it does not use.
    """
    give_back()
    for batch in batches:
        if batch.num_rows == 0:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0)
        ends = np.cumsum(sizes.to_numpy(zero_copy_only=False).astype(np.int64))
        start = 0
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            stop = int(np.searchsorted(ends, before + limit, side="right"))
            stop = max(stop, start + 1)
            yield batch.slice(start, stop - start)
            start = stop
        del batch
    give_back()


def texts(batch: pa.RecordBatch, column: str = "text") -> list[bytes]:
    """The UTF-8 bytes of a text column; NULL is empty."""
    values = batch.column(column).cast(pa.large_binary()).to_pylist()
    return [v or b"" for v in values]


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective mix of unsigned 64-bit integers (the finaliser of splitmix64)."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_TABLE = np.random.default_rng(64).integers(0, 2**63, 256, np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_POWERS: list[np.ndarray] = []
_AT_ONCE = 1 << 16


def _powers(n: int) -> list[np.ndarray]:
    """Powers 0 to n-1 of an odd number and of its inverse modulo 2**64, short tables kept."""
    if _POWERS and len(_POWERS[0]) >= n:
        return [p[:n] for p in _POWERS]
    tables = []
    for base in (_BASE, pow(_BASE, -1, 2**64)):
        factors = np.full(n, np.uint64(base))
        factors[0] = 1
        with np.errstate(over="ignore"):
            tables.append(np.cumprod(factors))
    if n <= 2 * _AT_ONCE:
        _POWERS[:] = tables
    return tables


def byte_sums(data: np.ndarray) -> np.ndarray:
    """Running sums of a polynomial over random table values of the bytes."""
    sums = np.zeros(len(data) + 1, np.uint64)
    values = _TABLE[data]
    with np.errstate(over="ignore"):
        values *= _powers(len(data) + 1)[0][: len(data)]
        np.cumsum(values, out=sums[1:])
    return sums


def inverse_powers(sums: np.ndarray) -> np.ndarray:
    """What ``range_hashes`` needs of the length of running sums, for callers that ask often."""
    return _powers(len(sums))[1]


def range_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray, inverse: np.ndarray | None = None) -> np.ndarray:
    """64-bit hashes of the byte strings from ``starts`` to ``ends``, from running sums."""
    inverse = inverse_powers(sums) if inverse is None else inverse
    with np.errstate(over="ignore"):
        return mixed((sums[ends] - sums[starts]) * inverse[starts] + (ends - starts).astype(np.uint64))


def byte_hashes(data: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of byte strings that lie end to end in ``data``; they end at ``ends``.

    Some strings at a time, with powers up to the longest of them. An empty string's hash is
    that of its length alone.
    """
    starts = np.concatenate([[0], ends[:-1]])[: len(ends)]
    out = np.zeros(len(ends), np.uint64)
    at = 0
    while at < len(ends):
        stop = max(at + 1, int(np.searchsorted(ends, starts[at] + _AT_ONCE, side="right")))
        begins, lengths = starts[at:stop], ends[at:stop] - starts[at:stop]
        row, place = spans(lengths)
        with np.errstate(over="ignore"):
            values = _TABLE[data[begins[0] : ends[stop - 1]]] * _powers(int(lengths.max()) + 1)[0][place]
            some = lengths > 0
            sums = out[at:stop]
            if len(row):
                sums[some] = np.add.reduceat(values, np.flatnonzero(place == 0))
            out[at:stop] = mixed(sums + lengths.astype(np.uint64))
        at = stop
    return out


def split_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Words of all texts end to end, the number of words of each, and the words' hashes."""
    lists = pc.ascii_split_whitespace(pc.fill_null(texts.cast(pa.large_string()), ""))
    pieces = lists.flatten()
    full = pc.not_equal(pieces, "")
    filled = np.concatenate([[0], np.cumsum(full.to_numpy(zero_copy_only=False))])
    ends = np.cumsum(lists.value_lengths().to_numpy())
    counts = np.diff(filled[np.concatenate([[0], ends])])
    words = pieces.filter(full)
    _, offsets, data = words.buffers()
    offsets = np.frombuffer(offsets or b"", np.int64)[words.offset : words.offset + len(words) + 1]
    if not len(words):
        return words, counts, np.zeros(0, np.uint64)
    data = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]]
    return words, counts, byte_hashes(data, offsets[1:] - offsets[0])


def spans(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row number and position within the row of each element of rows of given lengths."""
    lengths = lengths.astype(np.int64)
    row = np.repeat(np.arange(len(lengths)), lengths)
    first = np.repeat(np.cumsum(lengths) - lengths, lengths)
    return row, np.arange(len(row)) - first
