"""Operator 5: document fingerprints as homomorphic multiset hashes of paragraphs.

Every paragraph (a line with words) is hashed to a wide vector, and a document's
fingerprint is the sum of its paragraphs' vectors, lane by lane, modulo a power of two.
So the order of paragraphs does not matter, and a paragraph is inserted or deleted by
adding or subtracting its vector (``edited``), without the rest of the text.

A vector has two parts:

* identity: ``IDENTITY`` lanes of 16 bits, the paragraph's BLAKE2b digest. Equal sums
  mean equal multisets of paragraphs.
* likeness: ``LIKENESS`` lanes of 32 bits, read as signed numbers. Each run of three
  words of the paragraph (all its words if fewer) adds one or minus one to a lane, both
  by hash. Products of such sums estimate how many runs two texts share; likeness is the
  cosine, 1 between two fingerprints without words, 0 if only one has none.

Defined cases: NULL text is empty; a text without words has the zero fingerprint; blank
lines are no paragraphs; an empty table gives no rows. In the order of documents, NULL
doc_id comes last, and rows of equal doc_id stand in the order of a hash of their texts.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import mixed, spans, split_words, table, text_chunks
from .registry import query

IDENTITY, LIKENESS, RUN = 32, 256, 3
_WIDTH = IDENTITY * 2 + LIKENESS * 4


class Fingerprints:
    """Fingerprints of several documents: identity lanes and likeness lanes, a row each."""

    def __init__(self, identity: np.ndarray, likeness: np.ndarray):
        self.identity, self.likeness = identity, likeness

    @staticmethod
    def of(texts: list[bytes]) -> Fingerprints:
        parts = [[p for p in t.split(b"\n") if p and not p.isspace()] for t in texts]
        document = np.repeat(np.arange(len(texts)), [len(p) for p in parts])
        flat = [p for each in parts for p in each]
        digests = b"".join(hashlib.blake2b(p, digest_size=2 * IDENTITY).digest() for p in flat)
        lanes = np.frombuffer(digests, "<u2").reshape(-1, IDENTITY)
        identity = np.zeros((len(texts), IDENTITY), np.uint16)
        np.add.at(identity, document, lanes)
        return Fingerprints(identity, _likeness(flat, document, len(texts)))

    def __add__(self, other: Fingerprints) -> Fingerprints:
        return Fingerprints(self.identity + other.identity, self.likeness + other.likeness)

    def __sub__(self, other: Fingerprints) -> Fingerprints:
        return Fingerprints(self.identity - other.identity, self.likeness - other.likeness)

    def __getitem__(self, rows) -> Fingerprints:
        return Fingerprints(self.identity[rows], self.likeness[rows])

    def joined(self, other: Fingerprints) -> Fingerprints:
        return Fingerprints(
            np.concatenate([self.identity, other.identity]), np.concatenate([self.likeness, other.likeness])
        )

    def strings(self) -> list[str]:
        lanes = [self.identity.astype("<u2").view(np.uint8), self.likeness.astype("<u4").view(np.uint8)]
        return [base64.b64encode(row).decode() for row in np.concatenate(lanes, axis=1)]

    @staticmethod
    def parse(strings: list[str]) -> Fingerprints:
        rows = np.frombuffer(b"".join(map(base64.b64decode, strings)), np.uint8).reshape(-1, _WIDTH)
        cut = IDENTITY * 2
        return Fingerprints(rows[:, :cut].copy().view("<u2"), rows[:, cut:].copy().view("<u4"))

    def like(self, other: Fingerprints) -> np.ndarray:
        a = self.likeness.astype(np.uint32).view(np.int32).astype(np.float64)
        b = other.likeness.astype(np.uint32).view(np.int32).astype(np.float64)
        aa, bb, ab = (a * a).sum(axis=1), (b * b).sum(axis=1), (a * b).sum(axis=1)
        cosine = ab / np.sqrt(np.maximum(aa * bb, 1.0))
        none = self._empty() & other._empty()
        same = (self.identity == other.identity).all(axis=1) & (a == b).all(axis=1)
        return np.where(none | same, 1.0, np.clip(cosine, 0.0, 1.0))

    def _empty(self) -> np.ndarray:
        return ~self.identity.any(axis=1) & ~self.likeness.any(axis=1)


def _likeness(paragraphs: list[bytes], document: np.ndarray, n: int) -> np.ndarray:
    _, lengths, hashes = split_words(pa.array(paragraphs, pa.binary()))
    row, place = spans(lengths)
    left = lengths[row] - place
    # A run of three words, or the only run of a shorter paragraph.
    starts = np.flatnonzero((left >= RUN) | (place == 0))
    run = np.zeros(len(starts), np.uint64)
    with np.errstate(over="ignore"):
        for i in range(RUN):
            there = left[starts] > i
            word = hashes[np.minimum(starts + i, len(hashes) - 1)]
            run += np.where(there, mixed(word + np.uint64(i)), np.uint64(i + 1)) * np.uint64(2 * i + 3)
    run = mixed(run)
    slot = document[row[starts]] * LIKENESS + (run % np.uint64(LIKENESS)).astype(np.int64)
    sign = 1.0 - 2.0 * (run >> np.uint64(63)).astype(np.float64)
    sums = np.bincount(slot, sign, n * LIKENESS).astype(np.int64)
    return sums.reshape(n, LIKENESS).astype(np.uint32)


def edited(own: Fingerprints, old: list[str], new: list[str]) -> Fingerprints:
    """Fingerprints after edits, from those before: changed paragraphs out, their successors in."""
    tails = []
    for before, after, same in zip(old, new, map(_common, old, new)):
        tails.append((before[same:].encode(), after[same:].encode()))
    return own - Fingerprints.of([t[0] for t in tails]) + Fingerprints.of([t[1] for t in tails])


def _common(a: str, b: str) -> int:
    """Where the last paragraph begins before which both texts are the same."""
    low, high = 0, min(len(a), len(b))
    while low < high:
        middle = (low + high + 1) // 2
        if a[low:middle] == b[low:middle]:
            low = middle
        else:
            high = middle - 1
    return a.rfind("\n", 0, low) + 1


def with_next(docs: DataFrame, buckets: int) -> DataFrame:
    """Rows (bucket, copy, doc_id, text) in which each document is followed by the next one.

    In descending order of doc_id. The order is cut into ``buckets`` ranges at quantiles
    of doc_id; the first row of each range is copied to the end of the range before it,
    that of the first to the end of the last. Only the ranges' bounds and first rows, one
    of each per range, are known to the driver.
    """
    keyed = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("tie")
    ).withColumn("k", F.coalesce("doc_id", F.lit(-(2**63))))
    steps = [i / buckets for i in range(1, buckets)]
    bounds = sorted({int(b) for b in keyed.approxQuantile("k", steps, 0.2 / buckets)}, reverse=True)
    above = F.array(*map(F.lit, bounds)) if bounds else F.array().cast("array<bigint>")
    ranged = keyed.withColumn("bucket", F.size(F.filter(above, lambda b: b > F.col("k"))))
    firsts = ranged.groupBy("bucket").agg(F.max(F.struct("k", "tie")).alias("first")).collect()
    firsts = sorted((r.bucket, r.first.k, r.first.tie) for r in firsts)
    places = [(firsts[i - 1][0], k, tie) for i, (_, k, tie) in enumerate(firsts)]
    copies = docs.sparkSession.createDataFrame(places, "bucket int, k long, tie long")
    copied = keyed.join(F.broadcast(copies), ["k", "tie"]).withColumn("copy", F.lit(True))
    columns = ["bucket", "copy", "k", "tie", "doc_id", "text"]
    both = ranged.withColumn("copy", F.lit(False)).select(*columns).union(copied.select(*columns))
    return (
        both.repartition("bucket")
        .sortWithinPartitions("bucket", "copy", F.desc("k"), F.desc("tie"))
        .select("bucket", "copy", "doc_id", "text")
    )


_RESULT = (
    "doc_id long, n_chars long, edited_text string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)


def _fingerprint_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held = None
    for batch in text_chunks(batches):
        rows = list(zip(*(batch.column(c).to_pylist() for c in ("bucket", "copy", "doc_id", "text"))))
        prints = Fingerprints.of([(r[3] or "").encode() for r in rows])
        if held is not None:
            rows, prints = [held[0], *rows], held[1].joined(prints)
        held = (rows[-1], prints[-1:])
        at = [i for i in range(len(rows) - 1) if not rows[i][1]]
        if not at:
            continue
        # The row behind is the next document: copies end every range.
        follows = [i + 1 for i in at]
        old = [rows[i][3] or "" for i in at]
        new = []
        for text, i in zip(old, follows):
            cut = len(text) // 3
            new.append(text[: len(text) - cut] + (rows[i][3] or "")[:cut])
        own = prints[at]
        changed = edited(own, old, new)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([rows[i][2] for i in at], pa.int64()),
                pa.array([len(t) for t in old], pa.int64()),
                pa.array(new, pa.string()),
                pa.array(own.strings()),
                pa.array(changed.strings()),
                pa.array(own.like(changed)),
                pa.array(own.like(prints[follows])),
            ],
            names=[f.split()[0] for f in _RESULT.split(", ")],
        )


def compare_with_next(docs: DataFrame) -> DataFrame:
    """Fingerprints of texts and of their edits by the next document, and their likeness."""
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return with_next(docs, 4 * parts).mapInArrow(_fingerprint_pairs, _RESULT)


@query("op5_multiset_hash")
def op5_multiset_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = compare_with_next(table(spark, sf_dir, "documents"))
    columns = [c for c in found.columns if c != "edited_text"]
    return found.select(*columns, F.sha2("edited_text", 256).alias("edited_sha256"))
