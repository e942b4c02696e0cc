"""Operator 2: SimHash fingerprints and their near-duplicate groups.

A fingerprint has a bit where over half of the XXH64 values of a text's word shingles
have it. Two fingerprints link at ``limit`` or fewer differing bits; a group is what links
connect, and a group's name is its smallest doc_id.

Only distinct fingerprints are compared. They are laid out ``limit + 1`` times, each time
rotated so that another band of bits leads; two codes within the limit agree in one band
at least, so they meet in that layout's group of equal leading bits, which is also a run
of the Gray order. Each group is searched by the index over its Gray order
(``gray_index``). A group of more than ``BLOCK`` codes is dealt into blocks by hash and
each pair of blocks is a unit of its own, so one band value may hold any share of the
codes. A unit hands on a spanning forest of its links, never all pairs; the forests are
joined by rounds of star contraction (``components``).

Defined cases: NULL and empty texts have no words and the fingerprint zero, linked like
any other; fewer words than a shingle are one shingle; rows of equal doc_id are rows of
their own; a NULL doc_id names no group, so a group of NULLs alone has a NULL name;
an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import written
from .common import table, text_chunks, texts, unused
from .components import components
from .gray_index import forest, linked
from .registry import query

SEED = 42
BLOCK = 4096
_AT_ONCE = 1 << 16


def fingerprint(text: bytes, words: int) -> int:
    parts = text.lower().split()
    if not parts:
        return 0
    joined = b" ".join(parts)
    ends = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    if len(parts) < words:
        starts, ends = starts[:1], ends[-1:]
    else:
        starts, ends = starts[: len(parts) - words + 1], ends[words - 1 :]
    counts = np.zeros(64, np.int64)
    for at in range(0, len(starts), _AT_ONCE):
        cuts = map(slice, starts[at : at + _AT_ONCE].tolist(), ends[at : at + _AT_ONCE].tolist())
        hashes = map(xxhash.xxh64_intdigest, map(joined.__getitem__, cuts), repeat(SEED))
        values = np.fromiter(hashes, np.uint64, min(_AT_ONCE, len(starts) - at)).astype("<u8")
        bits = np.unpackbits(values.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(starts), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, words: int = 4) -> DataFrame:
    """(doc_id, tie, code) of every row: a hash of the text and the signed 64-bit fingerprint."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_chunks(batches):
            codes = np.array([fingerprint(t, words) for t in texts(batch)], np.uint64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("tie"), pa.array(codes.view(np.int64))],
                names=["doc_id", "tie", "code"],
            )

    source = docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("tie"), "text")
    return source.mapInArrow(run, "doc_id long, tie long, code long")


def _rotated(by: int) -> Column:
    if not by:
        return F.col("code")
    return F.shiftleft("code", by).bitwiseOR(F.shiftrightunsigned("code", 64 - by))


def _layouts(codes: DataFrame, limit: int) -> DataFrame:
    """Each code once per layout, with the value of the band that leads it."""
    edges = [64 * i // (limit + 1) for i in range(limit + 2)]
    rows = [
        F.struct(
            F.lit(i).alias("layout"),
            F.shiftrightunsigned(_rotated(edges[i]), 64 - (edges[i + 1] - edges[i])).alias("band"),
        )
        for i in range(limit + 1)
    ]
    return codes.select("code", F.explode(F.array(*rows)).alias("at")).select("code", "at.*")


def _units(rows: DataFrame, block: int) -> DataFrame:
    """Deal large groups into pairs of blocks; other groups are one unit."""
    large = (
        rows.groupBy("layout", "band")
        .agg(F.count(F.lit(1)).alias("n"))
        .filter(F.col("n") > block)
        .select("layout", "band", F.ceil(F.col("n") / block).cast("int").alias("blocks"))
    )
    own = F.pmod(F.xxhash64("code"), F.col("blocks")).cast("int")
    met = F.transform(
        F.sequence(F.lit(0), F.col("blocks") - 1),
        lambda other: F.struct(F.least(own, other).alias("i"), F.greatest(own, other).alias("j")),
    )
    alone = F.array(F.struct(F.lit(0).alias("i"), F.lit(0).alias("j")))
    dealt = rows.join(large, ["layout", "band"], "left").withColumn(
        "unit", F.explode(F.when(F.col("blocks").isNull(), alone).otherwise(met))
    )
    return dealt.select("layout", "band", "unit.i", "unit.j", "code")


def _search(limit: int):
    """Search the units of a partition, some at a time, whole units together."""

    def found(codes: np.ndarray, group: np.ndarray, layout: np.ndarray) -> pa.RecordBatch:
        turn = np.array([64 * k // (limit + 1) for k in range(limit + 1)], np.uint64)[layout]
        turned = codes << turn | codes >> (np.uint64(64) - turn) % np.uint64(64)
        turned = np.where(turn == 0, codes, turned)
        a, b = linked(turned, group, limit)
        label = forest(len(codes), a, b)
        joined = np.flatnonzero(label != np.arange(len(codes)))
        pair = [codes[joined].view(np.int64), codes[label[joined]].view(np.int64)]
        return pa.RecordBatch.from_arrays([pa.array(p) for p in pair], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        rows, last, number = 0, None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = np.stack([batch.column(c).to_numpy() for c in ("layout", "band", "i", "j")])
            change = np.concatenate([[True], (keys[:, 1:] != keys[:, :-1]).any(axis=0)])
            if last is not None and (keys[:, 0] == last).all():
                change[0] = False
            last = keys[:, -1].copy()
            group = number + np.cumsum(change)
            number = int(group[-1])
            codes = batch.column("code").to_numpy().view(np.uint64)
            begins = np.flatnonzero(change)
            if rows > _AT_ONCE and len(begins):
                cut = int(begins[0])
                parts = [*held, (codes[:cut], group[:cut], keys[0, :cut])]
                yield found(*(np.concatenate(p) for p in zip(*parts)))
                held, rows = [], 0
                codes, group, keys = codes[cut:], group[cut:], keys[:, cut:]
            held.append((codes, group, keys[0]))
            rows += len(codes)
        if held:
            yield found(*(np.concatenate(p) for p in zip(*held)))

    return run


def links(codes: DataFrame, limit: int = 4, block: int = BLOCK) -> DataFrame:
    """Pairs (a, b) of distinct codes that connect all codes within ``limit`` bits."""
    units = _units(written(_layouts(codes, limit), "layouts"), block)
    keys = ["layout", "band", "i", "j"]
    dealt = units.repartition(*keys).sortWithinPartitions(*keys)
    return dealt.mapInArrow(_search(limit), "a long, b long")


def groups(docs: DataFrame, words: int = 4, limit: int = 4, block: int = BLOCK) -> DataFrame:
    """(doc_id, tie, code, root, component_id) of every row; root is a fingerprint of the group."""
    rows = written(fingerprints(docs, words), "fingerprints")
    distinct = written(rows.groupBy("code").agg(F.min("doc_id").alias("least")), "codes")
    roots = components(links(distinct.select("code"), limit, block))
    rooted = distinct.join(roots, distinct.code == roots.node, "left").select(
        "code", "least", F.coalesce("root", "code").alias("root")
    )
    names = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = written(rooted.join(names, "root").select("code", "root", "component_id"), "groups")
    return rows.join(named, "code")


def one_of_each(docs: DataFrame, words: int = 4, limit: int = 4) -> DataFrame:
    """The rows that stay: one of each group, the one with the smallest doc_id."""
    return keep_first(docs, groups(docs, words, limit))


def keep_first(docs: DataFrame, grouped: DataFrame) -> DataFrame:
    """The first row of each group of (doc_id, tie, root), the one with the smallest doc_id.

    Of equal doc_ids the text with the smallest hash stays, of equal rows any one; NULL
    doc_ids stay only where a group has no other.
    """
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "tie")
    first = grouped.groupBy("root").agg(F.min(order).alias("first"))
    first = written(first.select(F.col("first.doc_id").alias("_d"), F.col("first.tie").alias("_t")), "kept")
    tie = unused("tie", docs.columns)
    keyed = docs.withColumn(tie, F.xxhash64("text"))
    same = keyed.doc_id.cast("long").eqNullSafe(first["_d"]) & (keyed[tie] == first["_t"])
    kept = keyed.join(first, same, "left_semi").dropDuplicates(["doc_id", tie])
    return kept.select(*docs.columns)


@query("op2_simhash_groups")
def op2_simhash_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = groups(table(spark, sf_dir, "documents"))
    digits = F.lpad(F.lower(F.hex("code")), 16, "0")
    return found.select("doc_id", digits.alias("fingerprint"), "component_id")
