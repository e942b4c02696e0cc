"""Operator 11: near-duplicates by circulant MinHash, links confirmed on the full sets.

A document's set holds its distinct word shingles. Its signature has ``COORDINATES`` minima,
all of them made by two permutations (Li and Li, "C-MinHash: reducing K permutations to two",
2022): the first spreads the shingles over a universe of 2**32 places, the second, shifted
by one place for each coordinate, is minimised over them. Bands of ``ROWS`` coordinates give
candidates; at the least similarity that links, a pair shares no band once in 2 * 10**7 cases.

Equal sets are one node. Confirmation never pairs off a bucket (the nodes of one band value):

1. The node of a bucket that meets the most nodes in all its buckets leads it (the text that
   others are copies of, where it is there), and every other node is compared with it on the
   full sets. That is one text a node and leader; followers of a leader with many are dealt
   into parts, each with a copy of the leader's text. Links make components.
2. Buckets whose nodes are now in one component are done, which is what becomes of copies
   with few edits, however many. The others go on without their leader: nodes outside the
   bucket's largest component are compared with each other and with that component, in
   blocks bounded by rows and by shingles. Signatures come first: a node whose signature
   agrees with none of another component in ``COORDINATES * 0.59`` places (six deviations
   below what links) is out. A pair that shares several bands is looked at in the first. Of
   the nodes left, blocks get the texts and compare full sets.

Defined cases: NULL, empty and wordless texts have an empty set, which links with nothing,
their copies included; fewer words than a shingle are one shingle; rows of equal doc_id are
rows of their own; a NULL doc_id names no group and is not kept, so a group of NULLs alone
has a NULL name; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import written
from .common import mixed, spans, split_words, table, text_chunks
from .components import components
from .registry import query

WORDS, PERCENT = 4, 80
COORDINATES, ROWS = 128, 4
FOLLOWERS = 2048
BLOCK, SHINGLES = 2048, 4_000_000
_FACTORS = np.random.default_rng(11).integers(0, 2**63, 64, np.uint64) * np.uint64(2) + np.uint64(1)
_AT_ONCE = 1 << 16
_SIGNED = "row long, doc_id long, k1 long, k2 long, n long, bands array<long>, text string"
_UNIT = ["layout", "band", "kind", "i", "j"]


def shingle_sets(texts: pa.Array, words: int = WORDS) -> list[np.ndarray]:
    """The set of hashed shingles of each text, sorted."""
    # Lower-casing comes before any cast: arrays cast from a slice are not lowered rightly.
    _, counts, hashes = split_words(pc.ascii_lower(texts))
    first = np.cumsum(counts) - counts
    row, place = spans(np.where(counts > 0, np.maximum(counts - words + 1, 1), 0))
    begin, width = first[row] + place, np.minimum(counts, words)[row]
    values = width.astype(np.uint64)
    with np.errstate(over="ignore"):
        for j in range(words):
            word = hashes[np.minimum(begin + j, len(hashes) - 1)]
            values += np.where(j < width, word * _FACTORS[j % 64], np.uint64(0))
    values = mixed(values)
    ends = np.searchsorted(row, np.arange(len(counts)), side="right")
    return [np.unique(values[a:b]) for a, b in zip([0, *ends[:-1].tolist()], ends.tolist())]


def _permuted(x: np.ndarray, key: int) -> np.ndarray:
    """A permutation of the unsigned 32-bit integers (the finaliser of MurmurHash3)."""
    x = x ^ np.uint32(key)
    x ^= x >> np.uint32(16)
    x *= np.uint32(0x85EBCA6B)
    x ^= x >> np.uint32(13)
    x *= np.uint32(0xC2B2AE35)
    x ^= x >> np.uint32(16)
    return x


def signatures(sets: list[np.ndarray], coordinates: int = COORDINATES) -> np.ndarray:
    """A row of minima for each set; all ones for an empty one."""
    out = np.full((len(sets), coordinates), np.uint32(2**32 - 1))
    sizes = np.array([len(s) for s in sets], np.int64)
    if not sizes.sum():
        return out
    flat, (row, _) = np.concatenate(sets), spans(sizes)
    for at in range(0, len(flat), _AT_ONCE):
        own = row[at : at + _AT_ONCE]
        begins = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
        places = _permuted((flat[at : at + _AT_ONCE] >> np.uint64(32)).astype(np.uint32), 0x5BD1E995)
        for k in range(coordinates):
            shifted = _permuted(places - np.uint32(k), 0x27D4EB2F)
            here = np.minimum.reduceat(shifted, begins)
            out[own[begins], k] = np.minimum(out[own[begins], k], here)
    return out


def _sign(words: int):
    """Rows with the two halves of their set's name, its size and bands."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 33
        for batch in text_chunks(batches):
            sets = shingle_sets(batch.column("text"), words)
            bands = _bands(signatures(sets))
            with np.errstate(over="ignore"):
                names = [[int(mixed(s * f).sum(dtype=np.uint64)) for s in sets] for f in _FACTORS[:2]]
            filled = [b if len(s) else b[:0] for b, s in zip(bands, sets)]
            n = batch.num_rows
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.arange(row, row + n)),
                    batch.column("doc_id"),
                    *(pa.array(np.array(k, np.uint64).view(np.int64)) for k in names),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array(filled, pa.list_(pa.int64())),
                    batch.column("text"),
                ],
                names=[f.split()[0] for f in _SIGNED.split(", ")],
            )
            row += n

    return run


def _compared(words: int):
    """What the search among components needs of a node: size, signature and bands."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_chunks(batches):
            sets = shingle_sets(batch.column("text"), words)
            minima = signatures(sets)
            short = _permuted(minima, 0).astype("<u2")
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("node"),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([s.tobytes() for s in short], pa.binary()),
                    pa.array(list(_bands(minima)), pa.list_(pa.int64())),
                ],
                names=["node", "n", "sig", "bands"],
            )

    return run


def _bands(minima: np.ndarray) -> np.ndarray:
    """The value of each band of ``ROWS`` coordinates."""
    split = minima.astype(np.uint64).reshape(len(minima), -1, ROWS)
    with np.errstate(over="ignore"):
        return mixed((split * _FACTORS[:ROWS]).sum(axis=2, dtype=np.uint64)).view(np.int64)


def linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Whether the intersection of two sorted sets is at least ``percent`` of their union."""
    small, large = sorted((a, b), key=len)
    if 100 * len(small) < percent * len(large):
        return False
    place = np.minimum(np.searchsorted(large, small), len(large) - 1)
    both = int(np.count_nonzero(large[place] == small))
    return 100 * both >= percent * (len(a) + len(b) - both)


def _pairs(pairs: list[tuple[int, int]]) -> pa.RecordBatch:
    ends = [pa.array([p[side] for p in pairs], pa.int64()) for side in (0, 1)]
    return pa.RecordBatch.from_arrays(ends, names=["a", "b"])


def _follow(words: int, percent: int):
    """Parts sorted with their leader in front to the links between it and its followers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        leader, own = None, None
        for batch in text_chunks(batches):
            found = []
            ends = zip(batch.column("rep").to_pylist(), batch.column("node").to_pylist())
            for (rep, node), values in zip(ends, shingle_sets(batch.column("text"), words)):
                if rep == node:
                    leader, own = rep, values
                elif linked(own, values, percent):
                    found.append((leader, node))
            yield _pairs(found)

    return run


def _units(rows: DataFrame, block: int, shingles: int) -> DataFrame:
    """Deal the buckets of (layout, band, node, label, n) into units of blocks.

    ``kind`` 0 holds two blocks (or one) of nodes outside the bucket's largest component,
    ``kind`` 1 such a block and one of that component, whose rows are marked ``main``.
    """
    bucket = ["layout", "band"]
    sizes = rows.groupBy(*bucket, "label").agg(F.count(F.lit(1)).alias("c"), F.sum("n").alias("s"))
    largest = sizes.groupBy(*bucket).agg(
        F.max(F.struct("c", "s", "label")).alias("top"), F.sum("c").alias("c"), F.sum("s").alias("s")
    )

    def blocks(c, s):
        return F.greatest(F.ceil(c / block), F.ceil(s / shingles)).cast("int")

    several = largest.filter(F.col("c") > F.col("top.c")).select(
        *bucket,
        F.col("top.label").alias("first"),
        blocks(F.col("c") - F.col("top.c"), F.col("s") - F.col("top.s")).alias("rest"),
        blocks(F.col("top.c"), F.col("top.s")).alias("mains"),
    )
    main = F.col("label") == F.col("first")
    own = F.pmod(F.xxhash64("node"), F.when(main, F.col("mains")).otherwise(F.col("rest"))).cast("int")

    def unit(kind, i, j):
        return F.struct(F.lit(kind).alias("kind"), i.alias("i"), j.alias("j"))

    others = F.sequence(F.lit(0), F.col("rest") - 1)
    with_main = F.transform(F.sequence(F.lit(0), F.col("mains") - 1), lambda j: unit(1, own, j))
    with_rest = F.transform(others, lambda o: unit(0, F.least(own, o), F.greatest(own, o)))
    as_main = F.transform(others, lambda i: unit(1, i, own))
    units = F.when(main, as_main).otherwise(F.concat(with_rest, with_main))
    dealt = rows.join(several, bucket).withColumn("main", main).withColumn("unit", F.explode(units))
    return dealt.select(*bucket, "unit.*", "node", "label", "main", "n")


def _whole_units(batches: Iterator[pa.RecordBatch], values: list[str]) -> Iterator[list[tuple]]:
    """Rows (unit, node, label, main, n, values) of one unit after the other."""
    held, key = [], None
    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in (*_UNIT, "node", "label", "main", "n")]
        for (*unit, node, label, main, n), *own in zip(zip(*columns), *(batch.column(v) for v in values)):
            if unit != key and held:
                yield held
                held = []
            key = unit
            held.append((unit, node, label, main, n, *own))
    if held:
        yield held


def _hopeful(least: int, percent: int):
    """Of each unit the nodes whose signature agrees with one of another component."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for unit in _whole_units(batches, ["sig", "bands"]):
            label = np.array([u[2] for u in unit])
            main = np.array([u[3] for u in unit])
            n = np.array([u[4] for u in unit])
            sigs = np.stack([np.frombuffer(u[5].as_buffer(), "<u2") for u in unit])
            bands = np.stack([u[6].values.to_numpy() for u in unit])
            keep = np.zeros(len(unit), bool)
            layout, both_rest = unit[0][0][0], unit[0][0][2] == 0
            for i in np.flatnonzero(~main):
                fits = (label != label[i]) & (main | both_rest)
                fits &= 100 * np.minimum(n, n[i]) >= percent * np.maximum(n, n[i])
                fits[: i + 1] &= main[: i + 1]
                others = np.flatnonzero(fits)
                others = others[np.count_nonzero(sigs[others] == sigs[i], axis=1) >= least]
                others = others[(bands[others] == bands[i]).argmax(axis=1) == layout]
                if len(others):
                    keep[others] = keep[i] = True
            kept = [unit[i][0] + list(unit[i][1:5]) for i in np.flatnonzero(keep)]
            columns = list(zip(*kept)) or [()] * 9
            kinds = [pa.int32(), pa.int64(), *[pa.int32()] * 3, *[pa.int64()] * 2, pa.bool_(), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)], names=[*_UNIT, "node", "label", "main", "n"]
            )

    return run


def _confirm(words: int, percent: int):
    """Links between components within each unit, enough to join what links join there."""

    def sets(batches):
        for batch in text_chunks(batches):
            own = [s.tobytes() for s in shingle_sets(batch.column("text"), words)]
            yield batch.append_column("own", pa.array(own, pa.large_binary()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for unit in _whole_units(sets(batches), ["own"]):
            label = np.array([u[2] for u in unit])
            main = np.array([u[3] for u in unit])
            values = [np.frombuffer(u[5].as_buffer(), np.uint64) for u in unit]
            both_rest, found = unit[0][0][2] == 0, []
            for i in np.flatnonzero(~main).tolist():
                for j in np.flatnonzero(main | both_rest).tolist():
                    if label[i] != label[j] and (main[j] or j > i) and linked(values[i], values[j], percent):
                        found.append((unit[i][1], unit[j][1]))
                        label[label == label[j]] = label[i]
            yield _pairs(found)

    return run


def _texts(nodes: DataFrame, held: DataFrame) -> DataFrame:
    """Rows of nodes with their text; by one way of joining at every size."""
    return nodes.join(held.hint("merge"), "node")


def _across(met: DataFrame, roots: DataFrame, held: DataFrame, words: int, percent: int) -> DataFrame | None:
    """Links between different components that share a bucket; None where no bucket has two."""
    rest = met.filter("m > 2 and node <> rep").select("layout", "band", "node")
    labelled = rest.join(roots, "node", "left").withColumn("label", F.coalesce("root", "node")).drop("root")
    bounds = labelled.groupBy("layout", "band").agg(F.min("label").alias("lo"), F.max("label").alias("hi"))
    mixed_up = bounds.filter("lo < hi").select("layout", "band")
    left = written(labelled.join(mixed_up, ["layout", "band"], "left_semi"), "left")
    if left.isEmpty():
        return None
    signed = _texts(left.select("node").distinct(), held).mapInArrow(
        _compared(words), "node long, n long, sig binary, bands array<long>"
    )
    signed = written(signed, "compared")
    units = _units(left.join(signed.select("node", "n"), "node"), BLOCK, SHINGLES)
    sigs = units.join(signed.select("node", "sig", "bands"), "node")
    least = int(COORDINATES * (percent / 100 - 6 * ((percent / 100) * (1 - percent / 100) / COORDINATES) ** 0.5))
    kinds = "layout int, band long, kind int, i int, j int, node long, label long, main boolean, n long"
    searched = sigs.repartition(*_UNIT).sortWithinPartitions(*_UNIT).mapInArrow(_hopeful(least, percent), kinds)
    full = _texts(written(searched, "hopeful"), held).repartition(*_UNIT).sortWithinPartitions(*_UNIT)
    return full.mapInArrow(_confirm(words, percent), "a long, b long")


def links(rows: DataFrame, nodes: DataFrame, words: int, percent: int) -> DataFrame:
    """(node, root) of the nodes that link with another."""
    banded = rows.select(F.col("row").alias("node"), F.posexplode("bands").alias("layout", "band"))
    dealt = written(banded.join(nodes.select("node"), "node", "left_semi"), "bands")
    bucket = ["layout", "band"]
    buckets = dealt.groupBy(*bucket).agg(F.count(F.lit(1)).alias("m")).filter("m > 1")
    met = written(dealt.join(buckets, bucket).select(*bucket, "node", "m"), "met")
    meets = met.groupBy("node").agg(F.sum(F.col("m") - 1).alias("meets"))
    # Only texts that meet another go on.
    texts = rows.select(F.col("row").alias("node"), "text")
    held = written(texts.join(meets.select("node").hint("merge"), "node", "left_semi"), "held")
    leads = F.max(F.struct("meets", (-F.col("node")).alias("node"))).alias("first")
    leaders = met.join(meets, "node").groupBy(*bucket).agg(leads)
    met = met.join(leaders.select(*bucket, (-F.col("first.node")).alias("rep")), bucket)
    met = written(met.select(*bucket, "node", "rep", "m"), "led")
    pairs = written(met.filter("node <> rep").select("rep", "node").distinct(), "pairs")
    parts = pairs.groupBy("rep").agg(F.ceil(F.count(F.lit(1)) / FOLLOWERS).cast("int").alias("parts"))
    part = F.pmod(F.xxhash64("node"), F.col("parts")).cast("int").alias("part")
    followers = pairs.join(parts, "rep").select("rep", part, "node")
    every = F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part")
    led = _texts(followers.union(parts.select("rep", every, F.col("rep").alias("node"))), held)
    order = ["rep", "part", F.col("node") != F.col("rep"), "node"]
    led = led.repartition("rep", "part").sortWithinPartitions(*order).select("rep", "node", "text")
    confirmed = written(led.mapInArrow(_follow(words, percent), "a long, b long"), "confirmed")
    roots = written(components(confirmed), "roots")
    more = _across(met, roots, held, words, percent)
    if more is None:
        return roots
    more = written(more, "across")
    return roots if more.isEmpty() else components(confirmed.union(more))


def groups(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row."""
    source = docs.select(F.col("doc_id").cast("long"), F.col("text"))
    rows = written(source.mapInArrow(_sign(words), _SIGNED), "signed")
    keys = ["k1", "k2"]
    nodes = rows.filter("n > 0").groupBy(*keys).agg(F.min("row").alias("node"), F.min("doc_id").alias("least"))
    nodes = written(nodes, "nodes")
    rooted = nodes.join(links(rows, nodes, words, percent), "node", "left")
    rooted = rooted.withColumn("root", F.coalesce("root", "node"))
    names = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = written(rooted.join(names, "root").select(*keys, "component_id"), "named")
    filled = rows.select("doc_id", "n", *keys).join(named.withColumn("full", F.lit(True)), keys, "left")
    name = F.when(F.col("full"), F.col("component_id")).otherwise(F.col("doc_id"))
    return filled.select("doc_id", F.col("n").alias("n_shingles"), name.alias("component_id"))


@query("op11_circulant_minhash")
def op11_circulant_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = groups(table(spark, sf_dir, "documents"))
    kept = F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False))
    return found.withColumn("kept", kept)
