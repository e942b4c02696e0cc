"""Operator 1: nearest neighbours by stable projections and a kd-tree (after SRS).

After Sun, Wang, Qin, Zhang and Lin, "SRS: solving c-approximate nearest neighbor queries
in high dimensional Euclidean space with a tiny index" (2014). Vectors are projected to
``AXES`` Gaussian axes. The Gaussian is 2-stable: over the true distance, the squared
projected distance of two vectors follows a chi-square law with ``AXES`` degrees of
freedom. A kd-tree over the projections yields neighbours in the order of projected distance;
each is verified by its true distance, until the chi-square test holds: a vector nearer
than the k-th found would, with the given confidence, have been projected nearer than the
place the search has reached.

The tree has two parts. Its top is fitted on a bounded sample (``SAMPLE`` rows, the
smallest by hash) and cuts space into cells of about ``CELL`` rows; all rows are dealt to
cells. A cell of more rows is dealt into blocks by hash, so equal vectors may be any
number. In a block, the tree goes on down to buckets of ``BUCKET`` rows. A query first
searches its own cell, which bounds its k-th distance, and then all cells that the test
does not rule out. What the test reaches is widened by the rounding of projections, so that
copies, whose projections differ in their last bits, are all verified. Queries travel to blocks, k rows for each block travel back; nothing
is broadcast but the top of the tree.

Defined cases: vectors that are NULL, empty, zero, or hold NULL or non-finite components
take no part, nor do rows without vec_id; only vectors of the query's length are its
candidates; a query's own row is no candidate, other rows of its vec_id are; ties go to
the smaller vec_id; fewer than k candidates are all returned; repeated rows are rows of
their own; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import written
from .common import table
from .registry import query

AXES = 8
SAMPLE, CELL, BLOCK, BUCKET = 50_000, 20_000, 40_000, 32


def chi_square(x: float, freedom: int = AXES) -> float:
    """Distribution function of the chi-square law for an even number of degrees."""
    term, total = 1.0, 0.0
    for i in range(freedom // 2):
        total += term
        term *= x / 2 / (i + 1)
    return 1.0 - math.exp(-x / 2) * total


def reach(confidence: float) -> float:
    """Projected distance over true distance up to which the test does not hold yet."""
    low, high = 0.0, 1.0
    while chi_square(high) < confidence:
        high *= 2
    for _ in range(100):
        middle = (low + high) / 2
        low, high = (middle, high) if chi_square(middle) < confidence else (low, middle)
    return math.sqrt(high)


@cache
def axes(dimensions: int) -> np.ndarray:
    """Gaussian directions; the first rows are the same for every length."""
    return np.random.default_rng(1).normal(size=(dimensions, AXES))


def project(vectors: list[np.ndarray]) -> np.ndarray:
    matrix = axes(max(map(len, vectors), default=0))
    out = np.zeros((len(vectors), AXES))
    lengths = np.array([len(v) for v in vectors])
    for length in np.unique(lengths):
        same = np.flatnonzero(lengths == length)
        out[same] = np.stack([vectors[i] for i in same]).astype(np.float64) @ matrix[:length]
    return out


def rounding(vectors: np.ndarray, bound: np.ndarray | float) -> np.ndarray:
    """How far rounding may move the projected distance of vectors to rows within ``bound``.

    Products of matrices and of single vectors differ in their last bits, and with the size of
    a batch; the error of a product grows with its length and with the norms of both sides.
    """
    size = np.linalg.norm(vectors, axis=-1)
    length = vectors.shape[-1]
    return 4 * np.finfo(np.float64).eps * (length + 4) * np.linalg.norm(axes(length)) * (size + bound)


def without_spare_copies(vec_id: np.ndarray, vectors: list[np.ndarray], most: int) -> np.ndarray:
    """Indexes of rows; of equal vectors only the ``most`` with the smallest vec_id."""
    seen: dict[bytes, int] = {}
    group = np.fromiter((seen.setdefault(v.tobytes(), len(seen)) for v in vectors), np.int64, len(vectors))
    order = np.lexsort((vec_id, group))
    begins = np.searchsorted(group[order], np.arange(len(seen)))
    return order[np.arange(len(order)) - begins[group[order]] < most]


@dataclass
class Top:
    """The upper levels of the kd-tree: a complete binary tree of cuts in heap order."""

    axis: np.ndarray
    cut: np.ndarray
    depth: int

    @staticmethod
    def fit(points: np.ndarray, cells: int) -> Top:
        depth = max(0, math.ceil(math.log2(max(1, cells))))
        inner = (1 << depth) - 1
        axis, cut, held = np.zeros(inner, np.int64), np.zeros(inner), {0: points}
        for i in range(inner):
            own = held.pop(i)
            if len(own):
                axis[i] = int(np.argmax(own.max(axis=0) - own.min(axis=0)))
                cut[i] = np.median(own[:, axis[i]])
            right = own[:, axis[i]] > cut[i]
            held[2 * i + 1], held[2 * i + 2] = own[~right], own[right]
        return Top(axis, cut, depth)

    def cells(self, points: np.ndarray) -> np.ndarray:
        at = np.zeros(len(points), np.int64)
        for _ in range(self.depth):
            at = 2 * at + 1 + (points[np.arange(len(points)), self.axis[at]] > self.cut[at])
        return at - ((1 << self.depth) - 1)

    def boxes(self) -> tuple[np.ndarray, np.ndarray]:
        n = 1 << self.depth
        low, high = np.full((2 * n - 1, AXES), -np.inf), np.full((2 * n - 1, AXES), np.inf)
        for i in range(n - 1):
            for child in (2 * i + 1, 2 * i + 2):
                low[child], high[child] = low[i], high[i]
            high[2 * i + 1, self.axis[i]] = self.cut[i]
            low[2 * i + 2, self.axis[i]] = self.cut[i]
        return low[n - 1 :], high[n - 1 :]


def _to_boxes(point: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    gap = np.maximum(np.maximum(low - point, point - high), 0.0)
    return np.sqrt((gap * gap).sum(axis=-1))


class Block:
    """The rows of a block, in buckets of the kd-tree over their projections."""

    def __init__(self, row: np.ndarray, vec_id: np.ndarray, vectors: list[np.ndarray]):
        self.lengths = np.array([len(v) for v in vectors])
        points = project(vectors)
        buckets, todo = [], [np.arange(len(row))]
        while todo:
            own = todo.pop()
            spread = np.ptp(points[own], axis=0) if len(own) else np.zeros(1)
            if len(own) <= BUCKET or not spread.max() > 0:
                # Equal projections stay together; the nearest by vec_id come first.
                buckets.append(own[np.argsort(vec_id[own], kind="stable")])
                continue
            half = len(own) // 2
            order = np.argpartition(points[own, int(np.argmax(spread))], half)
            todo += [own[order[:half]], own[order[half:]]]
        order = np.concatenate(buckets)
        self.row, self.vec_id, self.points = row[order], vec_id[order], points[order]
        self.vectors = [vectors[i] for i in order]
        self.lengths = self.lengths[order]
        self.ends = np.cumsum([len(b) for b in buckets])
        self.begins = self.ends - [len(b) for b in buckets]
        self.low = np.minimum.reduceat(self.points, self.begins)
        self.high = np.maximum.reduceat(self.points, self.begins)
        self.table: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for length in np.unique(self.lengths):
            same = np.flatnonzero(self.lengths == length)
            place = np.full(len(order), -1)
            place[same] = np.arange(len(same))
            self.table[int(length)] = np.stack([self.vectors[i] for i in same]).astype(np.float64), place

    def nearest(self, row: int, vector: np.ndarray, k: int, bound: float, ratio: float):
        """Row places and distances of the k nearest; none beyond ``bound`` is needed."""
        vector = vector.astype(np.float64)
        if len(vector) not in self.table:
            return np.zeros(0, np.int64), np.zeros(0)
        values, place = self.table[len(vector)]
        point = project([vector])[0]
        distance = _to_boxes(point, self.low, self.high)
        reached = bound * ratio + rounding(vector, bound)
        order = np.argsort(distance, kind="stable")
        best, best_at, at, step = np.zeros(0), np.zeros(0, np.int64), 0, 4
        while at < len(order):
            part = order[at : at + step]
            part = part[distance[part] <= reached]
            if not len(part):
                break
            at, step = at + step, 2 * step
            rows = np.concatenate([np.arange(self.begins[b], self.ends[b]) for b in part])
            rows = rows[(place[rows] >= 0) & (self.row[rows] != row)]
            if np.isfinite(bound):
                gap = self.points[rows] - point
                rows = rows[np.sqrt((gap * gap).sum(axis=1)) <= reached]
            gap = values[place[rows]] - vector
            best = np.concatenate([best, np.sqrt((gap * gap).sum(axis=1))])
            best_at = np.concatenate([best_at, rows])
            keep = np.lexsort((self.vec_id[best_at], best))[:k]
            best, best_at = best[keep], best_at[keep]
            if len(best) == k:
                bound = min(bound, best[-1])
                reached = bound * ratio + rounding(vector, bound)
        return best_at, best


def _usable(vector: Column) -> Column:
    finite = lambda x: F.coalesce(F.abs(x) < F.lit(float("inf")), F.lit(False))
    return vector.isNotNull() & F.forall(vector, finite) & F.exists(vector, lambda x: x != 0)


def _vectors(column: pa.Array) -> list[np.ndarray]:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    ends = np.cumsum(column.value_lengths().to_numpy())
    return np.split(flat, ends[:-1]) if len(column) else []


_INDEXED = "row long, vec_id long, vector array<double>, cell int"


def _deal_to_cells(top):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 33
        for batch in batches:
            if batch.num_rows:
                cells = top.value.cells(project(_vectors(batch.column("vector"))))
                rows = np.arange(row, row + batch.num_rows)
                row += batch.num_rows
                yield pa.RecordBatch.from_arrays(
                    [pa.array(rows), *(batch.column(i) for i in (0, 1)), pa.array(cells.astype(np.int32))],
                    names=["row", "vec_id", "vector", "cell"],
                )

    return run


def _cells_in_reach(top, ratio: float):
    """Queries (row, vector, home, bound) to all cells but their own that may hold nearer rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        low, high = top.value.boxes()
        for batch in batches:
            if not batch.num_rows:
                continue
            vectors = _vectors(batch.column("vector"))
            points = project(vectors)
            home, bound = batch.column("cell").to_numpy(), batch.column("bound").to_numpy()
            for at in range(batch.num_rows):
                reached = bound[at] * ratio + rounding(vectors[at], bound[at])
                near = _to_boxes(points[at], low, high) <= reached
                near[home[at]] = False
                cells = np.flatnonzero(near).astype(np.int32)
                if len(cells):
                    one = batch.select(["row", "vec_id", "vector", "bound"]).take(pa.array([at] * len(cells)))
                    yield pa.RecordBatch.from_arrays(
                        [*one.columns, pa.array(cells)], names=["row", "vec_id", "vector", "bound", "cell"]
                    )

    return run


_FOUND = "row long, query_id long, vec_id long, distance double"


def _search_blocks(k: int, ratio: float):
    """Rows sorted by block, indexed rows before queries, to the queries' nearest in the block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, block, key = [], None, None
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = np.stack([batch.column(c).to_numpy() for c in ("cell", "part", "asks")], axis=1)
            cuts = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
            for at, end in zip([0, *cuts], [*cuts, batch.num_rows]):
                cell, part, asks = keys[at].tolist()
                if key != (cell, part):
                    key, held, block = (cell, part), [], None
                own = batch.slice(at, end - at)
                if not asks:
                    held.append(own)
                    continue
                if block is None:
                    if not held:
                        continue
                    whole = pa.Table.from_batches(held).combine_chunks()
                    rows, ids = whole.column("row").to_numpy(), whole.column("vec_id").to_numpy()
                    vectors = _vectors(whole.column("vector").combine_chunks())
                    # A query leaves out one row, its own, so k + 1 equal rows give its k.
                    own_rows = without_spare_copies(ids, vectors, k + 1)
                    block = Block(rows[own_rows], ids[own_rows], [vectors[i] for i in own_rows])
                out = [[], [], [], []]
                bounds = own.column("bound").to_numpy()
                for i, vector in enumerate(_vectors(own.column("vector"))):
                    row = own.column("row")[i].as_py()
                    found, distance = block.nearest(row, vector, k, bounds[i], ratio)
                    out[0].append(np.full(len(found), row))
                    out[1].append(np.full(len(found), own.column("vec_id")[i].as_py()))
                    out[2].append(block.vec_id[found])
                    out[3].append(distance)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(c)) for c in out], names=["row", "query_id", "vec_id", "distance"]
                )

    return run


def _ask(index: DataFrame, blocks: DataFrame, asked: DataFrame, k: int, ratio: float) -> DataFrame:
    """The k nearest of each query (row, vec_id, vector, bound, cell) in each block of its cell."""
    columns = ["row", "vec_id", "vector", "bound", "cell", "part", "asks"]
    part = F.pmod(F.xxhash64("row"), F.col("parts")).cast("int")
    rows = index.join(blocks, "cell").select(
        "row", "vec_id", "vector", F.lit(0.0).alias("bound"), "cell", part.alias("part"), F.lit(0).alias("asks")
    )
    to = asked.join(blocks, "cell").withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    both = rows.union(to.withColumn("asks", F.lit(1)).select(*columns))
    keys = ["cell", "part"]
    dealt = both.repartition(*keys).sortWithinPartitions(*keys, "asks")
    return dealt.mapInArrow(_search_blocks(k, ratio), _FOUND)


def nearest(
    vectors: DataFrame, is_query: Column, k: int = 10, confidence: float = 0.99, cell: int = CELL, block: int = BLOCK
) -> DataFrame:
    """(query_id, rank, vec_id, score) from rows (vec_id, vector): the k nearest of each query row."""
    spark, ratio = vectors.sparkSession, reach(confidence)
    usable = vectors.select(
        F.col("vec_id").cast("long"), F.col("vector").cast("array<double>").alias("vector")
    ).filter(F.col("vec_id").isNotNull() & _usable(F.col("vector")))
    total = usable.count()
    sample = usable.orderBy(F.xxhash64("vec_id", "vector")).limit(SAMPLE).select("vector").toArrow()
    points = project(_vectors(sample.column(0).combine_chunks())) if sample.num_rows else np.zeros((0, AXES))
    top = spark.sparkContext.broadcast(Top.fit(points, min(math.ceil(total / cell), max(1, len(points) // 16))))
    index = written(usable.mapInArrow(_deal_to_cells(top), _INDEXED), "vectors")
    parts = F.ceil(F.count(F.lit(1)) / block).cast("int")
    blocks = written(index.groupBy("cell").agg(parts.alias("parts")), "blocks")
    asked = index.filter(is_query)
    home = asked.withColumn("bound", F.lit(float("inf")))
    first = written(_ask(index, blocks, home, k, ratio), "nearest")
    best = Window.partitionBy("row").orderBy("distance", "vec_id")
    kth = first.withColumn("n", F.row_number().over(best)).filter(F.col("n") == k)
    kth = kth.select("row", F.col("distance").alias("bound"))
    bounded = asked.join(kth, "row", "left").select(
        "row", "vec_id", "vector", "cell", F.coalesce("bound", F.lit(float("inf"))).alias("bound")
    )
    further = bounded.mapInArrow(
        _cells_in_reach(top, ratio), "row long, vec_id long, vector array<double>, bound double, cell int"
    )
    second = _ask(index, blocks, further, k, ratio)
    ranked = first.union(second).withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", F.col("distance").alias("score"))


@query("op1_stable_projections")
def op1_stable_projections(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").withColumnRenamed("embedding", "vector")
    return nearest(vectors, F.col("vec_id") % 100 == 0)
