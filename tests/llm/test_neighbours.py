import math

import numpy as np
import pandas as pd
import pytest

from noticeflow.llm.neighbours import Block, Top, chi_square, nearest, op1_stable_projections, project, reach

from pyspark.sql import functions as F


def brute(rows, is_query, k=10):
    """{query row number: [(distance, vec_id), ...]}"""
    out = {}
    for i, (q, v) in enumerate(rows):
        if is_query(q):
            near = [(math.dist(v, w), c) for j, (c, w) in enumerate(rows) if j != i and len(w) == len(v)]
            out[i] = sorted(near)[:k]
    return out


def recall(rows, want, got, k=10):
    hits = total = 0
    for i, near in want.items():
        found = got.get(rows[i][0], [])
        far = near[-1][0] if near else 0
        hits += sum(s <= far * (1 + 1e-9) for s, _ in found)
        total += len(near)
        assert len(found) == len(near)
        assert [s for s, _ in found] == sorted(s for s, _ in found)
    return hits / total


def collected(frame):
    out = {}
    for r in frame.orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append((r.score, r.vec_id))
    return out


def test_chi_square_law():
    assert chi_square(15.507, 8) == pytest.approx(0.95, abs=1e-4)
    assert reach(0.99) ** 2 == pytest.approx(20.090, abs=1e-2)
    rng = np.random.default_rng(0)
    a = rng.normal(size=(4000, 64))
    ratio = np.linalg.norm(project(list(a)), axis=1) / np.linalg.norm(a, axis=1)
    assert (ratio <= reach(0.99)).mean() > 0.97


def test_given_vectors(spark):
    frame = pd.read_parquet("/root/testdata/sf0.01/embeddings.parquet")
    rows = [(int(i), [float(x) for x in v]) for i, v in zip(frame.vec_id, frame.embedding)]
    want = brute(rows, lambda q: q % 100 == 0)
    got = collected(op1_stable_projections(spark, "/root/testdata/sf0.01"))
    assert recall(rows, want, got) >= 0.98
    for i, near in want.items():
        for (s, v), (w, _) in zip(got[rows[i][0]], near):
            assert s == pytest.approx(math.dist(rows[i][1], rows[v][1]))


@pytest.mark.parametrize("cell,block", [(50, 30), (10**6, 100)])
def test_many_cells_and_blocks(spark, cell, block):
    """Clusters, so that cells and buckets are ruled out; and copies of one vector."""
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(12, 20)) * 20
    rows = [(i, (centres[i % 12] + rng.normal(size=20)).tolist()) for i in range(1200)]
    rows += [(2000 + i, rows[5][1]) for i in range(200)]
    frame = spark.createDataFrame(rows, "vec_id long, vector array<double>").repartition(3)
    got = collected(nearest(frame, F.col("vec_id") % 50 == 5, cell=cell, block=block))
    want = brute(rows, lambda q: q % 50 == 5)
    assert recall(rows, want, got) >= 0.98
    assert [v for _, v in got[5]] == list(range(2000, 2010))


def test_the_tree_stops_early():
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(40, 32)) * 50
    vectors = [centres[i % 40] + rng.normal(size=32) for i in range(8000)]
    block = Block(np.arange(8000), np.arange(8000), vectors)
    seen = []
    block.vec_id = np.arange(8000)
    original = block.points
    class Counting(np.ndarray):
        def __getitem__(self, key):
            seen.append(np.size(key))
            return np.asarray(self).__getitem__(key)
    block.points = original.view(Counting)
    found, _ = block.nearest(0, vectors[0], 10, math.inf, reach(0.99))
    assert len(found) == 10 and sum(seen) < 2000
    low, high = Top.fit(original, 8).boxes()
    cells = Top.fit(original, 8).cells(original)
    assert len(set(cells)) == 8 and ((original >= low[cells]) & (original <= high[cells])).all()


def test_defined_cases(spark):
    nan, inf = math.nan, math.inf
    rows = [
        (100, [1.0, 0.0], 1), (100, [1.0, 0.0], 1), (2, [2.0, 0.0], 1), (1, [0.0, 0.0], 1), (3, None, 1),
        (4, [nan, 1.0], 1), (5, [inf, 1.0], 1), (6, [None, 1.0], 1), (7, [], 1), (8, [1.0, 0.0, 0.0], 1),
        (None, [1.0, 0.1], 1), (9, [0.0, 0.0, -0.0], 1), (200, [5.0], 1),
    ]
    frame = spark.createDataFrame(rows, "vec_id long, vector array<double>, row int")
    got = nearest(frame, F.col("vec_id") % 100 == 0).orderBy("query_id", "rank").collect()
    assert [tuple(r) for r in got] == [(100, 1, 100, 0.0), (100, 1, 100, 0.0), (100, 2, 2, 1.0), (100, 2, 2, 1.0)]
    assert nearest(frame.limit(0), F.col("vec_id") % 100 == 0).count() == 0


@pytest.mark.parametrize("copies", [300, 40_000 // 3])
def test_copies_in_a_block_tie_to_the_smaller_id(copies):
    """Copies lie in many buckets, and their projections differ in the last bits."""
    rng = np.random.default_rng(11)
    vectors = list(rng.normal(size=(40_000, 32)) * 1000)
    at = rng.choice(40_000, copies, replace=False)
    for i in at:
        vectors[i] = vectors[at[0]]
    ids = rng.permutation(40_000)
    block = Block(np.arange(40_000), ids, vectors)
    for row in at[:20].tolist():
        found, distance = block.nearest(row, vectors[row], 10, math.inf, reach(0.99))
        assert block.vec_id[found].tolist() == sorted(ids[at[at != row]])[:10]
        assert not distance.any()


def test_copies_of_a_third_of_the_rows(spark):
    rng = np.random.default_rng(12)
    rows = [(i, rng.normal(size=24).tolist()) for i in range(3000)]
    rows = [(i, rows[0][1] if i % 3 == 0 else v) for i, v in rows]
    frame = spark.createDataFrame(rows[::-1], "vec_id long, vector array<double>").repartition(5)
    got = collected(nearest(frame, F.col("vec_id") % 100 == 0, cell=100, block=400))
    for query in range(0, 3000, 300):
        assert got[query] == [(0.0, i) for i in range(0, 36, 3) if i != query][:10]
