import duckdb
import pytest
from oracle_check import compare, connect

from noticeflow.llm.mixing import SQL, mix, op7_mix_sources


def _oracle(rows):
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, source VARCHAR)")
    if rows:
        con.executemany("INSERT INTO documents VALUES (?, ?, ?)", rows)
    return con


@pytest.mark.parametrize("folder", ["sf0.001", "sf0.01"])
def test_given_documents(spark, folder):
    path = f"/root/testdata/{folder}"
    assert compare(op7_mix_sources(spark, path), connect(path), SQL) is None


def test_defined_cases(spark):
    """NULLs, empty texts, a source without words, repeated rows, a source at its limit."""
    rows = [(i, "w " * (1 + i % 7), "big") for i in range(200)]
    rows += [(1000 + i, "a b c", "small") for i in range(3)] + [(1000, "a b c", "small")]
    rows += [(2000, None, "none"), (2001, "", "none"), (None, "x y", None), (3000, "x", None), (4000, "q " * 50, "é")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string")
    found = mix(frame)
    assert compare(found.drop("source"), _oracle(rows), SQL) is None
    total = sum(r["size"] for r in found.collect())
    for source in ["big", "small", "none", None, "é"]:
        own = [r for r in found.collect() if r.source == source]
        assert sum(r.taken for r in own) == int(own[0].target)
        assert all(0 <= r.taken <= 3 * r["size"] for r in own)
    assert abs(sum({r.source: r.target for r in found.collect()}.values()) - total) < 1e-6
    assert mix(frame.limit(0)).count() == 0


def test_targets_share_the_excess(spark):
    from noticeflow.llm.mixing import targets

    rows = [("a", 1000), ("b", 1), ("c", 2), ("d", 500), (None, 10)]
    got = {r.source: r.target for r in targets(spark.createDataFrame(rows, "source string, source_size long")).collect()}
    left, weight = {k: float(3 * v) for k, v in rows}, dict(zip(["a", "b", "c", "d", None], [1, 2, 3, 1, 2]))
    want, free, words = {}, dict(weight), 1513.0
    while free:
        share = (words - sum(want.values())) / sum(free.values())
        over = [s for s in free if share * free[s] > left[s]]
        for s in over:
            want[s] = left[s]
            del free[s]
        if not over:
            want |= {s: share * w for s, w in free.items()}
            break
    assert got == pytest.approx(want)
