import numpy as np
import pyarrow as pa
import pytest
from brute import repeated_corpus, repeats, small_texts

from noticeflow.llm import recompress, substrings
from noticeflow.llm.common import split_words
from noticeflow.llm.substrings import op6_substring_dedup, remove_repeats

from pyspark.sql import functions as F


def _found(frame):
    rows = frame.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("sha")).collect()
    assert len({r.doc_id for r in rows}) == len(rows)
    return {r.doc_id: (r.n_words, r.n_removed, r.sha) for r in rows}


@pytest.mark.parametrize("seed", range(4))
def test_random_corpora(spark, monkeypatch, seed):
    """Also with batches of a few documents, so that tasks meet through Spark only."""
    docs = repeated_corpus(seed)
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    assert _found(remove_repeats(frame, ["doc_id"])) == repeats(docs)


@pytest.mark.parametrize("window", [1, 2, 5])
def test_short_windows(spark, window):
    docs = repeated_corpus(9, 25)
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    assert _found(remove_repeats(frame, ["doc_id"], window)) == repeats(docs, window)


def test_given_documents(spark):
    found = {r[0]: tuple(r[1:]) for r in op6_substring_dedup(spark, "/root/testdata/sf0.001").collect()}
    assert found == repeats(small_texts())


def test_defined_cases(spark):
    text = " ".join(f"w{i}" for i in range(30))
    rows = [(None, text, 1), (5, text, 2), (5, text, 3), (2, "a b", 4), (7, None, 5)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, n_words int")
    got = remove_repeats(frame.withColumnRenamed("n_words", "d"), ["doc_id", "d"])
    found = {r[1]: (r.n_words, r.n_removed) for r in got.collect()}
    assert found == {1: (30, 30), 2: (30, 0), 3: (30, 0), 4: (2, 0), 5: (0, 0)}
    assert remove_repeats(frame.limit(0), ["doc_id"]).count() == 0


def test_equal_windows_have_equal_entries():
    """What tests a window depends on nothing outside it."""
    _, lengths, hashes = split_words(pa.array([t for _, t in repeated_corpus(1, 80)]))
    parsed = recompress.Recompressed(hashes, lengths, 20)
    names, seen = parsed.top.name, {}
    other = dict(zip(parsed.open.tolist(), parsed.run_name[parsed.run].tolist()))
    for i, start in enumerate(parsed.starts.tolist()):
        key = tuple(hashes[start : start + 20].tolist())
        own = tuple(names[parsed.first[i] : parsed.last[i] + 1].tolist()) or other[i]
        assert seen.setdefault(key, own) == own


def test_runs_across_batches():
    """Rows of one name that span Arrow batches are seen together."""
    rng = np.random.default_rng(0)
    name = np.sort(rng.integers(0, 40, 100))
    kind = rng.choice([0, 1, 2], 100, p=[0.7, 0.1, 0.2]).astype(np.int8)
    rows = pa.table({"name": name, "kind": pa.array(kind, pa.int8()), "d": np.arange(100), "tie": np.arange(100), "place": np.arange(100)})
    out = [x for b in substrings._shared_entries(iter(rows.to_batches(max_chunksize=3))) for x in b.column("d").to_pylist()]
    want = [i for i in range(100) if kind[i] == 1 or (kind[i] == 0 and (name == name[i]).sum() > 1)]
    assert sorted(out) == want
