import random

import numpy as np
import pyarrow as pa
import pytest
from brute import SMALL, small_texts

from noticeflow.llm import circulant
from noticeflow.llm.circulant import groups, op11_circulant_minhash, shingle_sets, signatures
from pyspark.sql import functions as F


def shingles(text, k=4):
    parts = (text or "").encode().lower().split()
    return {b" ".join(parts[i : i + k]) for i in range(max(1, len(parts) - k + 1))} if parts else set()


def brute(docs, percent=80):
    """(doc_id, size, smallest doc_id reachable), sorted."""
    sets = [shingles(t) for _, t in docs]
    label = list(range(len(docs)))
    for i in range(len(docs)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * len(sets[i] | sets[j]) and label[i] != label[j]:
                old, new = max(label[i], label[j]), min(label[i], label[j])
                label = [new if x == old else x for x in label]
    least = {}
    for (doc_id, _), x in zip(docs, label):
        if doc_id is not None:
            least[x] = min(doc_id, least.get(x, doc_id))
    return sorted((d, len(s), least.get(x)) for (d, _), s, x in zip(docs, sets, label))


def found(frame):
    return sorted((r.doc_id, r.n_shingles, r.component_id) for r in frame.collect())


def corpus(seed, n=160):
    """Copies with edits at every distance around the limit, chains, and one large group."""
    rng = random.Random(seed)

    def word():
        return rng.choice("abcdefghij") * rng.randint(1, 3) + rng.choice("xyzé")

    bases = [[word() for _ in range(rng.randint(30, 90))] for _ in range(8)]
    docs = []
    for doc_id in range(n):
        kind = rng.random()
        own = list(rng.choice(bases[:1] if kind < 0.5 else bases))
        for _ in range(rng.choice([0, 1, 1, 2, 3, 4, 5, 8])):
            own[rng.randrange(len(own))] = word()
        if kind > 0.9:
            bases.append(own)
        docs.append((doc_id, rng.choice([" ", "\n\t"]).join(own)))
    docs[5], docs[6], docs[7], docs[8] = (5, None), (6, ""), (7, " \n"), (8, "")
    docs[9], docs[10], docs[11] = (9, "one two"), (10, "ONE  two"), (11, "one two three")
    return docs


@pytest.mark.parametrize("seed", range(3))
def test_links_as_brute_force(spark, seed, monkeypatch):
    monkeypatch.setattr(circulant, "FOLLOWERS", 7)
    monkeypatch.setattr(circulant, "BLOCK", 5)
    docs = corpus(seed)
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    assert found(groups(frame)) == brute(docs)


@pytest.mark.parametrize("known", [False, True])
def test_links_across_components(spark, monkeypatch, known):
    """Buckets whose leaders say nothing, with and without a large component."""
    monkeypatch.setattr(circulant, "BLOCK", 11)
    docs = [d for d in corpus(11, 120) if shingles(d[1])]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    rows = circulant.written(frame.mapInArrow(circulant._sign(4), circulant._SIGNED), "rows")
    nodes = rows.groupBy("k1", "k2").agg(F.min("row").alias("node"), F.min("doc_id").alias("least"))
    nodes = circulant.written(nodes, "nodes")
    dealt = rows.select(F.col("row").alias("node"), F.posexplode("bands").alias("layout", "band"))
    met = dealt.join(nodes.select("node"), "node", "left_semi")
    met = met.withColumn("rep", F.lit(-1).cast("long")).withColumn("m", F.lit(99))
    wanted = {d: least for d, _, least in brute(docs)}
    roots = spark.createDataFrame([], "node long, root long")
    if known:
        largest = max(set(wanted.values()), key=list(wanted.values()).count)
        members = [d for d in wanted if wanted[d] == largest]
        own = nodes.filter(F.col("least").isin(members[: len(members) // 2]))
        roots = own.select("node", F.lit(own.agg(F.min("node")).first()[0]).alias("root"))
    held = rows.select(F.col("row").alias("node"), "text")
    more = circulant._across(met, roots, held, 4, 80)
    ids = {r.node: r.least for r in nodes.collect()}
    links = [(ids[r.a], ids[r.b]) for r in more.collect()]
    links += [(ids[r.node], ids[r.root]) for r in roots.collect()]
    label = {i: i for i in ids.values()}
    for a, b in links * len(label):
        label[a] = label[b] = min(label[a], label[b])
    assert label == {i: wanted[i] for i in label}


def test_given_documents(spark):
    docs = small_texts()
    rows = op11_circulant_minhash(spark, SMALL).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in rows) == brute(docs)
    assert all(r.kept == (r.doc_id == r.component_id) for r in rows)


def test_estimates_follow_similarity():
    rng = np.random.default_rng(3)
    for overlap in (0.2, 0.5, 0.8, 0.95):
        errors = []
        for _ in range(60):
            pool = rng.integers(0, 2**63, 400, np.uint64) * np.uint64(2)
            both = int(400 * overlap)
            half = (400 - both) // 2
            a, b = np.sort(pool[: both + half]), np.sort(np.concatenate([pool[:both], pool[both + half :]]))
            one, two = signatures([a, b])
            errors.append((one == two).mean() - both / 400)
        # Deviations of independent minima are at most 0.044 each; these must not be wider.
        assert abs(np.mean(errors)) < 0.02 and np.std(errors) < 0.055


def test_nulls_repeated_ids_and_other_columns(spark):
    long = " ".join(f"w{i}" for i in range(30))
    docs = [(3, long), (3, long), (None, long), (None, "quite another text of some words"), (1, None), (1, "x")]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    frame = frame.withColumn("row", F.lit(1)).withColumn("node", F.lit("n")).withColumn("bands", F.lit(2))
    rows = sorted(map(tuple, groups(frame).collect()), key=str)
    assert rows == sorted([(3, 27, 3), (3, 27, 3), (None, 27, 3), (None, 3, None), (1, 0, 1), (1, 1, 1)], key=str)


def test_empty_table_and_very_long_text(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert groups(none).count() == 0
    words = [f"v{i * 7919 % 400_009}" for i in range(400_000)]
    docs = [(1, " ".join(words)), (2, " ".join(words[:-9_000])), (3, " ".join(words[::-1])), (4, "A " * 500_000)]
    out = found(groups(spark.createDataFrame(docs, "doc_id long, text string")))
    assert out == [(1, 399_997, 1), (2, 390_997, 1), (3, 399_997, 3), (4, 1, 4)]


def test_sets_do_not_depend_on_the_batch():
    texts = ["a b c d e", None, "", "a b", "b c d e f", "a b c d e " * 3]
    alone = [shingle_sets(pa.array([t], pa.string()))[0].tolist() for t in texts]
    assert [s.tolist() for s in shingle_sets(pa.array(texts))] == alone
    assert [len(s) for s in alone] == [len(shingles(t)) for t in texts]
    long = pa.array([" ".join(f"W{i * 7919 % 100_003}" for i in range(n)) for n in (100_000, 99_000, 3)])
    assert [len(shingle_sets(long.slice(i, 1))[0]) for i in range(3)] == [99_997, 98_997, 1]
