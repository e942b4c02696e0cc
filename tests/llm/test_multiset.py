import hashlib
import random

import numpy as np
import pytest
from brute import SMALL, small_texts

from noticeflow.llm.multiset import Fingerprints, compare_with_next, edited, op5_multiset_hash

from pyspark.sql import functions as F


def expected(docs):
    """doc_id: (n_chars, sha256 of the edited text), documents by descending doc_id."""
    docs = sorted(docs, key=lambda d: -d[0])
    out = {}
    for i, (doc_id, text) in enumerate(docs):
        text, other = text or "", docs[(i + 1) % len(docs)][1] or ""
        cut = len(text) // 3
        new = text[: len(text) - cut] + other[:cut]
        out[doc_id] = (len(text), hashlib.sha256(new.encode()).hexdigest(), text, new, other)
    return out


def test_given_documents(spark):
    want = expected(small_texts())
    rows = op5_multiset_hash(spark, SMALL).collect()
    assert len(rows) == len(want)
    for r in rows:
        n, sha, text, new, other = want[r.doc_id]
        assert (r.n_chars, r.edited_sha256) == (n, sha)
        one, two, three = (Fingerprints.of([t.encode()]) for t in (text, new, other))
        assert [r.fingerprint] == one.strings() and [r.edited_fingerprint] == two.strings()
        assert r.near_edited == one.like(two)[0] and r.near_next == one.like(three)[0]
    near, far = [r.near_edited for r in rows], [r.near_next for r in rows]
    assert np.mean(near) > 0.5 and np.mean(far) < 0.15
    assert np.mean([a > b for a, b in zip(near, far)]) > 0.97


def test_order_insertion_and_deletion():
    a = Fingerprints.of([b"one two three\nfour five six seven\neight"])
    b = Fingerprints.of([b"eight\n\none two three\nfour five six seven"])
    assert a.strings() == b.strings() and a.like(b)[0] == 1
    c = a + Fingerprints.of([b"nine ten"]) - Fingerprints.of([b"eight"])
    assert c.strings() == Fingerprints.of([b"nine ten\none two three\nfour five six seven"]).strings()
    assert Fingerprints.parse(c.strings()).strings() == c.strings()
    assert a.strings() != Fingerprints.of([b"one two three\nfour five six seven\neight\neight"]).strings()


def test_random_edits():
    rng = random.Random(2)
    make = lambda: "".join(rng.choice(["a ", "b ", "é ", "\n", "cc", "日 "]) for _ in range(rng.randint(0, 60)))
    old = [make() for _ in range(300)]
    new = [o[: rng.randint(0, len(o))] + make() if rng.random() < 0.8 else o for o in old]
    own = Fingerprints.of([o.encode() for o in old])
    assert edited(own, old, new).strings() == Fingerprints.of([n.encode() for n in new]).strings()


@pytest.mark.parametrize("parts", ["1", "3", "16"])
def test_every_row_meets_the_next(spark, parts):
    rng = random.Random(4)
    docs = [(rng.randrange(10**6) * 2 - 10**6, f"text {i} " * rng.randint(0, 9)) for i in range(150)]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    got = compare_with_next(spark.createDataFrame(docs, "doc_id long, text string").repartition(5)).collect()
    spark.conf.set("spark.sql.shuffle.partitions", before)
    assert {r.doc_id: r.edited_text for r in got} == {k: v[3] for k, v in expected(docs).items()}
    assert len(got) == len(docs)


def test_defined_cases(spark):
    rows = [(None, "last one", 1), (5, None, 2), (5, "abc def", 3), (5, "abc def", 3), (7, "", 4), (9, "x y z " * 9, 5)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, fingerprint int")
    got = compare_with_next(frame).collect()
    assert sorted((r.doc_id or 0, r.n_chars) for r in got) == [(0, 8), (5, 0), (5, 7), (5, 7), (7, 0), (9, 54)]
    one = [r for r in got if r.doc_id is None][0]
    assert one.edited_text == "last o" + "x "
    assert compare_with_next(frame.filter("doc_id = 9")).collect()[0].near_next == 1
    assert compare_with_next(frame.limit(0)).count() == 0
    zero = Fingerprints.of([b"", b"a"])
    assert zero[:1].like(zero[:1])[0] == 1 and zero[:1].like(zero[1:])[0] == 0
