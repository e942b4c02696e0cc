import random
import re
import zlib
from collections import Counter

import pyarrow as pa
import pytest
from brute import SMALL, small_texts

from noticeflow.llm.spelling import near, near_words, op12_spelling_variants, signatures, variants
from pyspark.sql import functions as F


def words_of(docs):
    out = Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            out[run] += 1
    return {w: n for w, n in out.items() if len(w) >= 6 and n >= 5}


def one_edit(word, alphabet):
    cut = [(word[:i], word[i:]) for i in range(len(word) + 1)]
    out = {a + b[1:] for a, b in cut if b}
    out |= {a + c + b for a, b in cut for c in alphabet} | {a + c + b[1:] for a, b in cut if b for c in alphabet}
    return out - {word}


def brute(docs):
    n = words_of(docs)
    alphabet = sorted(set("".join(n)))
    around = {w: one_edit(w, alphabet) & n.keys() for w in n}
    form = {}
    for w, others in around.items():
        best = min(others, key=lambda o: (-n[o], o), default=None)
        form[w] = best if best is not None and n[best] >= 5 * n[w] else None

    def end(w):
        while form[w] is not None:
            w = form[w]
        return w

    return sorted((w, end(w), form[w] or "", n[w], len(around[w]), n[form[w]] if form[w] else 0) for w in n)


def found(frame):
    rows = frame.select("word", "root", "form", "n", "n_near", "form_n").collect()
    return sorted((r.word, r.root, r.form or "", r.n, r.n_near, r.form_n or 0) for r in rows)


def corpus(seed):
    """Words with chains of variants: edits of edits, doubled letters, anagrams, odd letters."""
    rng = random.Random(seed)
    letters = "abcdeß×÷éÿ"
    pool = ["".join(rng.choice(letters) for _ in range(rng.randint(5, 9))) for _ in range(25)]
    for _ in range(150):
        w = rng.choice(pool)
        i, kind = rng.randrange(len(w)), rng.randint(0, 3)
        pool.append([w[:i] + w[i + 1 :], w[:i] + rng.choice(letters) + w[i:], w[:i] + rng.choice(letters) + w[i + 1 :], "".join(rng.sample(w, len(w)))][kind])
    weights = [rng.choice([1, 1, 5, 25, 200]) for _ in pool]
    docs = []
    for doc_id in range(60):
        own = rng.choices(pool, weights, k=150)
        docs.append((doc_id, rng.choice([" ", "1", "\n", "日"]).join(w.upper() if rng.random() < 0.1 else w for w in own)))
    docs[3], docs[4], docs[5] = (3, None), (4, ""), (5, docs[6][1])
    docs += [(100 + i, "chainss " * 40 + "chainsz " * 6 + "chainyz") for i in range(7)]
    return docs


@pytest.mark.parametrize("seed, block", [(0, 4096), (1, 3), (2, 20)])
def test_variants_as_brute_force(spark, seed, block):
    docs = corpus(seed)
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(6)
    want = brute(docs)
    assert found(variants(frame, block=block)) == want
    assert any(w != r and f != r for w, r, f, *_ in want)  # a chain of two forms at least


def test_given_documents(spark):
    want = brute(small_texts())
    assert found(op12_spelling_variants(spark, SMALL)) == want
    assert any(n for *_, n, _ in want)


def test_near_words_share_a_signature():
    rng = random.Random(5)
    for _ in range(300):
        word = "".join(rng.choice("aabcdeé") for _ in range(rng.randint(1, 12)))
        others = sorted(one_edit(word, "abz"))
        own, *rest = signatures([word, *others])
        assert all(set(own.tolist()) & set(r.tolist()) for r in rest)
        assert all(near(word, o) and near(o, word) for o in others)
    assert not near("abcdef", "abdcef") and not near("abc", "abc") and not near("abcde", "abc")


def test_hot_signature(spark):
    """Anagrams share all signatures; they are dealt by what is left of them."""
    rng = random.Random(9)
    pool = sorted({"".join(rng.sample("aabbccdd", 8)) for _ in range(900)} | {"aabbccddx", "aabbccd", "aabbccdx"})
    frame = spark.createDataFrame([(w, i + 5) for i, w in enumerate(pool)], "word string, n long")
    pairs = {(r.a, r.b) for r in near_words(frame, block=50).collect()}
    want = {(w, o) for w in pool for o in one_edit(w, "abcdx") & set(pool) if w < o}
    assert pairs == want and len(want) >= 4


def test_nulls_repeats_other_columns_and_empty(spark):
    rows = [(None, "wordword " * 5), (1, None), (2, "wordwort " * 3), (2, "wordwort " * 3), (2, "ab cd")]
    frame = spark.createDataFrame(rows, "doc_id long, text string").withColumn("word", F.lit("x")).withColumn("n", F.lit(1))
    assert found(variants(frame)) == brute(rows)
    assert variants(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_very_long_words(spark):
    rng = random.Random(2)
    word = "".join(rng.choice("abcdefgh") for _ in range(100_000))
    rows = [(i, " ".join([word, word[:50_000] + word[50_001:], word[:-1] + "z"])) for i in range(6)]
    out = found(variants(spark.createDataFrame(rows, "doc_id long, text string")))
    want = words_of(rows)
    assert [(w, n, k) for w, _, _, n, k, _ in out] == sorted((w, n, sum(near(w, o) for o in want)) for w, n in want.items())


def test_counts_of_one_text_do_not_depend_on_the_batch():
    from noticeflow.llm.spelling import _count

    batch = pa.record_batch({"doc_id": pa.array([1, 1], pa.int64()), "text": ["longish word, longish", None]})
    assert [b.to_pydict() for b in _count([batch])] == [{"word": ["longish"], "n": [2]}]
