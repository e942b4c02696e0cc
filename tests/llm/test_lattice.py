import math

import numpy as np
import pandas as pd
import pyarrow as pa
import public_tokenizers
import pytest
from brute import SMALL, crc_mod, small_texts

from noticeflow.llm import common
from noticeflow.llm.lattice import Lattice, Pieces, op3_lattice_scores, score_texts, train_pieces

WORDS = ["a", "ab", "abab", "bababa", "c", "abcab", "é", "", "aaaaaaaaaaaa"]


def toy():
    opens, others = [b"", b"a", b"ab"], [bytes([b]) for b in range(256)] + [b"ab", b"ba", b"aba"]
    weights = np.random.default_rng(0).random(len(opens) + len(others) + 1)
    return Pieces([*opens, *others, b""], len(opens), weights / weights.sum())


def segmentations(pieces, word, opened=False):
    """All piece sequences of a word."""
    if not word and opened:
        yield ()
    kind = range(pieces.openers, len(pieces.contents) - 1) if opened else range(pieces.openers)
    for i in kind:
        content = pieces.contents[i]
        if word.startswith(content) and (content or not opened):
            for rest in segmentations(pieces, word[len(content) :], True):
                yield (i, *rest)


def test_sums_over_all_segmentations():
    pieces = toy()
    counts = np.arange(1.0, len(WORDS) + 1)
    got, uses = Lattice(pieces).run(pa.array(WORDS), counts)
    want = np.zeros(len(pieces.contents))
    for word, value, count in zip(WORDS, got, counts):
        ways = [(s, math.prod(pieces.weights[i] for i in s)) for s in segmentations(pieces, word.encode())]
        total = sum(p for _, p in ways)
        assert value == pytest.approx(math.log(total))
        for s, p in ways:
            for i in s:
                want[i] += count * p / total
    assert uses == pytest.approx(want)


def test_long_words_do_not_underflow():
    pieces = toy()
    got, _ = Lattice(pieces).run(pa.array(["z" * 5000, "ab" * 3000]))
    assert np.isfinite(got).all() and got[0] < -5000


def test_training_raises_the_likelihood(spark):
    frame = spark.createDataFrame([("abab", 9), ("ba", 4), ("c", 1)], "word string, trained long")
    before, values = toy(), []
    for rounds in range(4):
        pieces = train_pieces(frame, 5, before, rounds)
        got, _ = Lattice(pieces).run(pa.array(["abab", "ba", "c"]))
        values.append(float(got @ np.array([9, 4, 1])) + 5 * math.log(pieces.weights[-1]))
        assert pieces.weights.sum() == pytest.approx(1)
    assert values == sorted(values)


def test_given_documents(spark):
    """Counts and base score against plain Python; the score against words one by one."""
    docs = small_texts()
    tokens = {d: [w.decode() for w in (t or "").encode().lower().split()] + [None] for d, t in docs}
    train = pd.Series([w or "\n" for d, own in tokens.items() if crc_mod(d, 5) != 1 for w in own]).value_counts()
    n, v = int(train.sum()), len(train)
    rows = op3_lattice_scores(spark, SMALL).collect()
    assert len(rows) == len(docs)
    for r in rows:
        counts = [int(train.get(w or "\n", 0)) for w in tokens[r.doc_id]]
        base = sum(math.log10((c + 0.5) / (n + 0.5 * (v + 1))) for c in counts)
        assert r.base_score == pytest.approx(base)
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(counts), sum(c > 0 for c in counts), n)
        assert r.held_out == (crc_mod(r.doc_id, 5) == 1)
    held = [r for r in rows if r.held_out]
    per_token = [sum(x) / sum(r.n_tokens for r in held) for x in ([r.score for r in held], [r.base_score for r in held])]
    print("log10 per token, lattice and base:", per_token)
    assert -8 < per_token[0] < 0


def test_joined_words_add_the_same(spark):
    pieces = Pieces.of_sentencepiece(public_tokenizers.path("piece_bpe_32k.model"))
    frame = spark.read.parquet(f"{SMALL}/documents.parquet").selectExpr("doc_id", "text", "doc_id % 5 = 1 held_out")
    one = {r.doc_id: r for r in score_texts(frame, pieces).collect()}
    two = {r.doc_id: r for r in score_texts(frame, pieces, frequent=50).collect()}
    assert one.keys() == two.keys()
    for key, r in one.items():
        assert tuple(r) == pytest.approx(tuple(two[key]))


def test_defined_cases(spark):
    pieces = Pieces.of_sentencepiece(public_tokenizers.path("piece_bpe_32k.model"))
    rows = [(1, None, False, 1), (2, "", True, 2), (None, "A b a", False, 3), (3, "zz", True, 4), (3, "zz", True, 4)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, held_out boolean, word int")
    got = sorted((r.doc_id or 0, r.n_tokens, r.n_known, r.train_tokens) for r in score_texts(frame, pieces).collect())
    assert got == [(0, 4, 4, 5), (1, 1, 1, 5), (2, 1, 1, 5), (3, 2, 1, 5), (3, 2, 1, 5)]
    lone = score_texts(frame.filter("held_out"), pieces).collect()
    assert {(r.base_score, r.n_known, r.train_tokens) for r in lone} == {(0.0, 0, 0)}
    assert score_texts(frame.limit(0), pieces).count() == 0


def test_lookups_share_the_powers_and_probe_on(monkeypatch):
    """Powers as long as all the words are made once a run; pieces that met another's slot are found."""
    calls, plain = [], common._powers
    monkeypatch.setattr(common, "_powers", lambda n: calls.append(n) or plain(n))
    contents = [b"", *(bytes([97 + i, 97 + j]) for i in range(8) for j in range(8)), *(bytes([b]) for b in range(256)), b""]
    lattice = Lattice(Pieces(contents, 65, np.full(len(contents), 1 / len(contents))))
    words = pa.array([a + b + c for a in "abcdefgh" for b in "abcdefgh" for c in ("", "xyz", "xyzxyzxyz")])
    lattice.run(words)
    total = sum(map(len, words.to_pylist()))
    assert len([n for n in calls if n >= total]) <= 2
    hashes = common.byte_hashes(np.frombuffer(b"".join(contents[1:65]), np.uint8), np.arange(2, 130, 2))
    lattice.tables[0] = _crowded(hashes)
    assert lattice._find(0, hashes.reshape(2, 32)).ravel().tolist() == list(range(1, 65))
    assert (lattice._find(0, hashes + np.uint64(1 << 40)) == -1).all()


def _crowded(hashes):
    """A table of 128 slots, so that many pieces lie behind their slot."""
    piece, owner = np.full(128, -1, np.int32), np.zeros(128, np.uint64)
    for i, value in enumerate(hashes.tolist()):
        at = value % 128
        while piece[at] != -1:
            at = (at + 1) % 128
        piece[at], owner[at] = i + 1, value
    return piece, owner, 128
