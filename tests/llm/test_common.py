import random

import pyarrow as pa

from noticeflow.llm.common import split_words, text_chunks


def test_words_and_hashes():
    rng = random.Random(1)
    texts = ["".join(rng.choice(["a", "bé", " ", "\n", "\x0b", "\x1c", "\xa0", "日"]) for _ in range(rng.randint(0, 40))) for _ in range(500)]
    texts[3] = None
    words, counts, hashes = split_words(pa.array(texts)[1:])
    want = [(t or "").encode().split() for t in texts[1:]]
    assert counts.tolist() == [len(w) for w in want]
    flat = [w.decode() for own in want for w in own]
    assert words.to_pylist() == flat
    by_word = {}
    for word, value in zip(flat, hashes.tolist()):
        assert by_word.setdefault(word, value) == value
    assert len(set(by_word.values())) == len(by_word)
    again = split_words(pa.array(["x " + flat[5] + " " + flat[0]]))[2]
    assert again.tolist()[1:] == [by_word[flat[5]], by_word[flat[0]]]
    assert len(split_words(pa.array([None, ""]))[2]) == 0


def test_chunks_keep_all_rows():
    batch = pa.record_batch({"text": ["a" * n for n in (5, 100, 1, 1, 1, 50)] + [None]})
    parts = list(text_chunks([batch, batch.slice(0, 0)], limit=10))
    assert [r for p in parts for r in p.column("text").to_pylist()] == batch.column("text").to_pylist()
    assert max(p.num_rows for p in parts) <= 4
