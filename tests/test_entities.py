"""Entities by position: against a plain search, repeats and long texts included."""

import random
import re
import time
import tracemalloc
import unicodedata

import pyarrow as pa
import pyarrow.compute as pc
import pytest
from pyspark.sql import functions as F

from noticeflow.functions import nested
from noticeflow.operators.entities import _cut, first_places, portions, realign, word_spans

SPANS = "i long, text string, entities array<struct<start:int,end:int,label:string>>"


@pytest.mark.parametrize("searched", [0, 10**9])
def test_first_places(searched):
    rng = random.Random(1)
    for _ in range(300):
        text = "".join(rng.choice("ab ") for _ in range(rng.randint(0, 40)))
        words = ["".join(rng.choice("ab ") for _ in range(rng.randint(0, 4))) for _ in range(8)]
        assert first_places(text, words, searched) == [text.find(w) for w in words]


def _texts():
    rng = random.Random(2)
    pieces = ["Grupo", "Á,", "año", "an", "ñ", "cá", "😀", "x-y", "S.A.", "  ", "\n", "\x1c", "ß"]
    texts = [" ".join(rng.choice(pieces) for _ in range(rng.randint(0, 30))) for _ in range(60)]
    return [*texts, None, "", "   "]


def test_as_the_column_function(spark):
    """The same as a search per entity, for words and for spans that cut through words."""
    rng, rows = random.Random(3), []
    for i, t in enumerate(_texts()):
        spans = [m.span() for m in re.finditer(r"\S+", t or "")]
        spans += [tuple(sorted(rng.sample(range(len(t) + 1), 2))) for _ in range(5) if t]
        rows.append((i, t, [(a, b, "X") for a, b in spans]))
    frame = spark.createDataFrame(rows, SPANS)
    moved = {r.i: r.realigned for r in realign(frame).collect()}
    plain = frame.select("i", nested.realign_entities(F.col("text"), F.col("entities")).alias("r")).collect()
    for r in plain:
        if rows[r.i][1] is None:
            assert moved[r.i] is None
        else:
            assert moved[r.i] == r.r
    assert any(m is not None and m.lost for m in moved.values())
    assert realign(frame.withColumn("entities", F.lit(None).cast(frame.schema["entities"].dataType))).filter("realigned IS NOT NULL").count() == 0
    assert realign(frame.limit(0)).count() == 0


def test_word_spans(spark):
    texts = _texts()
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i long, text string")
    for r in frame.select("i", word_spans(F.col("text")).alias("s")).collect():
        if texts[r.i] is None:
            assert r.s is None
        else:
            want = [m.span() for m in re.finditer(r"[^\x20\x09-\x0D]+", texts[r.i])]
            assert [(e.start, e.end) for e in r.s] == want
    assert unicodedata.normalize("NFC", "ñ") == "ñ"


def test_time_follows_the_length():
    """All words of a long text, most of them distinct: four times the text, about four times the time."""
    rng = random.Random(4)

    def seconds(n):
        words = ["".join(rng.choice("abcdefghij") for _ in range(6)) for _ in range(n)]
        text, start = " ".join(words), time.perf_counter()
        places = first_places(text, words)
        spent = time.perf_counter() - start
        assert all(text[p : p + 6] == w for p, w in zip(places, words)) and places[-1] == text.find(words[-1])
        return spent

    seconds(5_000)
    assert seconds(160_000) < 10 * seconds(40_000)


def test_portions():
    texts = pa.array(["ab", None, "", "cdefgh", "i", "jklmn", "o"])
    rows = pa.array(range(7))
    parts = [(t.to_pylist(), r.to_pylist()) for t, r in portions((texts, rows), most=3)]
    assert parts == [(["ab", None, ""], [0, 1, 2]), (["cdefgh"], [3]), (["i"], [4]), (["jklmn"], [5]), (["o"], [6])]
    assert not list(portions((texts.slice(7), rows.slice(7))))


def test_words_of_a_batch_are_taken_in_portions():
    """The objects of a batch of many texts, all words distinct, stay far below those of all its words."""
    words = [f"{i:07d}" for i in range(400_000)]
    texts = pa.array([" ".join(words[i : i + 400]) for i in range(0, len(words), 400)])
    cut = _cut.func
    starts = pa.array(list(range(0, 3200, 8)) * len(texts), pa.int32())
    whole = pa.StructArray.from_arrays([starts, pc.add(starts, 7)], names=["start", "end"])
    lists = pa.ListArray.from_arrays(pa.array(range(0, len(words) + 1, 400), pa.int32()), whole)
    tracemalloc.start()
    try:
        found = [n for part in cut(iter([(texts, lists)])) for n in part.field("words").value_lengths().to_pylist()]
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert found == [400] * 1000
    assert peak < 30_000_000
