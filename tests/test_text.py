"""Hand-worked values, and agreement with Python on the same fixed patterns."""

import re
import unicodedata

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from noticeflow.functions import text

T = F.col("t")


def test_accents(evaluate):
    given_ = ["Á", "ñ", "ü", "ç", "é", "ñ", "\t é 　", "ÀÈÌÒÙàèìòù", "â", "", None]
    want = ["A", "ñ", "ü", "ç", "e", "ñ", "e", "AEIOUaeiou", "â", "", None]
    assert evaluate(given_, text.fold_accents(T)) == want


def test_second_mark_joins_the_folded_vowel(evaluate):
    # a + acute + circumflex: the acute goes, the circumflex then composes.
    assert evaluate(["á̂", "Å", "한"], text.fold_accents(T)) == [
        "â",
        "Å",
        "한",
    ]


def test_headers():
    assert text.fold_header(" Código del último ") == "Codigo del ultimo"
    assert text.fold_header("año") == "año"


def test_clean_text(evaluate):
    given_ = ["Niño,  año\n\nx", "  a--b  ", "é\tz", "ß"]
    assert evaluate(given_, text.clean_text(T)) == ["Ni o a o\n\nx", "a b", "e\tz", ""]


def test_join_lines(evaluate):
    given_ = ["a\nb", "a\n\nb", "a\n\n\nb", "a\n \nb", "a\n\n", "\n"]
    assert evaluate(given_, text.join_lines(T)) == ["a b", "a\nb", "a\n\nb", "a b", "a\n", " "]


@pytest.mark.parametrize(
    ("fmt", "given_", "want"),
    [
        ("alfanumericopuntos", "Año 12: a.b,c\n\n d!", "Año 12: a.b,c d"),
        ("alfanumericopuntos", "a \n\nd", "a\nd"),
        ("alfabetopuntos", "Año 12: a.b,c\nd!", "Año : a.b,c d"),
        ("licitantes", "Niño 3 ü x.", "NIÑO X"),
        ("alfabeto_min", "Niño 3 Ü x.", "niño x"),
        ("alfa_min", "A.b, C:d\ne f", "ab cde f"),
        ("nombres", "XXX a XXI b XX", "A I B XX"),
        ("nombres", "XXÑ X a.b", "Ñ X A B"),
        ("nombres", "xxxx", ""),
    ],
)
def test_formats(evaluate, fmt, given_, want):
    assert evaluate([given_], text.clean_by_format(T, fmt)) == [want]


def test_unknown_format():
    with pytest.raises(ValueError):
        text.clean_by_format(T, "other")


def test_zero_pad(evaluate):
    given_ = ["1", "12", "123", "", "-1", None]
    assert evaluate(given_, text.zero_pad(T, 2)) == ["01", "12", "123", "00", "-1", None]
    assert evaluate(["-1", "+1"], text.zero_pad(T, 4)) == ["-001", "+001"]


_ALPHABET = "aAbXéÉíñÑüçß́̂̃ \n\t.,:'  1_-"
_TEXTS = st.lists(st.text(_ALPHABET, max_size=12), min_size=1, max_size=30)
_SLOW = settings(
    max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)


@_SLOW
@given(_TEXTS)
def test_composes_like_python(evaluate, texts):
    want = [unicodedata.normalize("NFC", t) for t in texts]
    gated = F.when(T.rlike(text.composable()), text.compose(T)).otherwise(T)
    assert evaluate(texts, gated) == want


@_SLOW
@given(_TEXTS)
def test_x_runs_and_strip_like_python(evaluate, texts):
    runs = [re.sub(r"X{3,}|XX(?=\w)", "", t) for t in texts]
    got = evaluate(texts, text.drop_x_runs(T), text.strip(T))
    assert got == [(r, t.strip()) for r, t in zip(runs, texts)]


@_SLOW
@given(_TEXTS)
def test_default_format_is_idempotent(evaluate, texts):
    once = text.clean_by_format(T)
    first = evaluate(texts, once)
    assert evaluate(first, once) == first


def test_every_unstable_character_is_seen(evaluate):
    unstable = [
        chr(c) for c in range(0x300, 0x30000) if unicodedata.normalize("NFC", chr(c)) != chr(c)
    ]
    assert all(evaluate(unstable, T.rlike(text.composable())))
