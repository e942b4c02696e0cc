import re

from pyspark.sql import functions as F

from noticeflow.functions import legal

T = F.col("t")
NAMES = [
    "Acme S.A. de C.V.", "FOO, S. DE R.L. DE C.V.", "Teatro Scala", "plain co", "X S.A.DE C.V.",
    "Uno SC", "Beta SAPI de CV", "Gamma S. en C. por A.", "Casa del Árbol, A.C.", "SOFOM Uno SOFOM ENR",
    "Delta S EN N C", "Omega\nS.C.", "Zeta S.C.\n", "Ñandú S.A.S.", "", "Banco B V", "a s.a. c. v. Ñ",
]


def _strip(name):
    endings = legal.endings_pattern(legal.STRIP_FIRST)
    if not re.search(endings, name.upper(), re.I):
        return name
    bare = re.sub(legal.DENOMINATION, "", name.upper(), flags=re.I)
    return re.sub(endings, "", bare, flags=re.I)


def test_strip_agrees_with_python_on_the_patterns(evaluate):
    assert evaluate(NAMES, legal.strip_legal_form(T)) == [_strip(n) for n in NAMES]


def test_strip_by_hand(evaluate):
    given = ["Acme S.A. de C.V.", "Teatro Scala", "plain co", "X S.A.DE"]
    assert evaluate(given, legal.strip_legal_form(T)) == ["ACME", "TEATROALA", "plain co", "X S.A.DE"]


def test_split_agrees_with_python_on_the_patterns(evaluate):
    from noticeflow.functions.text import clean_by_format

    cleaned = evaluate(NAMES, clean_by_format(T, "nombres"))
    want = [
        [
            re.sub(legal.DENOMINATION, "", piece)
            for piece in re.split(legal.endings_pattern(legal.SPLIT_FIRST), name)
            if piece
        ]
        for name in cleaned
    ]
    assert evaluate(NAMES, legal.split_legal_form(T)) == want


def test_split_by_hand(evaluate):
    given = ["Uno SC", "plain co", "Acme S.A. de C.V."]
    # The final form is captured twice; its denomination is then removed.
    assert evaluate(given, legal.split_legal_form(T)) == [
        ["UNO", "", ""],
        ["PLAIN CO"],
        ["ACME", " DE", ""],
    ]
