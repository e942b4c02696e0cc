"""Text cleaning as native column expressions.

The character classes follow Unicode the way the notice data was first cleaned:
a *word* character is a letter, a number or ``_``; *white space* is every
character Python's ``str.isspace`` accepts.
"""

from __future__ import annotations

import sys
import unicodedata
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values: the letters that lose their accent, in order --------------
ACCENTED = "ÁÉÍÓÚáéíóúÀÈÌÒÙàèìòù"
PLAIN = "AEIOUaeiouAEIOUaeiou"

# --- fixed values: characters each cleaning format turns into a space --------
FORMAT_DROPS = {
    "alfanumericopuntos": r"[^a-zA-Z0-9.,:\nñÑ ]",
    "alfabetopuntos": r"[^a-zA-Z.,:Ññ ]",
    "licitantes": r"[^a-zA-ZÑñ ]",
    "alfabeto_min": r"[^a-zñÑ ]",
    "alfa_min": r"[^a-zñ ]",
    "nombres": r"[.,:]",
}

WHITESPACE = "".join(chr(c) for c in range(sys.maxunicode + 1) if chr(c).isspace())
SPACE_SET = "".join(f"\\x{{{ord(c):x}}}" for c in WHITESPACE)
_BLANK = r"\x{20}"
# The same class, laid out so that ASCII letters fail after two comparisons.
_WIDE_SPACE = "".join(f"\\x{{{ord(c):x}}}" for c in WHITESPACE if ord(c) >= 0x80)
SPACE = rf"[\t-\r\x1c-\x20[\x{{80}}-\x{{10ffff}}&&[{_WIDE_SPACE}]]]"
WORD = r"[\p{L}\p{N}_]"
# A word boundary spelled out, as Java's own \b counts marks as letters.
BOUNDARY = f"(?:(?<={WORD})(?!{WORD})|(?<!{WORD})(?={WORD}))"
# White space a format can leave besides single blanks.
_FORMAT_SPACE = {"alfanumericopuntos": "[ \n]", "nombres": SPACE}


@lru_cache(maxsize=1)
def composable() -> str:
    """Class of characters that may change when text is composed (NFC).

    Marks and the trailing Hangul letters can join the character before them;
    the rest are the characters whose composed form is another character.
    """
    ranges: list[list[int]] = []
    for code in range(0x80, sys.maxunicode + 1):
        char = chr(code)
        if unicodedata.category(char)[0] == "M" or unicodedata.is_normalized("NFC", char):
            continue
        if ranges and ranges[-1][1] == code - 1:
            ranges[-1][1] = code
        else:
            ranges.append([code, code])
    singles = "".join(f"\\x{{{lo:x}}}-\\x{{{hi:x}}}" for lo, hi in ranges)
    marks = r"\p{M}\x{1161}-\x{1175}\x{11a8}-\x{11c2}"
    # None lies below U+0300, so Latin text leaves at the first comparison.
    return rf"[\x{{300}}-\x{{10ffff}}&&[{marks}{singles}]]"


def compose(text: Column) -> Column:
    """Unicode NFC inside the JVM, by the ICU library that Spark ships."""
    return F.reflect(
        F.lit("com.ibm.icu.text.Normalizer"), F.lit("compose"), text, F.lit(False)
    )


def strip(text: Column) -> Column:
    """Remove white space of any kind at both ends."""
    return F.trim(text, F.lit(WHITESPACE))


def squeeze(text: Column) -> Column:
    """Each run of blanks becomes one blank."""
    return F.regexp_replace(text, " {2,}", " ")


def fold_accents(text: Column) -> Column:
    """Compose, drop acute and grave accents from vowels, strip.

    ``ñ``, ``ü``, ``ç`` and ``â`` stay. Almost every row is already composed and
    takes one ``translate``, and only if it holds such a vowel. The others are composed
    again before each letter, so that a second mark on a folded vowel joins it as it should.
    """

    def drop_one(acc: Column, i: Column) -> Column:
        accented, plain = (F.substr(F.lit(s), i, F.lit(1)) for s in (ACCENTED, PLAIN))
        return F.replace(compose(acc), accented, plain)

    positions = F.sequence(F.lit(1), F.lit(len(ACCENTED)))
    folded = (
        F.when(text.rlike(composable()), F.aggregate(positions, text, drop_one))
        .when(text.rlike(f"[{ACCENTED}]"), F.translate(text, ACCENTED, PLAIN))
        .otherwise(text)
    )
    return strip(folded)


def fold_header(name: str) -> str:
    """``fold_accents`` for one column name, on the driver."""
    for accented, plain in zip(ACCENTED, PLAIN):
        name = unicodedata.normalize("NFC", name).replace(accented, plain)
    return name.strip()


# Runs of blanks and of what is neither an ASCII letter or digit nor other white space.
_NOT_CLEAN = f"[^a-zA-Z0-9{SPACE_SET.replace(_BLANK, '')}]+"


def _blanked(drops: str) -> str:
    """Runs of dropped characters and blanks, from the class of dropped characters."""
    if drops.startswith("[^"):
        return drops.removesuffix(" ]") + "]+"
    return drops.removesuffix("]") + " ]+"


def clean_text(text: Column) -> Column:
    """Fold accents; keep ASCII letters, digits and white space."""
    return strip(F.regexp_replace(fold_accents(text), _NOT_CLEAN, " "))


def join_lines(text: Column) -> Column:
    """Single line breaks become blanks; runs of them shrink."""
    text = squeeze(F.regexp_replace(text, r"\n(?!\n)", " "))
    return F.regexp_replace(text, r"(\n )+", "\n")


def drop_x_runs(text: Column) -> Column:
    """Delete filler: three or more ``X``, or two before a word character."""
    return F.regexp_replace(text, f"X{{3,}}|XX(?={WORD})", "")


_PREPARE = {
    "licitantes": F.upper,
    "alfabeto_min": F.lower,
    "alfa_min": lambda c: F.regexp_replace(F.lower(c), r"[.,:\n\t]+", ""),
    "nombres": lambda c: drop_x_runs(F.upper(c)),
}


def clean_by_format(text: Column, fmt: str = "alfabetopuntos") -> Column:
    """Clean by a named format; an unknown name is an error."""
    if fmt not in FORMAT_DROPS:
        raise ValueError(f"unknown format {fmt!r}; one of {sorted(FORMAT_DROPS)}")
    text = _PREPARE.get(fmt, lambda c: c)(text)
    text = strip(F.regexp_replace(fold_accents(text), _blanked(FORMAT_DROPS[fmt]), " "))
    if fmt in _FORMAT_SPACE:
        space = _FORMAT_SPACE[fmt]
        text = F.regexp_replace(text, f"{space}+(?={space})", "")
    return text


def remove_char(text: Column, char: str = "'") -> Column:
    return F.replace(text, F.lit(char), F.lit(""))


def prepare_state(name: Column) -> Column:
    """State name as the state dimension spells it."""
    return clean_by_format(F.upper(name))


def zero_pad(text: Column, width: int = 2) -> Column:
    """Pad with zeros; longer text is left whole (``lpad`` alone would cut it).

    A leading sign stays in front, as for numbers.
    """
    padded = F.when(
        text.rlike(r"^[+-]"),
        F.concat(
            F.substring(text, 1, 1),
            F.lpad(F.substr(text, F.lit(2)), width - 1, "0"),
        ),
    ).otherwise(F.lpad(text, width, "0"))
    return F.when(F.length(text) < width, padded).otherwise(text)
