"""Entity spans of raw texts moved onto the cleaned texts, at a cost that follows the text.

Cutting spans out of a text and finding where their cleaned words first occur in the cleaned
text are the two steps that a search per entity makes quadratic in long texts. Here a span is
a slice by position, and places come from one pass: distinct words of a short text are each
found by a search that stays short, those of a long one by an automaton of all of them
(Aho-Corasick) that reads the text once. Both give the same places. Texts and words are cleaned
by the JVM in between, each distinct word of a text once.

The Arrow batches that Spark hands over hold thousands of texts; Python takes them in portions of
``PORTION`` bytes, so a task holds the words of one portion, or of one longer text, as objects.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator
from itertools import accumulate

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import clean_text

# Characters of text times distinct words up to which single searches are the shorter way.
SEARCHED = 4_000_000
# Bytes of text whose words are Python objects at a time.
PORTION = 1 << 20
# Types as objects: workers import this module, and cannot parse a type's text.
_INTS = T.ArrayType(T.IntegerType())
_SPANS = T.ArrayType(
    T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType()), T.StructField("label", T.StringType())])
)
_CUT = T.StructType([T.StructField("words", T.ArrayType(T.StringType())), T.StructField("which", _INTS)])


def first_places(text: str, words: list[str], searched: int = SEARCHED) -> list[int]:
    """Where each word first occurs in a text, -1 if it does not; an empty word does at 0."""
    if len(text) * len(words) <= searched:
        return [text.find(w) for w in words]
    places = {w: -1 for w in words}
    found = ahocorasick.Automaton()
    for w in places:
        if w:
            found.add_word(w, w)
        else:
            places[w] = 0
    left = len(found)
    if left:
        found.make_automaton()
        for end, w in found.iter(text):
            if places[w] < 0:
                places[w] = end + 1 - len(w)
                left -= 1
                if not left:
                    break
    return [places[w] for w in words]


def _lists(counts: list[int | None], flat: pa.Array) -> pa.ListArray:
    """Lists of given lengths from their values end to end; None makes a NULL."""
    ends = [0, *accumulate(n or 0 for n in counts)]
    offsets = [None if n is None else begin for n, begin in zip(counts, ends)]
    return pa.ListArray.from_arrays(pa.array([*offsets, ends[-1]], pa.int32()), flat)


def portions(columns: tuple[pa.Array, ...], most: int = PORTION) -> Iterator[tuple[pa.Array, ...]]:
    """Slices of equally long columns, the first of them texts, with up to ``most`` bytes of text or one row."""
    start = size = 0
    for i, n in enumerate(pc.fill_null(pc.binary_length(columns[0]), 0).to_pylist()):
        if i > start and size + n > most:
            yield tuple(c.slice(start, i - start) for c in columns)
            start, size = i, 0
        size += n
    if start < len(columns[0]):
        yield tuple(c.slice(start) for c in columns)


def _ints(values: array) -> pa.Array:
    return pa.array(np.frombuffer(values, np.int32))


def word_spans(text: Column, pattern: str = r"[^\x20\x09-\x0D]+", label: str = "WORD") -> Column:
    """``array<struct<start, end, label>>`` of all matches of a pattern; NULL for no text."""

    @F.arrow_udf(_SPANS)
    def spans(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        find = re.compile(pattern).finditer
        for (texts,) in (part for batch in batches for part in portions((batch,))):
            starts, ends, counts = array("i"), array("i"), []
            for t in texts.to_pylist():
                before = len(starts)
                for m in () if t is None else find(t):
                    starts.append(m.start())
                    ends.append(m.end())
                counts.append(None if t is None else len(starts) - before)
            labels = pa.array([label] * len(starts), pa.string())
            flat = pa.StructArray.from_arrays([_ints(starts), _ints(ends), labels], names=["start", "end", "label"])
            yield _lists(counts, flat)

    return spans.asNondeterministic()(text)


@F.arrow_udf(_CUT)
def _cut(batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
    """The distinct words of each text's spans, and for every span which one it is."""
    for texts, spans in (part for batch in batches for part in portions(batch)):
        flat = spans.flatten()
        starts, ends = (flat.field(c).to_pylist() for c in ("start", "end"))
        at, n_words, n_spans, words, which = 0, [], [], [], array("i")
        for t, n in zip(texts.to_pylist(), spans.value_lengths().to_pylist()):
            if n is None or t is None:
                n_words.append(None)
                n_spans.append(None)
            else:
                index: dict[str, int] = {}
                cuts = map(slice, starts[at : at + n], ends[at : at + n])
                which.extend(index.setdefault(w, len(index)) for w in map(t.__getitem__, cuts))
                words += index
                n_words.append(len(index))
                n_spans.append(n)
            at += n or 0
        lists = [_lists(n_words, pa.array(words, pa.string())), _lists(n_spans, _ints(which))]
        yield pa.StructArray.from_arrays(lists, names=["words", "which"])


@F.arrow_udf(_INTS)
def _places(batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
    for texts, words in (part for batch in batches for part in portions(batch)):
        counts, flat = [], array("i")
        for t, own in zip(texts.to_pylist(), words.to_pylist()):
            counts.append(None if t is None or own is None else len(own))
            if counts[-1]:
                flat.extend(first_places(t, own))
        yield _lists(counts, _ints(flat))


def realign(rows: DataFrame, text: str = "text", entities: str = "entities") -> DataFrame:
    """Rows with ``realigned``: the cleaned text, its entities, and how many were lost.

    The counterpart of ``functions.nested.realign_entities`` for whole tables. The first place of
    an entity's cleaned text is the new span, the label is always ``ORG``. Entities that are not
    found are dropped and counted in ``lost``; the others keep their order, repeats included.
    Without text or entities the result is NULL.
    """
    # Not deterministic as far as the optimizer goes, which else runs them again for every use.
    cut_once, places_once = _cut.asNondeterministic(), _places.asNondeterministic()
    cut = rows.withColumn("_cut", cut_once(F.col(text), F.col(entities)))
    cleaned = cut.withColumns({"_clean": clean_text(F.col(text)), "_forms": F.transform("_cut.words", clean_text)})
    placed = cleaned.withColumn("_at", places_once("_clean", "_forms"))

    def span(i: Column) -> Column:
        start = F.get("_at", i)
        return F.struct(
            start.alias("start"), (start + F.length(F.get("_forms", i))).alias("end"), F.lit("ORG").alias("label")
        )

    found = F.filter("_cut.which", lambda i: F.get("_at", i) >= 0)
    lost = F.size("_cut.which") - F.size(found)
    result = F.struct(F.col("_clean").alias("text"), F.transform(found, span).alias("entities"), lost.alias("lost"))
    return placed.select(*rows.columns, F.when(F.col("_at").isNotNull(), result).alias("realigned"))
