"""Arrays, maps and spans."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import clean_text


def realign_entities(text: Column, entities: Column) -> Column:
    """Move entity spans from raw text onto cleaned text.

    Gives ``struct(text, entities, lost)``. Each entity is cleaned and looked up:
    its first place in the cleaned text is the new span, the label is always
    ``ORG``. Entities that are not found are dropped and counted in ``lost``.
    """

    def realign(cleaned: Column) -> Column:
        spans = F.transform(entities, lambda e: _move(text, cleaned, e))
        return F.struct(cleaned.alias("text"), spans.alias("spans"))

    # A one-element array binds the cleaned text, so that it is computed once.
    bound = F.get(F.transform(F.array(clean_text(text)), realign), F.lit(0))
    return F.get(F.transform(F.array(bound), _split_found), F.lit(0))


def _move(text: Column, cleaned: Column, entity: Column) -> Column:
    raw = F.substr(text, entity["start"] + 1, entity["end"] - entity["start"])

    def place(word: Column) -> Column:
        start = F.position(word, cleaned) - 1
        return F.struct(
            start.alias("start"),
            (start + F.length(word)).alias("end"),
            F.lit("ORG").alias("label"),
        )

    return F.get(F.transform(F.array(clean_text(raw)), place), F.lit(0))


def _split_found(bound: Column) -> Column:
    found = F.filter(bound["spans"], lambda e: e["start"] >= 0)
    return F.struct(
        bound["text"].alias("text"),
        found.alias("entities"),
        (F.size(bound["spans"]) - F.size(found)).alias("lost"),
    )


def numbered_entries(key: Column, values: Column) -> Column:
    """``[(key, v1), ("key_2: ", v2), ...]`` as an array of structs."""

    def entry(value: Column, i: Column) -> Column:
        later = F.concat(key, F.lit("_"), (i + 1).cast("string"), F.lit(": "))
        return F.struct(F.when(i == 0, key).otherwise(later).alias("key"), value.alias("value"))

    return F.transform(values, entry)


def numbered_keys(key: Column, values: Column) -> Column:
    """Values of one field as a map with numbered keys."""
    return F.map_from_entries(numbered_entries(key, values))


def zip_lists(**lists: Column) -> Column:
    """Parallel lists as one array of structs."""
    return F.arrays_zip(*[c.alias(n) for n, c in lists.items()])


def megabytes(length: Column) -> Column:
    return length / F.lit(1024 * 1024)
