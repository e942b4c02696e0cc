"""Rows and attributes of HTML pages, by regular expressions.

``text()`` below is the text straight after the opening tag of a cell, which is
what a label cell holds.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

_TAG_REST = r"(?:\s[^>]*)?>"


def _block(tag: str) -> str:
    """An element, up to its end tag or the next one of its kind."""
    return rf"(?is)<{tag}{_TAG_REST}.*?(?=<{tag}[\s>]|</{tag}\s*>|\z)"


def blocks(html: Column, tag: str) -> Column:
    """Array of the elements of one kind, text and tags included."""
    return F.regexp_extract_all(html, F.lit(_block(tag)), 0)


def labelled_blocks(html: Column, tag: str, cell: str, label: str) -> Column:
    """Blocks with a cell whose first text contains ``label``."""
    holds = rf"(?is)<{cell}{_TAG_REST}[^<]*{re.escape(label)}"
    return F.filter(blocks(html, tag), lambda b: b.rlike(holds))


def attributes(fragment: Column, tag: str, attribute: str) -> Column:
    """Values of an attribute of every element of one kind, in page order.

    The value may stand in double quotes, in single quotes or bare.
    """
    opened = rf"(?is)<{tag}\s(?:[^>\"']|\"[^\"]*\"|'[^']*')*>"
    value = rf"(?is)\s{attribute}\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))"
    tags = F.filter(
        F.regexp_extract_all(fragment, F.lit(opened), 0), lambda t: t.rlike(value)
    )
    return F.transform(
        tags,
        lambda t: F.concat(*[F.regexp_extract(t, value, g) for g in (1, 2, 3)]),
    )


_ROW, _END = "\x01", "\x02"


def outer_rows(html: Column) -> Column:
    """Array of the table rows that lie in no other row, tables inside them included.

    The page is cut before every tag of a table or row. A row goes to its end tag, the next
    row or the end of its table, of which those of tables opened within the row do not count.
    """
    cut = F.split(F.translate(html, _ROW + _END, ""), r"(?i)(?=</?(?:table|tr)[\s>])")

    def step(state: Column, piece: Column) -> Column:
        tag = F.lower(F.regexp_extract(piece, r"(?i)^(</?(?:table|tr))[\s>]", 1))
        own = state["inner"] == 0
        starts = (tag == "<tr") & (~state["open"] | own)
        ends = state["open"] & own & tag.isin("</tr", "</table")
        depth = F.when(tag == "<table", 1).when(tag == "</table", -1).otherwise(0)
        inner = F.when(starts | ends | ~state["open"], 0).otherwise(state["inner"] + depth)
        mark = F.when(starts, _ROW).when(ends, _END).otherwise("")
        return F.struct(
            F.when(starts, True).when(ends, False).otherwise(state["open"]).alias("open"),
            inner.alias("inner"),
            F.concat(state["marks"], F.array(mark)).alias("marks"),
        )

    start = F.struct(
        F.lit(False).alias("open"), F.lit(0).alias("inner"), F.array().cast("array<string>").alias("marks")
    )

    def rows(pieces: Column) -> Column:
        marks = F.aggregate(pieces, start, step, lambda state: state["marks"])
        page = F.array_join(F.zip_with(marks, pieces, lambda m, p: F.concat(m, p)), "")
        begun = F.split(page, _ROW)
        return F.transform(F.slice(begun, 2, F.size(begun)), lambda r: F.substring_index(r, _END, 1))

    # A one-element array binds the pieces, so that the page is cut once.
    return F.get(F.transform(F.array(cut), rows), F.lit(0))


def row_attributes(html: Column, label: str, attribute: str = "onclick") -> Column:
    """Anchor attributes in the table rows that carry a label cell, in page order.

    A row that holds such a cell in a table within carries it as well, so all anchors of the
    outermost row around a label count, once each.
    """
    holds = rf"(?is)<td{_TAG_REST}[^<]*{re.escape(label)}"
    rows = F.filter(outer_rows(html), lambda r: r.rlike(holds))
    return F.flatten(F.transform(rows, lambda r: attributes(r, "a", attribute)))


def strong_links(html: Column, text: str) -> Column:
    """``href`` of anchors inside ``strong`` whose address contains a text."""
    links = F.flatten(
        F.transform(blocks(html, "strong"), lambda b: attributes(b, "a", "href"))
    )
    return F.filter(links, lambda h: F.contains(h, F.lit(text)))


def inner_texts(html: Column, tag: str) -> Column:
    """Text of each element of one kind, tags removed."""
    body = F.transform(
        blocks(html, tag), lambda b: F.regexp_replace(b, rf"(?is)^<{tag}{_TAG_REST}", "")
    )
    return F.transform(body, lambda b: F.regexp_replace(b, r"(?s)<[^>]*>", ""))
