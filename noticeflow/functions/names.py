"""Identifiers in URLs, file names and archive paths."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schema import DOCUMENT_FOLDER, DOCUMENT_KIND
from .text import WORD, zero_pad


def url_id(url: Column, parameter: str = "opportunityId") -> Column:
    """Digits after ``parameter=``, first match; NULL where there are none."""
    found = F.regexp_extract(url, parameter + r"=(\p{Nd}+)", 1)
    return F.nullif(found, F.lit(""))


def link_target(onclick: Column, base: Column | str) -> Column:
    """Absolute address in a quoted call; it must have exactly three pieces."""
    pieces = F.split(onclick, "'", -1)
    prefix = base if isinstance(base, Column) else F.lit(base)
    return F.when(F.size(pieces) == 3, F.concat(prefix, F.get(pieces, F.lit(1))))


def document_base(opp: Column, code: Column, yearmonth: Column, kind: str = DOCUMENT_KIND):
    """``kind_id_code_yyyymm``."""
    return F.concat_ws("_", F.lit(kind), opp.cast("string"), code, yearmonth)


def document_name(base: Column, seq: Column, ext: Column) -> Column:
    return F.concat(base, F.lit("_"), seq.cast("string"), F.lit("."), ext)


def extension(header: Column) -> Column:
    """Last dot-separated piece of a header value."""
    return F.element_at(F.split(header, r"\.", -1), -1)


def archive_path(year: Column, month: Column, name: Column, folder: str = DOCUMENT_FOLDER):
    return F.concat_ws("/", F.lit(folder), year, zero_pad(month), name)


def base_name(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/]*)\z", 1)


def name_part(name: Column, index: int) -> Column:
    """Underscore-separated piece, counted from 0; NULL when missing."""
    return F.get(F.split(name, "_", -1), F.lit(index))


def parse_document_name(path: Column) -> Column:
    """``struct(name, opp, code, year, month, seq, archive)`` of a document path."""
    name = base_name(path)
    stamp = name_part(name, 3)
    year = F.substring(stamp, 1, 4)
    month = zero_pad(F.substr(stamp, F.lit(5)))
    return F.struct(
        name.alias("name"),
        name_part(name, 1).alias("opp"),
        name_part(name, 2).alias("code"),
        year.alias("year"),
        month.alias("month"),
        F.regexp_extract(name, r"_([0-9]+)\.", 1).alias("seq"),
        archive_path(year, month, name).alias("archive"),
    )


def without_extensions(name: Column) -> Column:
    """Every ``.word`` part removed."""
    return F.regexp_replace(name, rf"\.{WORD}+", "")
