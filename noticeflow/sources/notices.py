"""Notice files: CSV with a header, every column text, columns found by name.

Files may have their columns in any order and more or fewer of them. A file's first line is its
header; the records behind it (``records.py``) are parsed by Spark with that header as the
schema, so a value stands under the name its own file gives it. Files are split between tasks,
whatever their quotes hold.
"""

from __future__ import annotations

import csv

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import fold_header
from ..operators.skew import keyed_join, write_once
from ..schema import MALFORMED, RAW_SCHEMA, ROW_SEQ, SOURCE_FILE
from .records import read_records


def read_notices(spark: SparkSession, path: str | list[str], schema=RAW_SCHEMA) -> DataFrame:
    """Notices with their file and a number that orders the rows within it.

    No type is inferred. Only paths that contain ``.csv`` are notice files. A column the
    file lacks is NULL. A row with more or fewer cells than its header, and one whose quotes
    never close, keeps its text in the ``MALFORMED`` column, which is NULL for all others.
    """
    paths = [path] if isinstance(path, str) else list(path)
    unknown = [p for p in paths if ".csv" not in p]
    if unknown:
        raise ValueError(f"not a notice file: {unknown}")
    return read_by_header(spark, paths, schema)


def read_by_header(spark: SparkSession, paths: list[str], schema, base: str | None = None, parts=()) -> DataFrame:
    """The same for any paths; ``parts`` names folder columns below ``base`` to keep as text.

    The layouts, of which there are as many as different headers, come to the driver; files
    and their rows do not.
    """
    if not paths:
        return _no_rows(spark, schema, parts)
    return by_header(*read_records(spark, paths, base, parts), schema, parts)


def _no_rows(spark: SparkSession, schema, parts) -> DataFrame:
    extra = [SOURCE_FILE, ROW_SEQ, MALFORMED, *parts]
    fields = [*schema, *[T.StructField(c, T.StringType()) for c in extra]]
    empty = spark.createDataFrame([], T.StructType(fields))
    return empty.withColumn(ROW_SEQ, F.col(ROW_SEQ).cast("long"))


def by_header(found: DataFrame, files: DataFrame, schema, parts=(), strict: bool = False) -> DataFrame:
    """Records of files (``records.py``) as rows, each parsed under its file's header.

    If ``strict``, all headers must have the schema's names in its order, whatever their case.
    """
    wanted = {fold_header(f.name): f.name for f in schema}
    headers = sorted(r["first"] for r in files.select("first").distinct().collect())
    if strict:
        for h in headers:
            if h.strip() and [n.lower() for n in _names(h)] != [f.name.lower() for f in schema]:
                raise ValueError(f"header does not fit the schema: {h}")
    name = F.url_decode(F.replace(F.regexp_extract("path", r"[^/]*$", 0), F.lit("+"), F.lit("%2B")))
    named = files.select("file", name.alias(SOURCE_FILE), "first", *[F.col(p).cast("string").alias(p) for p in parts])
    rows = found.filter("seq > 0").withColumn("record", F.regexp_replace("record", r"\r\z", ""))
    rows = keyed_join(rows.filter("record <> ''"), write_once(named, "files"), ["file"], "left", ["seq"])
    parsed = F.coalesce(*[F.when(F.col("first") == h, _parsed(h, wanted)) for h in headers]) if headers else None
    if parsed is None:
        return _no_rows(found.sparkSession, schema, parts)
    whole = F.when(F.col("whole"), parsed)
    return rows.withColumn("_parsed", whole).select(
        *[F.col("_parsed")[f"c{i}"].alias(n) for i, n in enumerate(wanted.values())],
        SOURCE_FILE,
        F.col("seq").alias(ROW_SEQ),
        F.when(F.col("whole"), F.col("_parsed.malformed")).otherwise(F.col("record")).alias(MALFORMED),
        *parts,
    )


def _names(header: str) -> list[str]:
    return next(csv.reader([header.removeprefix("\ufeff").removesuffix("\r")]), [])


def _parsed(header: str, wanted: dict[str, str]) -> Column:
    """A record's values under one header: ``c0, c1, ...`` in the order of the names wanted."""
    folded = [fold_header(n.strip()) for n in _names(header)]
    # A name that occurs twice counts where it stands first.
    own = [n if n in wanted and n not in folded[:i] else None for i, n in enumerate(folded)]
    fields = ", ".join(f"f{i} string" for i in range(len(own))) + f", {MALFORMED} string"
    options = {"escape": '"', "multiLine": "true", "lineSep": "\n", "columnNameOfCorruptRecord": MALFORMED}
    cells = F.from_csv("record", fields.removeprefix(", "), options)

    def pick(row: Column) -> Column:
        values = [
            (row[f"f{own.index(n)}"] if n in own else F.lit(None).cast("string")).alias(f"c{i}")
            for i, n in enumerate(wanted)
        ]
        return F.struct(*values, row[MALFORMED].alias("malformed"))

    # A one-element array binds the row, so that a record is parsed once.
    return F.get(F.transform(F.array(cells), pick), F.lit(0))
