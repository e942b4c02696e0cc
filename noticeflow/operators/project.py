"""Projections, renames, constants, casts and simple filters."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import midnight_before, moment, to_second
from ..functions.text import fold_header
from ..schema import HEADER_TO_FIELD, UPDATE_BLOCKED


def fold_headers(df: DataFrame) -> DataFrame:
    """Remove accents from the column names."""
    return df.toDF(*[fold_header(c) for c in df.columns])


def rename_fields(df: DataFrame, mapping: dict[str, str] = HEADER_TO_FIELD) -> DataFrame:
    """Rename by map; other names pass through."""
    return df.withColumnsRenamed(mapping)


def status_constants(df: DataFrame) -> DataFrame:
    """No document yet: 0, '' and ''."""
    return df.withColumns(
        {
            "ActaPublicada": F.lit(0),
            "UrlActaDL": F.lit(""),
            "NombreArchivoActa": F.lit(""),
        }
    )


def run_moment(run_ts: datetime | str | None) -> Column:
    """One run timestamp at second precision."""
    return to_second(F.localtimestamp()) if run_ts is None else moment(run_ts)


def audit_times(df: DataFrame, run_ts: datetime | str | None = None) -> DataFrame:
    now = run_moment(run_ts)
    return df.withColumns({"FechaCreacionReg": now, "FechaModificacionReg": now})


def to_int(text: Column, strict: bool = False) -> Column:
    """Text to INT: NULL on bad input, or an error when ``strict``."""
    return text.cast("int") if strict else text.try_cast("int")


def number_text(value: Column) -> Column:
    """A number that went through a float, as integer text (``9.0`` -> ``9``)."""
    return value.cast("double").cast("bigint").cast("string")


def fill_blank(df: DataFrame) -> DataFrame:
    """NULL text becomes ''."""
    return df.fillna("")


def drop_blocked(df: DataFrame, blocked: list[str] = UPDATE_BLOCKED) -> DataFrame:
    return df.drop(*blocked)


def modified_since(
    df: DataFrame, as_of: datetime | str, n_days: int = 1, column: str = "FechaModificacion"
) -> DataFrame:
    """Rows changed at or after midnight, ``n_days`` days before ``as_of``."""
    return df.filter(F.col(column) >= midnight_before(as_of, n_days))


def undocumented(df: DataFrame) -> DataFrame:
    """Rows without a published document and without a path."""
    return df.filter((F.col("ActaPublicada") == 0) & (F.col("UrlActaDL") == ""))


def contains_both(df: DataFrame, text: str, first: str, second: str) -> DataFrame:
    """Rows where both columns contain a text."""
    return df.filter(
        F.contains(F.col(first), F.lit(text)) & F.contains(F.col(second), F.lit(text))
    )


def union_distinct(new: DataFrame, existing: DataFrame) -> DataFrame:
    """Both inputs, whole-row duplicates removed. Either side may be empty."""
    return new.unionByName(existing).dropDuplicates()
