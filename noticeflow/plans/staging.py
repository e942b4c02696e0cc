"""From raw notices to staged rows in registry form."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import CREATED, MODIFIED, midnight_before, parse, parse_column
from ..functions.names import url_id
from ..functions.text import prepare_state, remove_char
from ..operators.lookup import map_states
from ..operators.project import (
    audit_times,
    fill_blank,
    fold_headers,
    rename_fields,
    status_constants,
    to_int,
)
from ..operators.skew import write_once
from ..schema import CODE, MALFORMED, STAGED_FIELDS

REASON = "reject_reason"
REJECTED = "reject_value"

_CREATED = "Fecha de creacion"
_MODIFIED = "Fecha de ultima modificacion"
_URL = "Direccion del anuncio"
_DATES = [_CREATED, "Publicacion del anuncio", "Vigencia del anuncio"]


@dataclass
class Staged:
    """Rows in registry form, and rows that could not be read, with the reason."""

    rows: DataFrame
    rejects: DataFrame


def _raw(name: str) -> Column:
    return F.col(f"`{name}`")


def in_window(raw: DataFrame, as_of: datetime | str, n_days: int) -> DataFrame:
    """Notices changed in the window, with the change date parsed.

    A notice whose change date cannot be read is in no window. It is kept, with a
    NULL date, to be rejected.
    """
    modified = parse(_raw(_MODIFIED), MODIFIED)
    dated = fold_headers(raw).withColumns({"_modified_text": _raw(_MODIFIED), _MODIFIED: modified})
    late = _raw(_MODIFIED) >= midnight_before(as_of, n_days)
    return dated.filter(late | _raw(_MODIFIED).isNull() | _malformed(raw).isNotNull())


def _malformed(raw: DataFrame) -> Column:
    """The text of a row that does not fit its header; its values may stand anywhere."""
    return F.col(MALFORMED) if MALFORMED in raw.columns else F.lit(None).cast("string")


def read_dates_and_id(notices: DataFrame) -> DataFrame:
    """Parse the other dates and the id; give a reason where that fails."""
    parsed = {
        _CREATED: parse(_raw(_CREATED), CREATED),
        **{c: parse_column(c, _raw(c)) for c in _DATES if c != _CREATED},
        "opportunityId": to_int(url_id(_raw(_URL))),
    }
    texts = {f"_text_{i}": _raw(c) for i, c in enumerate(_DATES)}
    read = notices.withColumns({**texts, **parsed})

    def failure(bad: Column, reason: str, text: Column) -> Column:
        return F.when(bad, F.struct(F.lit(reason).alias("reason"), text.alias("value")))

    malformed = _malformed(notices)
    failures = [
        failure(malformed.isNotNull(), "cells do not fit the header", malformed),
        failure(_raw(_MODIFIED).isNull(), f"date: {_MODIFIED}", F.col("_modified_text")),
        failure(F.col("opportunityId").isNull(), "no id in address", _raw(_URL)),
    ]
    for i, c in enumerate(_DATES):
        bad = F.col(f"_text_{i}").isNotNull() & _raw(c).isNull()
        failures.append(failure(bad, f"date: {c}", F.col(f"_text_{i}")))
    failed = F.coalesce(*failures)
    return (
        read.withColumn("_failed", failed)
        .withColumns({REASON: F.col("_failed.reason"), REJECTED: F.col("_failed.value")})
        .drop("_failed", "_modified_text", MALFORMED, *texts)
    )


def stage(
    raw: DataFrame,
    dim: DataFrame,
    as_of: datetime | str,
    n_days: int = 1,
    run_ts: datetime | str | None = None,
    compat_nan: bool = False,
) -> Staged:
    """Keep notices changed in the window and bring them into registry form.

    The window comes before all other work. What is left of the files is written
    once: keys, rows and rejects are read from there, not from the files again.
    """
    named = rename_fields(read_dates_and_id(in_window(raw, as_of, n_days)))
    extra = [c for c in named.columns if c not in STAGED_FIELDS]

    def text(name: str) -> Column:
        column = F.col(name).cast("string")
        return F.coalesce(column, F.lit("nan")) if compat_nan else column

    filled = named.withColumns(
        {
            "DescAnuncio": remove_char(text("DescAnuncio")),
            CODE: text(CODE),
            "ClaveCOG": text("ClaveCOG"),
            "IdEstado": prepare_state(F.col("IdEstado")),
        }
    )
    staged = audit_times(status_constants(filled), run_ts)
    mapped = map_states(staged, dim, compat_nan=compat_nan).select(*STAGED_FIELDS, *extra)
    written = write_once(mapped, "staged").frame
    good = written.filter(F.col(REASON).isNull()).drop(REASON, REJECTED)
    return Staged(fill_blank(good), written.filter(F.col(REASON).isNotNull()))
