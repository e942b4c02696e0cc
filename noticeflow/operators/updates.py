"""Inserts and keyed updates as snapshot rewrites.

Every function takes the table and gives back the next state of the table. A
separate flag says whether a row was hit, so that an update to '' or NULL counts.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import zero_pad
from ..schema import KEYS, UPDATE_FIELDS
from .project import run_moment
from .skew import keyed_join, write_once

_NEW = "_new"


def insert_rows(table: DataFrame, rows: DataFrame, defaults: dict[str, Column] | None = None):
    """Append rows, copies included; columns the rows lack take a default or NULL."""
    for name, value in (defaults or {}).items():
        if name not in rows.columns:
            rows = rows.withColumn(name, value)
    typed = [
        F.col(f.name).cast(f.dataType).alias(f.name)
        for f in table.schema.fields
        if f.name in rows.columns
    ]
    return table.unionByName(rows.select(*typed), allowMissingColumns=True)


def insert_documents(index: DataFrame, rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Append document rows; also give the ids that went in."""
    return insert_rows(index, rows), rows.select("opportunityID")


def last_update(updates: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row per key, the last by ``order``; combined before the shuffle.

    The new values come in one struct, which begins with the order columns.
    """
    values = [c for c in updates.columns if c not in keys and c not in order]
    best = F.max(F.struct(*order, *values)).alias(_NEW)
    return updates.dropna(subset=keys).groupBy(*keys).agg(best)


def update_columns(
    table: DataFrame,
    updates: DataFrame,
    columns: list[str],
    keys: list[str] = KEYS,
    order: list[str] | None = None,
    run_ts: datetime | str | None = None,
    stamp: str | None = "FechaModificacionReg",
) -> DataFrame:
    """Set ``columns`` of every row whose keys occur in ``updates``.

    With repeated keys in ``updates`` the last by ``order`` wins (``order``
    defaults to the columns themselves). ``stamp`` is set to the run time.
    The last updates are written once, so that few of them can be broadcast and
    the table is then rewritten without a shuffle.
    """
    wanted = updates.select(*dict.fromkeys([*keys, *columns, *(order or [])]))
    last = write_once(last_update(wanted, keys, order or columns), "updates")
    joined = keyed_join(table, last, keys)
    hit = F.col(_NEW).isNotNull()
    new = {
        c: F.when(hit, F.col(f"{_NEW}.{c}").cast(table.schema[c].dataType)).otherwise(F.col(c))
        for c in columns
    }
    if stamp:
        new[stamp] = F.when(hit, run_moment(run_ts)).otherwise(F.col(stamp))
    return joined.withColumns(new).select(*table.columns)


def update_published(table: DataFrame, updates: DataFrame, **options) -> DataFrame:
    """Set ``ActaPublicada`` and mark the notice as visited."""
    visited = updates.withColumn("Url_visitada", F.lit(1))
    return update_columns(table, visited, ["ActaPublicada", "Url_visitada"], **options)


def update_visited(table: DataFrame, updates: DataFrame, **options) -> DataFrame:
    return update_columns(table, updates, ["Url_visitada"], **options)


def update_text(table: DataFrame, updates: DataFrame, columns: list[str], **options) -> DataFrame:
    """Set a list of columns, each from its text."""
    as_text = updates.withColumns({c: F.col(c).cast("string") for c in columns})
    return update_columns(table, as_text, columns, **options)


def update_changed(
    table: DataFrame,
    staged: DataFrame,
    order: list[str] | None = None,
    run_ts: datetime | str | None = None,
) -> DataFrame:
    """Copy the notice fields of changed rows; document fields stay as they are.

    State ids have two digits; a missing state stays blank.
    """
    fields = [c for c in UPDATE_FIELDS if c in staged.columns and c in table.columns]
    if "IdEstado" in fields:
        state = F.col("IdEstado")
        staged = staged.withColumn("IdEstado", F.when(state != "", zero_pad(state)).otherwise(state))
    return update_columns(table, staged, fields, order=order, run_ts=run_ts)


def update_where(table: DataFrame, predicate: Column, values: dict[str, Column]) -> DataFrame:
    """Set columns to expressions in the rows that meet a predicate."""
    new = {
        c: F.when(predicate, v.cast(table.schema[c].dataType)).otherwise(F.col(c))
        for c, v in values.items()
    }
    # Every expression reads the old row.
    return table.select(*[new.get(c, F.col(c)).alias(c) for c in table.columns])


def update_queue(
    queue: DataFrame,
    results: DataFrame,
    order: list[str] | None = None,
    run_ts: datetime | str | None = None,
) -> DataFrame:
    """Record when a queued notice was last asked for, and with what result."""
    return update_columns(
        queue,
        results,
        ["ActaDescargada", "resultadoConsultaDesc"],
        keys=["opportunityId"],
        order=order,
        run_ts=run_ts,
        stamp="FechaUltimaConsulta",
    )


def repath(
    table: DataFrame,
    moves: DataFrame,
    run_ts: datetime | str | None = None,
    order: list[str] | None = None,
) -> DataFrame:
    """Replace document paths by a table of ``old, new`` (exact names)."""
    renamed = moves.select(
        F.col("old").alias("UrlActaDL"), F.col("new").alias("_to"), *(order or [])
    )
    last = write_once(last_update(renamed, ["UrlActaDL"], order or ["_to"]), "moves")
    joined = keyed_join(table, last, ["UrlActaDL"])
    hit = F.col(_NEW).isNotNull()
    return joined.withColumns(
        {
            "UrlActaDL": F.when(hit, F.col(f"{_NEW}._to")).otherwise(F.col("UrlActaDL")),
            "FechaModificacionReg": F.when(hit, run_moment(run_ts)).otherwise(
                F.col("FechaModificacionReg")
            ),
        }
    ).select(*table.columns)


def repath_like(
    table: DataFrame, new: str, old: str, run_ts: datetime | str | None = None
) -> DataFrame:
    """Set one path where the old one is LIKE a pattern (``_`` is any character)."""
    return update_where(
        table,
        F.col("UrlActaDL").like(old),
        {"UrlActaDL": F.lit(new), "FechaModificacionReg": run_moment(run_ts)},
    )
