"""One incremental run: stage, classify, insert, update, work list, counts."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.keys import CONFLICT, DOCUMENT, LABEL, NEW, WITHOUT, classify
from ..operators.file_order import classify_in_order
from ..operators.project import union_distinct
from ..operators.report import stage_counts
from ..operators.skew import keyed_join, write_once
from ..operators.updates import insert_rows, update_changed
from ..schema import FILE_ORDER, KEYS, ROW_SEQ, SOURCE_FILE, STAGED_FIELDS
from .staging import stage


@dataclass
class IncrementalRun:
    """One run: the classified batch is written; the rest are plans over it.

    ``changed`` are the rows whose keys the registry updates, ``update`` takes any part of
    the registry to its next state, ``inserts`` are the rows to add; ``registry`` is all
    of that in one. ``rejects`` and ``conflicts`` are the rows that go nowhere.
    """

    classified: DataFrame
    rejects: DataFrame
    conflicts: DataFrame
    changed: DataFrame
    update: Callable[[DataFrame], DataFrame]
    inserts: DataFrame
    registry: DataFrame
    worklist: DataFrame
    counts: DataFrame


def run_incremental(
    notices: DataFrame,
    registry: DataFrame | Callable[[DataFrame], DataFrame],
    dim: DataFrame,
    as_of: datetime | str,
    n_days: int = 1,
    run_ts: datetime | str | None = None,
    match: str = "independent",
    compat_nan: bool = False,
) -> IncrementalRun:
    """Stage and classify one batch of notice files; plan what follows from it.

    All files of the batch are compared with the same registry state, unless the notices
    have a ``FILE_ORDER``: then each is compared with what the files before it leave. The
    batch is read and classified once; registry, work list and counts start from its table.
    ``registry`` may be a function that gives the part of a table which can hold the keys of
    the staged rows.
    """
    staged = stage(notices, dim, as_of, n_days, run_ts, compat_nan)
    if callable(registry):
        registry = registry(staged.rows)
    spread_by = [c for c in (SOURCE_FILE, ROW_SEQ) if c in staged.rows.columns] or None
    in_order = FILE_ORDER in staged.rows.columns
    if in_order and match != "independent":
        raise ValueError("files in order are matched by independent keys only")
    if in_order:
        labelled = classify_in_order(staged.rows, registry, spread_by)
    else:
        labelled = classify(staged.rows, registry, match, spread_by)
    classified = write_once(labelled, "classified").frame
    new = classified.filter(F.col(LABEL) == NEW)
    waiting = classified.filter(F.col(DOCUMENT) == WITHOUT)
    order = [c for c in (FILE_ORDER if in_order else SOURCE_FILE, ROW_SEQ) if c in classified.columns]
    if not order:
        _check_no_repeats(waiting)

    def update(part: DataFrame) -> DataFrame:
        return update_changed(part, waiting, order=order or ["FechaModificacion"], run_ts=run_ts)

    none = registry.sparkSession.createDataFrame([], registry.schema)

    def added(rows: DataFrame) -> DataFrame:
        return insert_rows(none, rows.select(*STAGED_FIELDS), {"Url_visitada": F.lit(0)})

    if in_order:
        # Files after the one that brought a new row update it as any other.
        last = write_once(waiting.groupBy(*KEYS).agg(F.max(FILE_ORDER).alias("_last")), "last")
        later = F.coalesce(F.col("_last") > F.col(FILE_ORDER), F.lit(False))
        brought = keyed_join(new, last, KEYS)
        inserts = added(brought.filter(~later)).unionByName(update(added(brought.filter(later))))
    else:
        inserts = added(new)
    next_registry = update(registry).unionByName(inserts)
    worklist = union_distinct(new.select(*STAGED_FIELDS), waiting.select(*STAGED_FIELDS))
    if SOURCE_FILE in classified.columns:
        counts = _counts(classified)
    else:
        counts = _counts(classified.withColumn(SOURCE_FILE, F.lit("")))
    conflicts = classified.filter(F.col(LABEL) == CONFLICT)
    return IncrementalRun(
        classified, staged.rejects, conflicts, waiting, update, inserts, next_registry, worklist, counts
    )


def _check_no_repeats(rows: DataFrame) -> None:
    """Without file and row number nothing says which of several rows of a key is the last."""
    repeated = rows.groupBy(*KEYS).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1")
    if not repeated.isEmpty():
        raise ValueError(f"keys repeat and there is no {SOURCE_FILE} or {ROW_SEQ} to order them")


def _counts(classified: DataFrame) -> DataFrame:
    """Stage counts with the number of distinct rows to fetch documents for."""
    to_fetch = classified.filter((F.col(LABEL) == NEW) | (F.col(DOCUMENT) == WITHOUT))
    distinct = to_fetch.select(SOURCE_FILE, *STAGED_FIELDS).distinct()
    fetch = distinct.groupBy(SOURCE_FILE).agg(F.count(F.lit(1)).alias("to_download"))
    joined = stage_counts(classified).join(fetch, SOURCE_FILE, "left")
    return joined.withColumn("to_download", F.coalesce("to_download", F.lit(0)))


