"""Passes over the pending queue: one, or as many as it takes."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.names import parse_document_name, without_extensions
from ..operators.keys import anti_tuple, semi_tuple
from ..operators.match_files import match_documents
from ..operators.project import run_moment
from ..operators.skew import Sized, keyed_join, write_once
from ..operators.status import outcome_entries, outcome_updates
from ..schema import CODE, ID, KEYS
from ..sources.registry import pending_downloads, pending_uploads

UPLOAD, DOWNLOAD = "upload", "download"


@dataclass
class PendingRun:
    """The registry after the pass, what is left, and the report entries."""

    registry: DataFrame
    leftover: DataFrame
    entries: DataFrame


@dataclass
class Drain:
    """The end of a drain.

    ``dead`` are the notices that are tried no more, ``attempts`` all that are still pending,
    with their attempts; ``entries`` has the report entries of each pass.
    """

    registry: DataFrame
    dead: DataFrame
    attempts: DataFrame
    entries: list[DataFrame]
    passes: int


def upload_updates(registry: DataFrame, files: DataFrame, match: str = "exact") -> DataFrame:
    """Archive path and name for pending uploads whose file is there."""
    return _found(pending_uploads(registry).dropna().distinct(), files, match)


def _found(keys: DataFrame, files: DataFrame, match: str) -> DataFrame:
    found = match_documents(keys, files, match).filter(F.col("path").isNotNull())
    parsed = found.withColumn("_p", parse_document_name(F.col("path")))
    return parsed.select(
        *KEYS,
        F.col("_p.archive").alias("UrlActaDL"),
        without_extensions(F.col("_p.name")).alias("NombreArchivoActa"),
    )


def apply_both(
    registry: DataFrame, uploads: DataFrame, changes: DataFrame, run_ts: datetime | str | None
) -> DataFrame:
    """The registry after found files and then outcomes, in one pass over it.

    Both sides have one row per key pair; an uploaded document of the outcomes goes before
    a found file.
    """
    found = F.struct(F.col("UrlActaDL").alias("path"), F.col("NombreArchivoActa").alias("name"))
    last = uploads.dropna(subset=KEYS).groupBy(*KEYS).agg(F.max(found).alias("found"))
    both = last.join(changes, KEYS, "full")
    joined = keyed_join(registry, write_once(both, "changes"), KEYS)
    document = F.coalesce("doc", "found")
    hit = F.col("found").isNotNull() | F.col("published").isNotNull()
    return joined.withColumns(
        {
            "ActaPublicada": F.when(F.col("published"), 1).otherwise(F.col("ActaPublicada")),
            "Url_visitada": F.when(F.col("visited"), 1).otherwise(F.col("Url_visitada")),
            "UrlActaDL": F.when(document.isNotNull(), document["path"]).otherwise(F.col("UrlActaDL")),
            "NombreArchivoActa": F.when(document.isNotNull(), document["name"]).otherwise(
                F.col("NombreArchivoActa")
            ),
            "FechaModificacionReg": F.when(hit, run_moment(run_ts)).otherwise(
                F.col("FechaModificacionReg")
            ),
        }
    ).select(*registry.columns)


def resolve_pending(
    registry: DataFrame,
    files: DataFrame,
    outcomes: DataFrame,
    yearmonth: Column,
    run_ts: datetime | str | None = None,
    match: str = "exact",
    dead: DataFrame | None = None,
) -> PendingRun:
    """Give found files their path, take in fetch outcomes, list what is left.

    Outcomes count only for notices that wait for a download. ``dead`` has notices, with what
    they wait for in ``pending``, that are tried no more.
    """
    uploads = upload_updates(registry, files, match)
    due = semi_tuple(outcomes, pending_downloads(registry))
    if dead is not None:
        uploads = anti_tuple(uploads, dead.filter(F.col("pending") == UPLOAD))
        due = anti_tuple(due, dead.filter(F.col("pending") == DOWNLOAD))
    updated = apply_both(registry, uploads, outcome_updates(due, yearmonth), run_ts)
    return PendingRun(updated, _pending(updated), outcome_entries(due, yearmonth))


def _pending(registry: DataFrame) -> DataFrame:
    upload = pending_uploads(registry).withColumn("pending", F.lit(UPLOAD))
    return upload.unionByName(pending_downloads(registry).withColumn("pending", F.lit(DOWNLOAD)))


def no_attempts(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], f"{ID} int, {CODE} string, pending string, attempts int")


def drain_pending(
    registry: DataFrame,
    files: DataFrame,
    fetch: Callable[[DataFrame, int], DataFrame],
    yearmonth: Column,
    run_ts: datetime | str | None = None,
    match: str = "exact",
    most: int = 3,
    attempts: DataFrame | None = None,
) -> Drain:
    """Passes over the pending queue until nothing in it is to be tried again.

    ``fetch(queue, n)`` gives the outcomes of trying a queue of notices in the n-th pass, from 1.
    Every notice that is still pending after a pass has one attempt more; with ``most`` of them
    it is dead: it leaves the queue and is listed. A notice whose document is fetched may wait
    for its upload next, which counts anew; so there are at most twice ``most`` passes, fewer
    where the queue empties. ``attempts`` takes over the counts of an earlier drain, so that
    notices which failed on several days leave the queue as well. Files are matched
    once. The notices that wait at the start, their counts and the outcomes are written in each
    pass; a lost executor costs one pass at most. All other notices are not touched. Notices
    without an id or code can be neither fetched nor matched: they are dead at once.
    """
    key = [*KEYS, "pending"]
    counted = no_attempts(registry.sparkSession) if attempts is None else attempts
    pending = write_once(_pending(registry).distinct(), "pending")
    # Without a key a notice cannot be tried; with one that never waits it does not change.
    keyless = pending.frame.filter(F.col(ID).isNull() | F.col(CODE).isNull())
    keyless = keyless.withColumn("attempts", F.lit(most))
    keys = Sized(pending.frame.select(*KEYS).dropna().distinct(), within=pending)
    settled = keyed_join(registry, keys, KEYS, "left_anti")
    active = write_once(keyed_join(registry, keys, KEYS, "left_semi"), "active").frame
    filed = write_once(_found(keys.frame, files, match), "filed").frame
    entries, n = [], 0
    while True:
        waiting = _pending(active).distinct()
        tried = keyed_join(waiting, write_once(counted.groupBy(*key).agg(F.max("attempts").alias("attempts")), "tried"), key)
        counted = write_once(tried.withColumn("attempts", F.coalesce("attempts", F.lit(0))), "attempts").frame
        dead, live = counted.filter(F.col("attempts") >= most), counted.filter(F.col("attempts") < most)
        if live.isEmpty():
            state = settled.unionByName(active) if n else registry
            return Drain(state, dead.unionByName(keyless), counted.unionByName(keyless), entries, n)
        n += 1
        queue = live.filter(F.col("pending") == DOWNLOAD).select(*KEYS)
        outcomes = fetch(queue, n)
        if queue.isEmpty():
            outcomes = outcomes.limit(0)
        # The attempts of a pass are made once, whatever reads them.
        due = write_once(semi_tuple(outcomes, queue), "due").frame
        uploads = semi_tuple(filed, live.filter(F.col("pending") == UPLOAD))
        entries.append(outcome_entries(due, yearmonth))
        active = write_once(apply_both(active, uploads, outcome_updates(due, yearmonth), run_ts), "registry").frame
        counted = counted.withColumn("attempts", F.least(F.col("attempts") + 1, F.lit(most)))
