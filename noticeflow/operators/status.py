"""Outcomes of document fetches: report entries and registry changes.

``outcomes`` holds one row per link of a visited notice, or one row for a notice
that gave no link: ``Codigo, OpportunityId, seq, page_status, n_links,
link_pieces, file_status, stored, uploaded, error, ext``. ``uploaded`` NULL means
that the upload raised an error.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.names import archive_path, document_base, document_name
from .. import schema
from ..schema import CODE, ID, KEYS
from .project import run_moment
from .skew import keyed_join, write_once

OK = 200


def _base(yearmonth: Column) -> Column:
    return document_base(F.col(ID), F.col(CODE), yearmonth)


def _file(yearmonth: Column) -> Column:
    return document_name(_base(yearmonth), F.col("seq"), F.col("ext"))


def _branches() -> dict[str, Column]:
    failed = F.col("error").isNotNull() | ~F.col("page_status").eqNullSafe(OK)
    empty = ~failed & (F.col("n_links") == 0)
    link = ~failed & (F.col("n_links") > 0) & (F.col("link_pieces") == 3)
    fetched = link & F.col("file_status").eqNullSafe(OK)
    stored = F.coalesce(F.col("stored"), F.lit(False))
    uploaded = F.coalesce(F.col("uploaded"), F.lit(False))
    return {
        "failed": failed,
        "empty": empty,
        "link_failed": link & ~F.col("file_status").eqNullSafe(OK),
        "stored": fetched & stored,
        "not_stored": fetched & ~stored,
        "uploaded": fetched & uploaded,
        "not_uploaded": fetched & ~uploaded,
    }


def outcome_entries(outcomes: DataFrame, yearmonth: Column) -> DataFrame:
    """Report entries ``bucket, name`` next to the outcome's own columns."""
    b = _branches()
    base, file = _base(yearmonth), _file(yearmonth)

    def entry(bucket: str, name: Column) -> Column:
        return F.struct(F.lit(bucket).alias("bucket"), name.alias("name"))

    entries = F.array(
        F.when(b["failed"] | b["empty"] | b["link_failed"], entry("actas_no_descargadas", base)),
        F.when(b["stored"], entry("actas_descargadas", file)),
        F.when(b["not_stored"], entry("actas_no_descargadas", file)),
        F.when(b["uploaded"], entry("actas_subidas_al_dl", file)),
        F.when(b["not_uploaded"], entry("actas_no_subidas_al_dl", file)),
    )
    exploded = outcomes.withColumn("_e", F.explode(F.array_compact(entries)))
    return exploded.select(*outcomes.columns, "_e.bucket", "_e.name")


MAIN, PENDING = "main", "pending"


def outcome_log(outcomes: DataFrame, yearmonth: Column, folder: str, visit: list[str]) -> DataFrame:
    """Lines ``log, name, result`` of fetch outcomes, next to the ``visit`` columns.

    A visit, one notice of one run, says once that its page lists documents; every link
    then has lines of its own. A failed upload also goes to the ``pending`` log, with the
    place it was meant for, or with the error if there was no answer; ``folder`` is where
    the files wait. A missing error text is empty.
    """
    b = _branches()
    base, file = _base(yearmonth), _file(yearmonth)
    year, month = F.substring(yearmonth, 1, 4), F.substr(yearmonth, F.lit(5))
    error = F.coalesce(F.col("error"), F.lit(""))
    refused = b["not_uploaded"] & F.col("uploaded").isNotNull()
    silent = b["not_uploaded"] & F.col("uploaded").isNull()
    answer = F.when(b["uploaded"], "True").otherwise("False")

    def line(name: Column, *result: Column, log: str = MAIN) -> Column:
        return F.struct(F.lit(log).alias("log"), name.alias("name"), F.concat(*result).alias("result"))

    meant = archive_path(year, month, file)
    lines = F.array(
        F.when(F.col("error").isNotNull(), line(base, F.lit(schema.LOG_PAGE_ERROR), error)),
        F.when(
            F.col("error").isNull() & b["failed"],
            line(base, F.lit(schema.LOG_STATUS), F.coalesce(F.col("page_status").cast("string"), F.lit(""))),
        ),
        F.when(b["empty"], line(base, F.lit(schema.LOG_NONE), F.col("n_links").cast("string"))),
        F.when(b["stored"], line(file, F.lit(schema.LOG_STORED))),
        F.when(b["not_stored"], line(base, F.lit(schema.LOG_NOT_STORED), error)),
        F.when(b["uploaded"] | refused, line(file, F.lit(schema.LOG_UPLOAD), answer)),
        F.when(
            refused,
            line(F.concat_ws("/", F.lit(folder), file), F.lit(schema.LOG_PENDING_PATH), meant, log=PENDING),
        ),
        F.when(silent, line(file, F.lit(schema.LOG_UPLOAD_ERROR), error)),
        F.when(silent, line(file, F.lit(schema.LOG_UPLOAD_ERROR), error, log=PENDING)),
    )
    each = outcomes.select(*visit, F.explode(F.array_compact(lines)).alias("_l"))
    listed = outcomes.filter(~b["failed"] & (F.col("n_links") > 0))
    found = listed.select(*visit, line(base, F.lit(schema.LOG_FOUND)).alias("_l")).distinct()
    return each.unionByName(found).select(*visit, "_l.log", "_l.name", "_l.result")


def outcome_updates(outcomes: DataFrame, yearmonth: Column) -> DataFrame:
    """One row per notice with the changes its outcomes ask for.

    The last uploaded file of a notice gives its path and name.
    """
    b = _branches()
    year, month = F.substring(yearmonth, 1, 4), F.substr(yearmonth, F.lit(5))
    path = archive_path(year, month, _file(yearmonth))
    name = F.concat(_base(yearmonth), F.lit("_"), F.col("seq").cast("string"))
    flagged = outcomes.select(
        *KEYS,
        F.col("seq"),
        b["stored"].alias("_stored"),
        (b["stored"] | b["empty"]).alias("_visited"),
        F.when(b["uploaded"], F.struct(path.alias("path"), name.alias("name"))).alias("_doc"),
    )
    return (
        flagged.dropna(subset=KEYS)
        .groupBy(*KEYS)
        .agg(
            F.max("_stored").alias("published"),
            F.max("_visited").alias("visited"),
            F.max_by("_doc", F.when(F.col("_doc").isNotNull(), F.col("seq"))).alias("doc"),
        )
        .filter(F.col("published") | F.col("visited") | F.col("doc").isNotNull())
    )


def apply_outcomes(
    registry: DataFrame, updates: DataFrame, run_ts: datetime | str | None = None
) -> DataFrame:
    """The registry after the changes of ``outcome_updates``."""
    joined = keyed_join(registry, write_once(updates, "changes"), KEYS)
    hit = F.col("published").isNotNull()
    has_doc = F.col("doc").isNotNull()
    return joined.withColumns(
        {
            "ActaPublicada": F.when(F.col("published"), 1).otherwise(F.col("ActaPublicada")),
            "Url_visitada": F.when(F.col("visited"), 1).otherwise(F.col("Url_visitada")),
            "UrlActaDL": F.when(has_doc, F.col("doc.path")).otherwise(F.col("UrlActaDL")),
            "NombreArchivoActa": F.when(has_doc, F.col("doc.name")).otherwise(
                F.col("NombreArchivoActa")
            ),
            "FechaModificacionReg": F.when(hit, run_moment(run_ts)).otherwise(
                F.col("FechaModificacionReg")
            ),
        }
    ).select(*registry.columns)
