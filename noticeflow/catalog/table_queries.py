"""Queries over inserts, updates, pending scans and the work queue."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.dates import moment
from ..operators import report, status, updates
from ..plans.staging import stage
from ..schema import DOCUMENT_FOLDER, FILE_BUCKETS, MAX_QUEUE_ROWS, UPDATE_FIELDS
from ..session import shared_dir
from ..sinks import files as sinks
from ..sources import registry as scans
from . import inputs
from .inputs import CTES, RUN_TS, sql, table
from .registry import query

_RUN = f"TIMESTAMP '{RUN_TS}'"


# --- pending scans ------------------------------------------------------------
@query(
    "pending_upload",
    sql("SELECT OpportunityId, Codigo FROM whole_registry WHERE ActaPublicada = 1 AND UrlActaDL = ''", "whole_registry"),
)
def pending_upload(spark, sf_dir):
    return scans.pending_uploads(inputs.whole_registry(spark, sf_dir))


@query(
    "pending_download",
    sql("SELECT OpportunityId, Codigo FROM whole_registry WHERE ActaPublicada = 0 AND Url_visitada = 0", "whole_registry"),
)
def pending_download(spark, sf_dir):
    return scans.pending_downloads(inputs.whole_registry(spark, sf_dir))


@query(
    "backlog",
    sql(
        """SELECT up AS pending_upload, down AS pending_download, up + down AS backlog FROM (
      SELECT count(*) FILTER (WHERE ActaPublicada = 1 AND UrlActaDL = '') AS up,
        count(*) FILTER (WHERE ActaPublicada = 0 AND Url_visitada = 0) AS down FROM whole_registry) r""",
        "whole_registry",
    ),
)
def backlog(spark, sf_dir):
    return report.backlog(inputs.whole_registry(spark, sf_dir))


# --- work queue ---------------------------------------------------------------
CTES["queue"] = """
  SELECT CAST(event_id AS INTEGER) AS "opportunityId",
    CAST(year(ts) * 100 + month(ts) AS INTEGER) AS anomes,
    CASE WHEN event_type IN ('purchase', 'signup') THEN date_trunc('second', ts) END AS FechaUltimaConsulta,
    0 AS ActaDescargada, '' AS "resultadoConsultaDesc" FROM events"""


def _queue(spark, sf_dir):
    asked = F.date_trunc("second", "ts").cast("timestamp_ntz")
    return table(spark, sf_dir, "events").select(
        F.col("event_id").cast("int").alias("opportunityId"),
        (F.year("ts") * 100 + F.month("ts")).cast("int").alias("anomes"),
        F.when(F.col("event_type").isin("purchase", "signup"), asked).alias("FechaUltimaConsulta"),
        F.lit(0).alias("ActaDescargada"),
        F.lit("").alias("resultadoConsultaDesc"),
    )


@query(
    "queue_top_n",
    sql(
        """SELECT * FROM queue WHERE anomes = 202401 AND FechaUltimaConsulta IS NULL
      ORDER BY "opportunityId" LIMIT 3000""",
        "queue",
    ),
)
def queue_top_n(spark, sf_dir):
    return scans.queue_head(_queue(spark, sf_dir), 202401, ["opportunityId"], MAX_QUEUE_ROWS)


@query(
    "update_queue",
    sql(
        f"""SELECT q."opportunityId", anomes,
      CASE WHEN hit THEN {_RUN} ELSE FechaUltimaConsulta END AS FechaUltimaConsulta,
      CASE WHEN hit THEN acta ELSE ActaDescargada END AS ActaDescargada,
      CASE WHEN hit THEN result ELSE "resultadoConsultaDesc" END AS "resultadoConsultaDesc"
    FROM queue q LEFT JOIN (SELECT o_custkey AS k, true AS hit, arg_max(o_orderstatus, o_orderkey) AS result,
        arg_max(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END, o_orderkey) AS acta
      FROM orders GROUP BY o_custkey) o ON o.k = q."opportunityId\"""",
        "queue",
    ),
)
def update_queue(spark, sf_dir):
    results = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").cast("int").alias("opportunityId"),
        F.when(F.col("o_orderstatus") == "F", 1).otherwise(0).alias("ActaDescargada"),
        F.col("o_orderstatus").alias("resultadoConsultaDesc"),
        F.col("o_orderkey").alias("seq"),
    )
    return updates.update_queue(_queue(spark, sf_dir), results, ["seq"], RUN_TS)


# --- inserts ------------------------------------------------------------------
@query(
    "insert_rows",
    sql(
        f"""SELECT *, CAST(NULL AS VARCHAR) AS note FROM registry
    UNION ALL SELECT OpportunityId, Codigo, FechaModificacion, 0, '', NULL, 0, {_RUN}, NULL FROM staged
    UNION ALL SELECT OpportunityId, Codigo, FechaModificacion, 0, '', NULL, 0, {_RUN}, NULL FROM staged
      WHERE FechaModificacion >= TIMESTAMP '2001-01-01 00:00:00'""",
        "registry",
        "staged",
    ),
)
def insert_rows(spark, sf_dir):
    registry = inputs.registry(spark, sf_dir).withColumn("note", F.lit(None).cast("string"))
    rows = inputs.staged(spark, sf_dir)
    again = rows.filter(F.col("FechaModificacion") >= moment("2001-01-01 00:00:00"))
    defaults = {
        "ActaPublicada": F.lit(0),
        "UrlActaDL": F.lit(""),
        "Url_visitada": F.lit(0),
        "FechaModificacionReg": moment(RUN_TS),
    }
    return updates.insert_rows(registry, rows.unionByName(again), defaults)


@query(
    "insert_documents",
    sql(
        """SELECT OpportunityId AS "opportunityID", 1 AS "actaID", NombreArchivoActa AS "nombre_Archivo",
      'pdf' AS extension, UrlActaDL AS "url_Descarga" FROM registry
    UNION ALL SELECT OpportunityId, 2, 'x' || Codigo, 'pdf', '' FROM staged""",
        "registry",
        "staged",
    ),
)
def insert_documents(spark, sf_dir):
    return _insert_documents(spark, sf_dir)[0]


@query(
    "insert_document_ids",
    sql('SELECT OpportunityId AS "opportunityID" FROM staged', "staged"),
)
def insert_document_ids(spark, sf_dir):
    """The ids that went in, one per inserted row."""
    return _insert_documents(spark, sf_dir)[1]


def _insert_documents(spark, sf_dir):
    index = inputs.registry(spark, sf_dir).select(
        F.col("OpportunityId").alias("opportunityID"),
        F.lit(1).alias("actaID"),
        F.col("NombreArchivoActa").alias("nombre_Archivo"),
        F.lit("pdf").alias("extension"),
        F.col("UrlActaDL").alias("url_Descarga"),
    )
    rows = inputs.staged(spark, sf_dir).select(
        F.col("OpportunityId").alias("opportunityID"),
        F.lit(2).alias("actaID"),
        F.concat(F.lit("x"), "Codigo").alias("nombre_Archivo"),
        F.lit("pdf").alias("extension"),
        F.lit("").alias("url_Descarga"),
    )
    return updates.insert_documents(index, rows)


# --- keyed updates --------------------------------------------------------------
_LINE_ORDER = ["l_shipdate", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]
CTES["last_line"] = f"""
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey
    ORDER BY {', '.join(f'{c} DESC' for c in _LINE_ORDER)}) AS rn FROM lineitem) l WHERE rn = 1"""


def _line_updates(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("Codigo"), *_LINE_ORDER
    )


@query(
    "update_status",
    sql(
        f"""SELECT OpportunityId, Codigo, FechaModificacion,
      CASE WHEN rn = 1 THEN l_linenumber ELSE ActaPublicada END AS ActaPublicada,
      CASE WHEN rn = 1 THEN CAST(l_partkey AS VARCHAR) ELSE UrlActaDL END AS UrlActaDL,
      CASE WHEN rn = 1 THEN NULL ELSE NombreArchivoActa END AS NombreArchivoActa,
      CASE WHEN rn = 1 THEN CAST(l_suppkey AS INTEGER) ELSE Url_visitada END AS Url_visitada,
      CASE WHEN rn = 1 THEN {_RUN} ELSE FechaModificacionReg END AS FechaModificacionReg
    FROM registry LEFT JOIN last_line ON CAST(l_orderkey AS VARCHAR) = Codigo""",
        "registry",
        "last_line",
    ),
)
def update_status(spark, sf_dir):
    lines = _line_updates(spark, sf_dir).select(
        "Codigo",
        *_LINE_ORDER,
        F.col("l_linenumber").alias("ActaPublicada"),
        F.col("l_partkey").cast("string").alias("UrlActaDL"),
        F.lit(None).cast("string").alias("NombreArchivoActa"),
        F.col("l_suppkey").cast("int").alias("Url_visitada"),
    )
    columns = ["ActaPublicada", "UrlActaDL", "NombreArchivoActa", "Url_visitada"]
    registry = inputs.registry(spark, sf_dir)
    return updates.update_columns(registry, lines, columns, ["Codigo"], _LINE_ORDER, RUN_TS)


_CHANGED = ", ".join(
    f"CASE WHEN s.Codigo IS NOT NULL THEN "
    + f"s.{f}"
    + f" ELSE r.{f} END AS {f}"
    for f in UPDATE_FIELDS
)


@query(
    "update_changed",
    sql(
        f"""SELECT r.OpportunityId, r.Codigo, {_CHANGED}, r.URLAnuncio, r.ActaPublicada, r.UrlActaDL,
      r.NombreArchivoActa, r.FechaCreacionReg, r.Url_visitada,
      CASE WHEN s.Codigo IS NOT NULL THEN {_RUN} ELSE r.FechaModificacionReg END AS FechaModificacionReg
    FROM full_registry r LEFT JOIN full_staged s
      ON r.OpportunityId = s.OpportunityId AND r.Codigo = s.Codigo""",
        "raw",
        "registry",
        "full_registry",
        "full_staged",
    ),
)
def update_changed(spark, sf_dir):
    raw = inputs.raw_notices(spark, sf_dir)
    staged = stage(raw, inputs.dimension(spark, sf_dir), inputs.AS_OF, inputs.WINDOW_DAYS, RUN_TS)
    return updates.update_changed(
        inputs.full_registry(spark, sf_dir), staged.rows, order=["_seq"], run_ts=RUN_TS
    )


@query(
    "update_predicate",
    sql(
        f"""SELECT * REPLACE (
      CASE WHEN UrlActaDL = '' AND Url_visitada = 1 THEN 'none' ELSE UrlActaDL END AS UrlActaDL,
      CASE WHEN UrlActaDL = '' AND Url_visitada = 1 THEN ActaPublicada + 2 ELSE ActaPublicada END AS ActaPublicada,
      CASE WHEN UrlActaDL = '' AND Url_visitada = 1 THEN {_RUN} ELSE FechaModificacionReg END
        AS FechaModificacionReg) FROM whole_registry""",
        "whole_registry",
    ),
)
def update_predicate(spark, sf_dir):
    predicate = (F.col("UrlActaDL") == "") & (F.col("Url_visitada") == 1)
    values = {
        "UrlActaDL": F.lit("none"),
        "ActaPublicada": F.col("ActaPublicada") + 2,
        "FechaModificacionReg": moment(RUN_TS),
    }
    return updates.update_where(inputs.whole_registry(spark, sf_dir), predicate, values)


@query(
    "repath",
    sql(
        f"""SELECT r.* REPLACE (coalesce(f.new, r.UrlActaDL) AS UrlActaDL,
      CASE WHEN f.new IS NULL THEN r.FechaModificacionReg ELSE {_RUN} END AS FechaModificacionReg)
    FROM whole_registry r LEFT JOIN (SELECT UrlActaDL AS old, 'new/' || NombreArchivoActa AS new
      FROM whole_registry WHERE ActaPublicada = 1 AND UrlActaDL <> '') f ON f.old = r.UrlActaDL""",
        "whole_registry",
    ),
)
def repath(spark, sf_dir):
    registry = inputs.whole_registry(spark, sf_dir)
    moved = (F.col("ActaPublicada") == 1) & (F.col("UrlActaDL") != "")
    moves = registry.filter(moved).select(
        F.col("UrlActaDL").alias("old"),
        F.concat(F.lit("new/"), F.col("NombreArchivoActa")).alias("new"),
    )
    return updates.repath(registry, moves, RUN_TS)


@query(
    "repath_like",
    sql(
        f"""SELECT * REPLACE (
      CASE WHEN UrlActaDL LIKE '%/1999/0_/%' THEN 'moved' ELSE UrlActaDL END AS UrlActaDL,
      CASE WHEN UrlActaDL LIKE '%/1999/0_/%' THEN {_RUN} ELSE FechaModificacionReg END
        AS FechaModificacionReg) FROM whole_registry""",
        "whole_registry",
    ),
)
def repath_like(spark, sf_dir):
    return updates.repath_like(inputs.whole_registry(spark, sf_dir), "moved", "%/1999/0_/%", RUN_TS)


# --- outcomes and reports ---------------------------------------------------------
MONTH = "202401"
CTES["user_registry"] = """
  SELECT 'C' || c_custkey AS Codigo, CAST(c_custkey AS INTEGER) AS OpportunityId,
    CASE WHEN c_acctbal < 0 THEN 1 ELSE 0 END AS ActaPublicada,
    '' AS UrlActaDL, '' AS NombreArchivoActa, CASE WHEN c_acctbal > 5000 THEN 1 ELSE 0 END AS Url_visitada,
    TIMESTAMP '2000-01-01 00:00:00' AS FechaModificacionReg FROM customer"""


def user_registry(spark, sf_dir):
    return table(spark, sf_dir, "customer").select(
        F.concat(F.lit("C"), F.col("c_custkey").cast("string")).alias("Codigo"),
        F.col("c_custkey").cast("int").alias("OpportunityId"),
        F.when(F.col("c_acctbal") < 0, 1).otherwise(0).alias("ActaPublicada"),
        F.lit("").alias("UrlActaDL"),
        F.lit("").alias("NombreArchivoActa"),
        F.when(F.col("c_acctbal") > 5000, 1).otherwise(0).alias("Url_visitada"),
        F.lit("2000-01-01 00:00:00").cast("timestamp_ntz").alias("FechaModificacionReg"),
    )


def _apply_sql(source: str) -> str:
    base = "'proposiciones_' || OpportunityId || '_' || Codigo || '_202401_' || last_seq"
    return f"""SELECT Codigo, OpportunityId,
      CASE WHEN published THEN 1 ELSE ActaPublicada END AS ActaPublicada,
      CASE WHEN last_seq IS NOT NULL THEN '{DOCUMENT_FOLDER}/2024/01/' || {base} || '.pdf'
        ELSE UrlActaDL END AS UrlActaDL,
      CASE WHEN last_seq IS NOT NULL THEN {base} ELSE NombreArchivoActa END AS NombreArchivoActa,
      CASE WHEN visited THEN 1 ELSE Url_visitada END AS Url_visitada,
      CASE WHEN published IS NOT NULL THEN {_RUN} ELSE FechaModificacionReg END AS FechaModificacionReg
    FROM {source} LEFT JOIN changes USING (Codigo, OpportunityId)"""


@query(
    "apply_outcomes", sql(_apply_sql("user_registry"), "outcomes", "changes", "user_registry")
)
def apply_outcomes(spark, sf_dir):
    changes = status.outcome_updates(inputs.outcomes(spark, sf_dir), F.lit(MONTH))
    return status.apply_outcomes(user_registry(spark, sf_dir), changes, RUN_TS)


def _entries(spark, sf_dir):
    return status.outcome_entries(inputs.outcomes(spark, sf_dir), F.lit(MONTH))


@query(
    "outcome_entries",
    sql("SELECT source_file, Codigo, OpportunityId, bucket, name FROM entries", "outcomes", "entries"),
)
def outcome_entries(spark, sf_dir):
    return _entries(spark, sf_dir).select("source_file", "Codigo", "OpportunityId", "bucket", "name")


_LOG_MEANT = f"'{DOCUMENT_FOLDER}/2024/01/' || {inputs._FILE}"
_LOG_ERROR = "coalesce(error, '')"
_LOG_LINES = [
    ("error IS NOT NULL", "main", inputs._BASE, f"'No se descargo acta. Error: ' || {_LOG_ERROR}"),
    ("error IS NULL AND page_status <> 200", "main", inputs._BASE, "'Acta no descargada. Status_code: ' || page_status"),
    (f"{inputs._PAGE_OK} AND n_links = 0", "main", inputs._BASE, "'No se encontraron Actas. longitud row_actas: ' || n_links"),
    (f"{inputs._FETCHED} AND stored", "main", inputs._FILE, "'Acta descargada'"),
    (f"{inputs._FETCHED} AND NOT stored", "main", inputs._BASE, f"'Acta no descargada. Error: ' || {_LOG_ERROR}"),
    (f"{inputs._FETCHED} AND uploaded", "main", inputs._FILE, "'Respuesta dl: True'"),
    (f"{inputs._FETCHED} AND NOT uploaded", "main", inputs._FILE, "'Respuesta dl: False'"),
    (f"{inputs._FETCHED} AND NOT uploaded", "pending", f"'tmp/' || {inputs._FILE}", f"' path_dl=' || {_LOG_MEANT}"),
    (f"{inputs._FETCHED} AND uploaded IS NULL", "main", inputs._FILE,
     f"'Acta no subida al data lake, error: ' || {_LOG_ERROR}"),
    (f"{inputs._FETCHED} AND uploaded IS NULL", "pending", inputs._FILE,
     f"'Acta no subida al data lake, error: ' || {_LOG_ERROR}"),
]


@query(
    "outcome_log",
    sql(
        " UNION ALL ".join(
            f"SELECT source_file, '{log}' AS log, {name} AS name, {result} AS result FROM outcomes WHERE {where}"
            for where, log, name, result in _LOG_LINES
        )
        + f""" UNION ALL SELECT DISTINCT source_file, 'main', {inputs._BASE}, 'Acta localizada.' FROM outcomes
          WHERE {inputs._PAGE_OK} AND n_links > 0""",
        "outcomes",
    ),
)
def outcome_log(spark, sf_dir):
    """Lines of both logs; a visit is a notice of one day's file."""
    visit = ["source_file", "Codigo", "OpportunityId"]
    lines = status.outcome_log(inputs.outcomes(spark, sf_dir), F.lit(MONTH), "tmp", visit)
    return lines.select("source_file", "log", "name", "result")


@query(
    "bucket_report",
    sql(
        "SELECT source_file, bucket, name, count(*) AS times FROM entries GROUP BY ALL",
        "outcomes",
        "entries",
    ),
)
def bucket_report(spark, sf_dir):
    return report.bucket_items(_entries(spark, sf_dir))


CTES["bucket_counts"] = f"""
  SELECT f.source_file, b.bucket, count(e.bucket) AS n
  FROM (SELECT DISTINCT source_file FROM entries) f
  CROSS JOIN (SELECT unnest({FILE_BUCKETS}) AS bucket) b
  LEFT JOIN entries e ON e.source_file = f.source_file AND e.bucket = b.bucket
  GROUP BY ALL"""


@query(
    "bucket_counts",
    sql("SELECT source_file, bucket, n FROM bucket_counts", "outcomes", "entries", "bucket_counts"),
)
def bucket_counts(spark, sf_dir):
    return report.bucket_counts(_entries(spark, sf_dir))


@query(
    "report_wide",
    sql(
        """SELECT metric, source_file, n FROM (
      SELECT bucket AS metric, source_file, n FROM bucket_counts) b""",
        "outcomes",
        "entries",
        "bucket_counts",
    ),
)
def report_wide(spark, sf_dir):
    """The wide report of all source files, written as CSV and read back as rows."""
    counts = report.bucket_counts(_entries(spark, sf_dir))
    long = counts.withColumnsRenamed({"bucket": "metric", "n": "value"})
    folder = shared_dir(spark, "report")
    sinks.write_report(report.wide_report(long), folder)
    wide = spark.read.csv(folder, header=True)
    files = [c for c in wide.columns if c != "metric"]
    return wide.unpivot("metric", [F.col(f"`{f}`") for f in files], "source_file", "n").select(
        "metric", "source_file", F.col("n").cast("long").alias("n")
    )
