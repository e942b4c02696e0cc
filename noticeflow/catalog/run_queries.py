"""Whole runs: staging, incremental run, pending pass, stream."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import report, status
from ..plans.incremental import run_incremental
from ..plans.pending import drain_pending, resolve_pending
from ..plans.staging import stage
from ..schema import RAW_HEADERS, REGISTRY_FIELDS, REGISTRY_SCHEMA, STAGE_COUNTS, STAGED_FIELDS
from ..session import shared_dir
from ..sinks.snapshots import SnapshotTable
from ..streaming.ingest import start_ingest, stream_notices
from . import inputs
from .inputs import AS_OF, CTES, RUN_TS, WINDOW_DAYS, sql
from .registry import query
from .table_queries import MONTH

_RUN = f"TIMESTAMP '{RUN_TS}'"
_STAGED = ", ".join(STAGED_FIELDS)


def _in(table: str, key: str) -> str:
    return f"{key} IN (SELECT {key} FROM {table})"


# --- SQL of a run on the full batch and registry ------------------------------
CTES["run_hits"] = f"""SELECT * FROM full_registry
  WHERE {_in("full_staged", "OpportunityId")} AND {_in("full_staged", "Codigo")}"""
CTES["run_existing"] = f"""SELECT * FROM full_staged
  WHERE {_in("run_hits", "OpportunityId")} AND {_in("run_hits", "Codigo")}"""
CTES["run_open"] = f"""SELECT * FROM full_registry WHERE ActaPublicada = 0 AND UrlActaDL = ''
  AND {_in("run_existing", "OpportunityId")} AND {_in("run_existing", "Codigo")}"""
CTES["run_labelled"] = f"""
  SELECT *, CASE WHEN ko AND kc THEN 'existing' WHEN NOT ko AND NOT kc THEN 'new'
      ELSE 'conflict' END AS label,
    CASE WHEN ko AND kc THEN CASE WHEN oo AND oc THEN 'without_document'
      WHEN NOT oo AND NOT oc THEN 'with_document' ELSE 'mixed' END END AS document
  FROM (SELECT *, {_in("run_existing", "OpportunityId")} AS ko, {_in("run_existing", "Codigo")} AS kc,
    {_in("run_open", "OpportunityId")} AS oo, {_in("run_open", "Codigo")} AS oc FROM full_staged) s"""
_CTES = ["raw", "registry", "full_registry", "full_staged", "run_hits", "run_existing", "run_open", "run_labelled"]


def _changed(new: str, old: str) -> str:
    from ..schema import UPDATE_FIELDS

    parts = []
    for field in REGISTRY_FIELDS:
        if field == "FechaModificacionReg":
            value = _RUN
        elif field in UPDATE_FIELDS:
            value = f"{new}.{field}"
        else:
            value = f"{old}.{field}"
        parts.append(
            f"CASE WHEN {new}.Codigo IS NOT NULL THEN {value} ELSE {old}.{field} END AS {field}"
        )
    return ", ".join(parts)


def _run(spark, sf_dir):
    return run_incremental(
        inputs.raw_notices(spark, sf_dir),
        inputs.full_registry(spark, sf_dir),
        inputs.dimension(spark, sf_dir),
        AS_OF,
        WINDOW_DAYS,
        RUN_TS,
    )


@query(
    "stage_notices",
    sql(f"SELECT {_STAGED}, source_file, seq AS _seq FROM full_staged", "raw", "full_staged"),
)
def stage_notices(spark, sf_dir):
    raw = inputs.raw_notices(spark, sf_dir)
    return stage(raw, inputs.dimension(spark, sf_dir), AS_OF, WINDOW_DAYS, RUN_TS).rows


@query(
    "run_incremental",
    sql(
        f"""SELECT {_changed('s', 'r')} FROM full_registry r LEFT JOIN
      (SELECT * FROM run_labelled WHERE document = 'without_document') s
      ON s.OpportunityId = r.OpportunityId AND s.Codigo = r.Codigo
    UNION ALL SELECT {', '.join(STAGED_FIELDS)}, 0 FROM run_labelled WHERE label = 'new'""",
        *_CTES,
    ),
)
def run_incremental_query(spark, sf_dir):
    """The registry after the run."""
    return _run(spark, sf_dir).registry


@query(
    "run_worklist",
    sql(
        f"""SELECT DISTINCT {_STAGED} FROM run_labelled
      WHERE label = 'new' OR document = 'without_document'""",
        *_CTES,
    ),
)
def run_worklist(spark, sf_dir):
    return _run(spark, sf_dir).worklist


@query(
    "stage_counts",
    sql(
        """SELECT source_file, count(*) AS filtered, count(*) FILTER (WHERE label = 'new') AS new,
      count(*) FILTER (WHERE label = 'existing') AS existing,
      count(*) FILTER (WHERE label = 'conflict') AS conflict,
      count(*) FILTER (WHERE document = 'without_document') AS without_document,
      count(*) FILTER (WHERE document = 'with_document') AS with_document,
      count(DISTINCT seq) FILTER (WHERE label = 'new' OR document = 'without_document') AS to_download
    FROM run_labelled GROUP BY source_file""",
        *_CTES,
    ),
)
def stage_counts(spark, sf_dir):
    return _run(spark, sf_dir).counts


_COUNTS = """SELECT source_file, count(*) AS filtered, count(*) FILTER (WHERE label = 'existing') AS existing,
      count(*) FILTER (WHERE document = 'without_document') AS without_document,
      count(*) FILTER (WHERE document = 'with_document') AS with_document,
      count(DISTINCT seq) FILTER (WHERE label = 'new' OR document = 'without_document') AS to_download
    FROM run_labelled GROUP BY source_file"""
_STAGES = " UNION ALL ".join(
    f"SELECT source_file, '{bucket}' AS bucket, {column or 'CAST(0 AS BIGINT)'} AS n FROM stages"
    for bucket, column in STAGE_COUNTS.items()
)
CTES["stages"] = _COUNTS


@query(
    "run_report",
    sql(
        f"{_STAGES} UNION ALL SELECT source_file, bucket, n FROM bucket_counts",
        *_CTES, "stages", "outcomes", "entries", "bucket_counts",
    ),
)
def run_report(spark, sf_dir):
    """Stage buckets of a run beside the buckets of its fetch outcomes."""
    entries = status.outcome_entries(inputs.outcomes(spark, sf_dir), F.lit(MONTH))
    return report.run_report(_run(spark, sf_dir).counts, entries)


@query(
    "filtered_addresses",
    sql(
        """SELECT source_file, 'actas_filtradas' AS bucket, URLAnuncio AS name, count(*) AS times
    FROM full_staged GROUP BY ALL""",
        "raw",
        "full_staged",
    ),
)
def filtered_addresses(spark, sf_dir):
    return report.filtered_addresses(_run(spark, sf_dir).classified)


# --- pending pass ---------------------------------------------------------------
CTES["found"] = """
  SELECT OpportunityId, Codigo, min(path) AS path FROM registry
    JOIN files ON string_split(path, '_')[2] = CAST(OpportunityId AS VARCHAR)
      AND string_split(path, '_')[3] = Codigo
  WHERE ActaPublicada = 1 AND UrlActaDL = '' GROUP BY ALL"""
CTES["order_outcomes"] = """
  SELECT CAST(l_orderkey AS VARCHAR) AS Codigo, CAST(o_custkey AS INTEGER) AS OpportunityId,
    l_linenumber AS seq, CASE WHEN l_returnflag = 'R' THEN 503 ELSE 200 END AS page_status,
    CASE WHEN l_quantity > 40 THEN 0 ELSE 1 END AS n_links, 3 AS link_pieces,
    200 AS file_status, l_quantity < 30 AS stored, l_linestatus = 'O' AS uploaded,
    CAST(NULL AS VARCHAR) AS error, 'pdf' AS ext
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""
CTES["due"] = """
  SELECT o.* FROM order_outcomes o SEMI JOIN (SELECT * FROM registry
    WHERE ActaPublicada = 0 AND Url_visitada = 0) r
  ON r.Codigo = o.Codigo AND r.OpportunityId = o.OpportunityId"""
CTES["due_changes"] = CTES["changes"].replace("FROM outcomes)", "FROM due)")
_FOLDER = inputs.DOCUMENT_FOLDER
_NAME = "'proposiciones_' || OpportunityId || '_' || Codigo || '_202401_' || last_seq"
CTES["resolved"] = f"""
  SELECT OpportunityId, Codigo,
    CASE WHEN published THEN 1 ELSE ActaPublicada END AS ActaPublicada,
    CASE WHEN path IS NOT NULL THEN '{_FOLDER}/' || string_split(path, '_')[4][1:4] || '/' ||
        string_split(path, '_')[4][5:6] || '/' || path[6:]
      WHEN last_seq IS NOT NULL THEN '{_FOLDER}/2024/01/' || {_NAME} || '.pdf' ELSE UrlActaDL END AS UrlActaDL,
    CASE WHEN path IS NOT NULL THEN replace(path[6:], '.pdf', '')
      WHEN last_seq IS NOT NULL THEN {_NAME} ELSE NombreArchivoActa END AS NombreArchivoActa,
    CASE WHEN visited THEN 1 ELSE Url_visitada END AS Url_visitada,
    CASE WHEN path IS NOT NULL OR published IS NOT NULL THEN {_RUN} ELSE FechaModificacionReg END
      AS FechaModificacionReg, FechaModificacion
  FROM registry LEFT JOIN found USING (OpportunityId, Codigo)
    LEFT JOIN due_changes USING (OpportunityId, Codigo)"""
_PENDING = ["registry", "files", "found", "order_outcomes", "due", "due_changes", "resolved"]


def order_outcomes(spark, sf_dir):
    lines = inputs.table(spark, sf_dir, "lineitem")
    orders = inputs.table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    joined = lines.join(orders, lines["l_orderkey"] == orders["o_orderkey"])
    return joined.select(
        F.col("l_orderkey").cast("string").alias("Codigo"),
        F.col("o_custkey").cast("int").alias("OpportunityId"),
        F.col("l_linenumber").alias("seq"),
        F.when(F.col("l_returnflag") == "R", 503).otherwise(200).alias("page_status"),
        F.when(F.col("l_quantity") > 40, 0).otherwise(1).alias("n_links"),
        F.lit(3).alias("link_pieces"),
        F.lit(200).alias("file_status"),
        (F.col("l_quantity") < 30).alias("stored"),
        (F.col("l_linestatus") == "O").alias("uploaded"),
        F.lit(None).cast("string").alias("error"),
        F.lit("pdf").alias("ext"),
    )


def _pending(spark, sf_dir):
    return resolve_pending(
        inputs.registry(spark, sf_dir),
        inputs.files(spark, sf_dir),
        order_outcomes(spark, sf_dir),
        F.lit(MONTH),
        RUN_TS,
    )


@query("resolve_pending", sql("SELECT * FROM resolved", *_PENDING))
def resolve_pending_query(spark, sf_dir):
    return _pending(spark, sf_dir).registry


@query(
    "pending_leftover",
    sql(
        """SELECT OpportunityId, Codigo, 'upload' AS pending FROM resolved WHERE ActaPublicada = 1 AND UrlActaDL = ''
    UNION ALL SELECT OpportunityId, Codigo, 'download' FROM resolved
      WHERE ActaPublicada = 0 AND Url_visitada = 0""",
        *_PENDING,
    ),
)
def pending_leftover(spark, sf_dir):
    return _pending(spark, sf_dir).leftover


_TRY = f"""SELECT Codigo, OpportunityId, seq, {inputs._LINK} AND file_status = 200 AND stored AS st,
    ({inputs._LINK} AND file_status = 200 AND stored) OR ({inputs._PAGE_OK} AND n_links = 0) AS ended,
    {inputs._LINK} AND file_status = 200 AND uploaded IS TRUE AS up FROM due"""
CTES["tries"] = f"""
  SELECT *, min(seq) FILTER (WHERE ended) OVER (PARTITION BY Codigo, OpportunityId) AS last
  FROM ({_TRY}) t WHERE seq <= 3"""
CTES["drained"] = """
  SELECT OpportunityId, Codigo, r.ActaPublicada, r.Url_visitada, r.UrlActaDL, last,
    coalesce(published, false) AS published, coalesce(uploaded, false) AS uploaded,
    EXISTS (SELECT 1 FROM files WHERE string_split(path, '_')[2] = CAST(r.OpportunityId AS VARCHAR)
      AND string_split(path, '_')[3] = r.Codigo) AS on_file
  FROM registry r LEFT JOIN (
    SELECT OpportunityId, Codigo, any_value(last) AS last, max(st) FILTER (WHERE seq = last) AS published,
      max(up) FILTER (WHERE last IS NULL OR seq <= last) AS uploaded FROM tries GROUP BY ALL) t
    USING (OpportunityId, Codigo)"""


@query(
    "drain_dead_letters",
    sql(
        """SELECT OpportunityId, Codigo, 'download' AS pending, CAST(3 AS INTEGER) AS attempts FROM drained
      WHERE ActaPublicada = 0 AND Url_visitada = 0 AND last IS NULL
    UNION ALL SELECT OpportunityId, Codigo, 'upload', 3 FROM drained WHERE UrlActaDL = '' AND NOT on_file
      AND (ActaPublicada = 1 OR (Url_visitada = 0 AND published AND NOT uploaded))""",
        "registry",
        "files",
        "order_outcomes",
        "due",
        "tries",
        "drained",
    ),
)
def drain_dead_letters(spark, sf_dir):
    """What is still pending after three attempts each; an order's lines are its attempts in turn."""
    outcomes = order_outcomes(spark, sf_dir)
    drain = drain_pending(
        inputs.registry(spark, sf_dir),
        inputs.files(spark, sf_dir),
        lambda queue, n: outcomes.filter(F.col("seq") == n),
        F.lit(MONTH),
        RUN_TS,
    )
    return drain.dead


# --- stream ---------------------------------------------------------------------
# Rows a task writes into one notice file; the number of files changes no result.
FILE_ROWS = 1_000_000
_RAW_BY_ORDER = CTES["raw"].replace("o_custkey", "o_orderkey")
CTES["stream_staged"] = CTES["full_staged"].replace("FROM raw)", f"FROM ({_RAW_BY_ORDER}) raw)").replace(
    "FROM raw", f"FROM ({_RAW_BY_ORDER}) raw"
)
CTES["stream_registry"] = (
    CTES["full_registry"]
    .replace("FROM raw JOIN", f"FROM ({_RAW_BY_ORDER}) raw JOIN")
    .replace("r.OpportunityId,", "CAST(o_orderkey AS INTEGER) AS OpportunityId,")
    .replace("o_custkey, o_orderstatus", "o_orderkey, o_custkey, o_orderstatus")
)


@query(
    "stream_ingest",
    sql(
        f"""SELECT {_changed('s', 'r')} FROM stream_registry r LEFT JOIN stream_staged s
      ON s.OpportunityId = r.OpportunityId AND r.ActaPublicada = 0 AND r.UrlActaDL = ''
    UNION ALL SELECT {_STAGED}, 0 FROM stream_staged
      WHERE OpportunityId NOT IN (SELECT OpportunityId FROM stream_registry)""",
        "registry",
        "stream_staged",
        "stream_registry",
    ),
)
def stream_ingest(spark, sf_dir):
    """The registry after three notice files arrived, more of a large table, each known by one id."""
    root = shared_dir(spark, "stream")
    raw = inputs.raw_notices(spark, sf_dir, "o_orderkey").select(*RAW_HEADERS)
    files = max(3, -(-raw.count() // FILE_ROWS))
    inputs.write_csv(raw.repartition(files), f"{root}/in")
    registry = SnapshotTable(spark, f"{root}/registry", REGISTRY_SCHEMA, writer="stream", index=["OpportunityId"])
    registry.write(inputs.full_registry(spark, sf_dir, "o_orderkey"), version=0)
    notices = stream_notices(spark, f"{root}/in", raw.schema)
    dim = inputs.dimension(spark, sf_dir)
    started = start_ingest(
        notices, registry, dim, AS_OF, WINDOW_DAYS, f"{root}/checkpoint", f"{root}/reports", RUN_TS
    )
    started.awaitTermination()
    return registry.read()


