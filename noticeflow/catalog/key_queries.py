"""Queries over key membership, lookups and file matching."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import keys, lookup, match_files
from ..operators.project import fold_headers, rename_fields, undocumented, union_distinct
from ..functions.text import prepare_state
from ..schema import DOCUMENT_KIND
from ..sources import registry as scans
from . import inputs
from .inputs import CTES, sql
from .registry import query

# --- SQL of the key semantics, on the narrow batch and registry --------------
CTES["hits"] = """
  SELECT * FROM registry WHERE OpportunityId IN (SELECT OpportunityId FROM staged)
    AND Codigo IN (SELECT Codigo FROM staged)"""
CTES["existing"] = """
  SELECT * FROM staged WHERE OpportunityId IN (SELECT OpportunityId FROM hits)
    AND Codigo IN (SELECT Codigo FROM hits)"""
CTES["open_rows"] = """
  SELECT * FROM registry WHERE ActaPublicada = 0 AND UrlActaDL = ''
    AND OpportunityId IN (SELECT OpportunityId FROM existing)
    AND Codigo IN (SELECT Codigo FROM existing)"""
CTES["without_doc"] = """
  SELECT * FROM existing WHERE OpportunityId IN (SELECT OpportunityId FROM open_rows)
    AND Codigo IN (SELECT Codigo FROM open_rows)"""
CTES["new_rows"] = """
  SELECT * FROM staged WHERE OpportunityId NOT IN (SELECT OpportunityId FROM existing)
    AND Codigo NOT IN (SELECT Codigo FROM existing)"""
_BASE = ["staged", "registry", "hits", "existing"]
_DOCS = [*_BASE, "open_rows", "without_doc"]
_COLS = "OpportunityId, Codigo, FechaModificacion"


def _inputs(spark, sf_dir):
    return inputs.staged(spark, sf_dir), inputs.registry(spark, sf_dir)


@query(
    "key_list_scan",
    sql("SELECT Codigo, UrlActaDL, Url_visitada FROM hits", *_BASE[:3]),
)
def key_list_scan(spark, sf_dir):
    staged, registry = _inputs(spark, sf_dir)
    return keys.search_registry(registry, staged, ["Codigo", "UrlActaDL", "Url_visitada"])


@query("semi_independent", sql(f"SELECT {_COLS} FROM existing", *_BASE))
def semi_independent(spark, sf_dir):
    return keys.ask_registry(*_inputs(spark, sf_dir))


@query(
    "anti_independent",
    sql(
        f"""SELECT {_COLS} FROM staged
      WHERE OpportunityId NOT IN (SELECT OpportunityId FROM registry)
        AND Codigo NOT IN (SELECT Codigo FROM registry)""",
        *_BASE[:2],
    ),
)
def anti_independent(spark, sf_dir):
    return keys.anti_independent(*_inputs(spark, sf_dir))


@query(
    "semi_tuple",
    sql(
        f"""SELECT {_COLS} FROM staged s WHERE EXISTS (SELECT 1 FROM registry r
      WHERE r.OpportunityId = s.OpportunityId AND r.Codigo = s.Codigo)""",
        *_BASE[:2],
    ),
)
def semi_tuple(spark, sf_dir):
    return keys.semi_tuple(*_inputs(spark, sf_dir))


@query(
    "anti_tuple",
    sql(
        f"""SELECT {_COLS} FROM staged s WHERE NOT EXISTS (SELECT 1 FROM registry r
      WHERE r.OpportunityId = s.OpportunityId AND r.Codigo = s.Codigo)""",
        *_BASE[:2],
    ),
)
def anti_tuple(spark, sf_dir):
    return keys.anti_tuple(*_inputs(spark, sf_dir))


def _known(table: str, key: str) -> str:
    return f"{key} IN (SELECT {key} FROM {table})"


CTES["labelled"] = f"""
  SELECT {_COLS}, CASE WHEN ko AND kc THEN 'existing' WHEN NOT ko AND NOT kc THEN 'new'
      ELSE 'conflict' END AS label,
    CASE WHEN ko AND kc THEN CASE WHEN oo AND oc THEN 'without_document'
      WHEN NOT oo AND NOT oc THEN 'with_document' ELSE 'mixed' END END AS document
  FROM (SELECT *, {_known("existing", "OpportunityId")} AS ko, {_known("existing", "Codigo")} AS kc,
    {_known("open_rows", "OpportunityId")} AS oo, {_known("open_rows", "Codigo")} AS oc FROM staged) s"""


@query(
    "classify_batch", sql(f"SELECT {_COLS}, label, document FROM labelled", *_DOCS[:5], "labelled")
)
def classify_batch(spark, sf_dir):
    return keys.classify(*_inputs(spark, sf_dir))


@query(
    "classify_batch_tuple",
    sql(
        f"""SELECT {_COLS}, CASE WHEN open IS NULL THEN 'new' ELSE 'existing' END AS label,
      CASE WHEN open THEN 'without_document' WHEN NOT open THEN 'with_document' END AS document
    FROM staged LEFT JOIN (SELECT OpportunityId, Codigo,
        bool_or(ActaPublicada = 0 AND UrlActaDL = '') AS open FROM registry GROUP BY ALL) r
      USING (OpportunityId, Codigo)""",
        *_BASE[:2],
    ),
)
def classify_batch_tuple(spark, sf_dir):
    return keys.classify(*_inputs(spark, sf_dir), match="tuple")


@query("existing_without_doc", sql(f"SELECT {_COLS} FROM without_doc", *_DOCS))
def existing_without_doc(spark, sf_dir):
    staged, registry = _inputs(spark, sf_dir)
    return keys.existing_without_document(keys.ask_registry(staged, registry), registry)


@query(
    "existing_with_doc",
    sql(
        f"""SELECT {_COLS} FROM existing
      WHERE OpportunityId NOT IN (SELECT OpportunityId FROM without_doc)
        AND Codigo NOT IN (SELECT Codigo FROM without_doc)""",
        *_DOCS,
    ),
)
def existing_with_doc(spark, sf_dir):
    staged, registry = _inputs(spark, sf_dir)
    existing = keys.ask_registry(staged, registry)
    without = keys.existing_without_document(existing, registry)
    return keys.existing_with_document(existing, without)


@query("registry_without_doc", sql("SELECT * FROM open_rows", *_DOCS[:5]))
def registry_without_doc(spark, sf_dir):
    staged, registry = _inputs(spark, sf_dir)
    return keys.registry_without_document(keys.ask_registry(staged, registry), registry)


@query(
    "undocumented_rows",
    sql("SELECT * FROM whole_registry WHERE ActaPublicada = 0 AND UrlActaDL = ''", "whole_registry"),
)
def undocumented_rows(spark, sf_dir):
    return undocumented(inputs.whole_registry(spark, sf_dir))


SINCE = "1999-06-01 00:00:00"
_ARCHIVED = f"""SELECT * FROM registry WHERE FechaModificacion >= TIMESTAMP '{SINCE}'
  AND contains(UrlActaDL, '{DOCUMENT_KIND}_') AND contains(NombreArchivoActa, '{DOCUMENT_KIND}_')"""


@query(
    "not_archived",
    sql(
        f"""SELECT {_COLS} FROM staged
      WHERE OpportunityId NOT IN (SELECT OpportunityId FROM ({_ARCHIVED}) a)
        AND Codigo NOT IN (SELECT Codigo FROM ({_ARCHIVED}) a)""",
        *_BASE[:2],
    ),
)
def not_archived(spark, sf_dir):
    return keys.not_archived(*_inputs(spark, sf_dir), SINCE)


@query(
    "changed_since",
    sql(
        f"""SELECT Codigo, UrlActaDL FROM whole_registry
      WHERE FechaModificacion >= TIMESTAMP '{SINCE}'""",
        "whole_registry",
    ),
)
def changed_since(spark, sf_dir):
    return scans.changed_since(inputs.whole_registry(spark, sf_dir), SINCE, ["Codigo", "UrlActaDL"])


@query(
    "worklist",
    sql(
        f"SELECT {_COLS} FROM new_rows UNION SELECT {_COLS} FROM without_doc", *_DOCS, "new_rows"
    ),
)
def worklist(spark, sf_dir):
    labelled = keys.classify(*_inputs(spark, sf_dir))
    new = labelled.filter(F.col("label") == keys.NEW).drop("label", "document")
    waiting = labelled.filter(F.col("document") == keys.WITHOUT).drop("label", "document")
    return union_distinct(new, waiting)


@query(
    "state_lookup",
    sql(
        "SELECT Codigo, "
        + inputs._STATE_SQL.replace("o_state", "IdEstado").replace("ELSE '' END", "END")
        + " AS IdEstado FROM raw",
        "raw",
    ),
)
def state_lookup(spark, sf_dir):
    raw = rename_fields(fold_headers(inputs.raw_notices(spark, sf_dir)))
    named = raw.select("Codigo", prepare_state(F.col("IdEstado")).alias("IdEstado"))
    return lookup.map_states(named, inputs.dimension(spark, sf_dir))


@query(
    "state_dimension",
    """SELECT CASE WHEN n_name = 'NATION_7' THEN 'MEXICO' ELSE n_name END AS Estado,
      n_nationkey AS IdEstado FROM nation""",
)
def state_dimension(spark, sf_dir):
    nation = inputs.table(spark, sf_dir, "nation")
    spelled = F.when(F.col("n_name") == "NATION_7", "ESTADO DE MEXICO").otherwise(F.col("n_name"))
    dim = nation.select(spelled.alias("Estado"), F.col("n_nationkey").alias("IdEstado"))
    return lookup.state_dimension(dim)


# --- files --------------------------------------------------------------------
_PENDING = "SELECT OpportunityId, Codigo FROM whole_registry WHERE ActaPublicada = 1 AND UrlActaDL = ''"


@query(
    "pattern_join_files",
    sql(
        f"""SELECT OpportunityId, Codigo, (SELECT min(path) FROM files f
        WHERE string_split(f.path, '_')[2] = CAST(OpportunityId AS VARCHAR)
          AND string_split(f.path, '_')[3] = Codigo) AS path FROM ({_PENDING}) p""",
        "whole_registry",
        "files",
    ),
)
def pattern_join_files(spark, sf_dir):
    pending = scans.pending_uploads(inputs.whole_registry(spark, sf_dir), ["OpportunityId", "Codigo"])
    return match_files.match_documents(pending, inputs.files(spark, sf_dir))


@query(
    "pattern_join_files_prefix",
    sql(
        f"""SELECT OpportunityId, Codigo, min(path) AS path FROM (
      SELECT DISTINCT OpportunityId, Codigo FROM ({_PENDING}) p) q
      LEFT JOIN files ON CAST(string_split(path, '_')[2] AS INTEGER) = OpportunityId
        AND starts_with(path, 'data/{DOCUMENT_KIND}_' || OpportunityId || '_' || Codigo)
      GROUP BY ALL""",
        "whole_registry",
        "files",
    ),
)
def pattern_join_files_prefix(spark, sf_dir):
    pending = scans.pending_uploads(inputs.whole_registry(spark, sf_dir), ["OpportunityId", "Codigo"])
    return match_files.match_documents(pending.distinct(), inputs.files(spark, sf_dir), match="prefix")


CTES["wanted"] = f"""SELECT 'data/{DOCUMENT_KIND}_' || OpportunityId || '_' || Codigo AS name
  FROM staged"""


@query(
    "names_present",
    sql(
        """SELECT name FROM wanted SEMI JOIN (
      SELECT DISTINCT unnest(list_transform(range(1, length(path) + 1), lambda n: path[1:n])) AS name
      FROM files) f USING (name)""",
        "staged",
        "files",
        "wanted",
    ),
)
def names_present(spark, sf_dir):
    staged, files = inputs.staged(spark, sf_dir), inputs.files(spark, sf_dir)
    prefix = F.concat_ws("_", F.lit(f"data/{DOCUMENT_KIND}"), F.col("OpportunityId").cast("string"), "Codigo")
    wanted = staged.select(prefix.alias("name"))
    return match_files.names_present(wanted, files.select(F.col("path").alias("name")))
