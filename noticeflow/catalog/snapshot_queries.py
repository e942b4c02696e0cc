"""Queries on versioned registries: several writers, skipped files, few keys."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import functions as F

from ..functions.dates import moment
from ..session import shared_dir
from ..sinks.snapshots import SnapshotTable
from . import inputs
from .inputs import CTES, sql
from .key_queries import SINCE
from .registry import query

_COLUMNS = "OpportunityId, Codigo, FechaModificacion, ActaPublicada, UrlActaDL, Url_visitada"


def _table(spark, rows, writer=None, folder=None):
    folder = folder or shared_dir(spark, "snapshots")
    return SnapshotTable(spark, folder, rows.schema, writer=writer, index=["OpportunityId"])


def _by_year(spark, sf_dir):
    """The whole registry, old and recent notices as two inserts."""
    rows = inputs.whole_registry(spark, sf_dir)
    table, recent = _table(spark, rows), F.col("FechaModificacion") >= moment(SINCE)
    table.write(rows.filter(~recent))
    table.merge(rows.limit(0), lambda part: part, rows.filter(recent))
    return table


@query("snapshot_writers", sql(f"SELECT {_COLUMNS} FROM whole_registry", "whole_registry"))
def snapshot_writers(spark, sf_dir):
    """Two writers insert at the same time; no row is lost."""
    rows = inputs.whole_registry(spark, sf_dir)
    root = shared_dir(spark, "snapshots")
    done = F.col("ActaPublicada") == 1
    tables = [_table(spark, rows, name, root) for name in ("one", "two")]

    def insert(table, own):
        table.merge(rows.limit(0), lambda part: part, own)

    with ThreadPoolExecutor(2) as pool:
        list(pool.map(insert, tables, [rows.filter(done), rows.filter(~done)]))
    return tables[0].read().select(*_COLUMNS.split(", "))


@query(
    "snapshot_changed_since",
    sql(
        f"""SELECT Codigo, UrlActaDL FROM whole_registry
      WHERE FechaModificacion >= TIMESTAMP '{SINCE}'""",
        "whole_registry",
    ),
)
def snapshot_changed_since(spark, sf_dir):
    """The date scan on a snapshot opens the parts that hold recent notices."""
    return _by_year(spark, sf_dir).read_between("FechaModificacion", least=SINCE).select("Codigo", "UrlActaDL")


@query(
    "snapshot_update_where",
    sql(
        f"""SELECT OpportunityId, Codigo, FechaModificacion, ActaPublicada, UrlActaDL,
      CASE WHEN ActaPublicada = 0 AND FechaModificacion >= TIMESTAMP '{SINCE}' THEN 9 ELSE Url_visitada END
        AS Url_visitada FROM whole_registry""",
        "whole_registry",
    ),
)
def snapshot_update_where(spark, sf_dir):
    """A predicate update of recent notices leaves the files of old ones alone."""
    table = _by_year(spark, sf_dir)
    table.update_where(F.col("ActaPublicada") == 0, {"Url_visitada": F.lit(9)}, "FechaModificacion", least=SINCE)
    return table.read().select(*_COLUMNS.split(", "))


CTES["asked"] = "SELECT CAST(c_custkey AS INTEGER) AS OpportunityId FROM customer"


@query(
    "snapshot_lookup",
    sql(
        f"SELECT {_COLUMNS} FROM whole_registry SEMI JOIN asked USING (OpportunityId)", "whole_registry", "asked"
    ),
)
def snapshot_lookup(spark, sf_dir):
    """Notices of all customers by id, through the id index of the snapshot."""
    table = _by_year(spark, sf_dir)
    customers = inputs.table(spark, sf_dir, "customer")
    asked = customers.select(F.col("c_custkey").cast("int").alias("OpportunityId")).distinct()
    rows = table.read_for(asked, ["OpportunityId"])
    return rows.join(asked, "OpportunityId", "left_semi").select(*_COLUMNS.split(", "))
