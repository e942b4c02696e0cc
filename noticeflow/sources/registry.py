"""Scans of the registry, the work queue and SQL text."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import moment
from ..operators.keys import search_registry
from ..schema import KEYS

__all__ = [
    "changed_since",
    "pending_downloads",
    "pending_uploads",
    "query",
    "query_jdbc",
    "queue_head",
    "search_registry",
]


def query(spark: SparkSession, text: str, names: list[str] | None = None) -> DataFrame:
    """Any SELECT over registered views; names from the argument or the result."""
    frame = spark.sql(text)
    return frame.toDF(*names) if names else frame


def query_jdbc(spark: SparkSession, url: str, text: str, **options) -> DataFrame:
    """The same text run by a database that has a JDBC driver on the class path."""
    return (
        spark.read.format("jdbc").option("url", url).option("query", text).options(**options).load()
    )


def changed_since(
    registry: DataFrame, since: datetime | str, fields: list[str] = KEYS
) -> DataFrame:
    return registry.filter(F.col("FechaModificacion") >= moment(since)).select(*fields)


def pending_uploads(registry: DataFrame, fields: list[str] = KEYS) -> DataFrame:
    """Published documents without a path; a NULL path is not pending."""
    return registry.filter((F.col("ActaPublicada") == 1) & (F.col("UrlActaDL") == "")).select(
        *fields
    )


def pending_downloads(registry: DataFrame, fields: list[str] = KEYS) -> DataFrame:
    """Notices neither published nor visited; NULL flags are not pending."""
    return registry.filter((F.col("ActaPublicada") == 0) & (F.col("Url_visitada") == 0)).select(
        *fields
    )


def queue_head(
    queue: DataFrame, month: int, order: list[str], rows: int
) -> DataFrame:
    """First ``rows`` entries of a month not yet asked for, in key order."""
    open_rows = queue.filter((F.col("anomes") == month) & F.col("FechaUltimaConsulta").isNull())
    return open_rows.orderBy(*order).limit(rows)
