"""Named queries on the given tables, each with the SQL that checks it."""

from . import key_queries, run_queries, snapshot_queries, source_queries, table_queries, text_queries  # noqa: F401
from .registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
