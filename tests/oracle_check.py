"""Compare every query with its SQL on one data folder.

``python tests/oracle_check.py [folder] [name ...]`` prints one line per query.
"""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb
import pandas as pd

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _text(value) -> str:
    if value is None or value is pd.NaT or (isinstance(value, float) and value != value):
        return "NULL"
    if isinstance(value, bool):
        return str(value)
    return str(value)


def rows(columns: list[str], data: list[tuple]) -> list[tuple[str, ...]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_text(r[i]) for i in order) for r in data)


KINDS = {"int": "i", "bigint": "i", "string": "s", "timestamp_ntz": "t", "boolean": "b", "double": "d"}
SQL_KINDS = {
    "INTEGER": "int", "BIGINT": "bigint", "VARCHAR": "string", "TIMESTAMP": "timestamp_ntz",
    "BOOLEAN": "boolean", "DOUBLE": "double",
}


def compare(frame, con, text: str) -> str | None:
    """None when equal, else what differs."""
    result = con.sql(text)
    types = {c: SQL_KINDS.get(str(t), str(t)) for c, t in zip(result.columns, result.types)}
    mine = dict(frame.dtypes)
    if set(mine) != set(types):
        return f"columns {sorted(set(mine) ^ set(types))}"
    got = rows(frame.columns, [tuple(r) for r in frame.collect()])
    want = rows(result.columns, result.fetchall())
    if got != want:
        pairs = [(g, w) for g, w in zip(got, want) if g != w][:1]
        return f"rows {len(got)} / {len(want)}; first difference {pairs}"[:1500]
    wrong = {c: (mine[c], types[c]) for c in mine if mine[c] != types[c]}
    return f"types {wrong}" if wrong else None


def main(argv: list[str]) -> int:
    from noticeflow.catalog import ORACLES, QUERIES
    from noticeflow.session import local_session

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    names = argv[1:] or list(QUERIES)
    spark, con, bad = local_session(), connect(sf_dir), 0
    for name in names:
        start = time.time()
        try:
            frame = QUERIES[name](spark, sf_dir)
            if name in ORACLES:
                problem = compare(frame, con, ORACLES[name])
            else:
                problem = None if frame.count() else "no rows"
        except Exception as error:  # noqa: BLE001
            problem = f"{type(error).__name__}: {str(error)[:1200]}"
        bad += problem is not None
        print(f"{name:32s} {time.time() - start:6.1f}s  {problem or 'ok'}", flush=True)
    print(f"{len(names) - bad} of {len(names)} ok")
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
