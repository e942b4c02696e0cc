"""Queries over sources and sinks."""

from __future__ import annotations

import csv
import io
import zipfile

import pandas as pd
from pyspark.sql import functions as F

from ..functions.nested import megabytes
from ..operators.project import fold_headers, rename_fields
from ..schema import RAW_HEADERS
from ..session import shared_dir
from ..sinks import files as sinks
from ..sources import archives, files, notices
from ..sources import registry as scans
from . import inputs
from .inputs import CTES, FIELD_NAMES, sql, table
from .registry import query

_RAW_FIELDS = ", ".join(FIELD_NAMES)


@query(
    "query_scan",
    """SELECT o_orderpriority AS priority, count(*) AS n FROM orders
      WHERE o_orderstatus = 'F' GROUP BY o_orderpriority""",
)
def query_scan(spark, sf_dir):
    table(spark, sf_dir, "orders").createOrReplaceTempView("noticeflow_orders")
    text = """SELECT o_orderpriority, count(*) FROM noticeflow_orders
      WHERE o_orderstatus = 'F' GROUP BY o_orderpriority"""
    return scans.query(spark, text, ["priority", "n"])


@query("csv_scan", sql(f"SELECT {_RAW_FIELDS} FROM raw", "raw"))
def csv_scan(spark, sf_dir):
    """Notices as CSV files of two header orders, one with a column more, read back as text."""
    folder = shared_dir(spark, "notices-csv")
    raw = inputs.raw_notices(spark, sf_dir).drop("source_file", "_seq")
    odd = F.col(f"`{RAW_HEADERS[0]}`").cast("long") % 2 == 1
    inputs.write_csv(raw.filter(odd), f"{folder}/a")
    other = raw.filter(~odd).withColumn("remark", F.lit("x"))
    inputs.write_csv(other.select("remark", *reversed(RAW_HEADERS)), f"{folder}/b")
    read = notices.read_notices(spark, [f"{folder}/a/*.csv", f"{folder}/b/*.csv"])
    return rename_fields(fold_headers(read)).select(*FIELD_NAMES)


def _zip_batches(batches):
    """One archive per batch: a notice member, and a member of another year."""
    for batch in batches:
        text = io.StringIO()
        writer = csv.writer(text, lineterminator="\n")
        writer.writerow(RAW_HEADERS)
        writer.writerows(batch[RAW_HEADERS].itertuples(index=False))
        packed = io.BytesIO()
        with zipfile.ZipFile(packed, "w", zipfile.ZIP_DEFLATED) as z:
            z.writestr("ExpedientesPublicados2001_1.csv", text.getvalue())
            z.writestr("ExpedientesPublicados2000.csv", text.getvalue())
        name = f"{batch[RAW_HEADERS[0]].iloc[0]}.zip"
        yield pd.DataFrame({"path": [name], "content": [packed.getvalue()]})


def _archives(spark, sf_dir):
    raw = inputs.raw_notices(spark, sf_dir).select(*RAW_HEADERS)
    return raw.mapInPandas(_zip_batches, "path string, content binary")


@query(
    "zip_scan",
    sql(f"SELECT {_RAW_FIELDS}, 'ExpedientesPublicados2001_1.csv' AS member FROM raw", "raw"),
)
def zip_scan(spark, sf_dir):
    read = archives.read_archives(_archives(spark, sf_dir), 2001)
    named = rename_fields(fold_headers(read))
    return named.select(*FIELD_NAMES, "member")


def _zip_documents(batches):
    """An archive per document, with its text as member of two years."""
    # A hundred at a time: a batch holds thousands of texts.
    for batch in (b.iloc[i : i + 100] for b in batches for i in range(0, len(b), 100)):
        packed = []
        for doc_id, text in zip(batch["doc_id"], batch["text"]):
            content = io.BytesIO()
            with zipfile.ZipFile(content, "w", zipfile.ZIP_DEFLATED) as z:
                z.writestr(f"ExpedientesPublicados2001_{doc_id}.csv", text)
                z.writestr(f"ExpedientesPublicados2002_{doc_id}.csv", text)
            packed.append(content.getvalue())
        names = [f"{i}.zip" for i in batch["doc_id"]]
        yield pd.DataFrame({"path": names, "content": packed})


@query(
    "zip_members",
    """SELECT doc_id || '.zip' AS archive, 'ExpedientesPublicados2001_' || doc_id || '.csv' AS member,
      strlen(text) AS bytes FROM documents""",
)
def zip_members(spark, sf_dir):
    """Names and lengths of the members of an archive per document."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    packed = documents.mapInPandas(_zip_documents, "path string, content binary")
    return archives.list_members(packed, 2001)


@query(
    "file_inventory",
    """SELECT month, strlen(list) + 1 AS length, (strlen(list) + 1) / 1048576.0::DOUBLE AS size_mb FROM (
      SELECT strftime(o_orderdate, '%Y%m') AS month,
        string_agg(o_orderkey || ';' || o_custkey, '|' ORDER BY o_orderkey) AS list
      FROM orders GROUP BY month) m""",
)
def file_inventory(spark, sf_dir):
    """Length and megabytes of the files written per month of orders, an order a line."""
    folder = shared_dir(spark, "inventory")
    entry = F.concat_ws(";", F.col("o_orderkey").cast("string"), F.col("o_custkey").cast("string"))
    month = F.date_format("o_orderdate", "yyyyMM")
    lines = table(spark, sf_dir, "orders").select(month.alias("month"), "o_orderkey", entry.alias("value"))
    dealt = lines.repartitionByRange("month", "o_orderkey").sortWithinPartitions("month", "o_orderkey")
    dealt.drop("o_orderkey").write.partitionBy("month").text(folder)
    listed = files.file_inventory(spark, folder, "*.txt")
    month = F.regexp_extract("path", r"month=(\d+)/", 1)
    total = listed.groupBy(month.alias("month")).agg(F.sum("length").alias("length"))
    return total.select("month", "length", megabytes(F.col("length")).alias("size_mb"))


CTES["log_events"] = """
  SELECT date_trunc('second', ts) AS ts, 'event_' || event_id AS name,
    event_type || ',' || props AS result FROM events"""


def _log_events(spark, sf_dir):
    return table(spark, sf_dir, "events").select(
        F.date_trunc("second", "ts").cast("timestamp_ntz").alias("ts"),
        F.concat(F.lit("event_"), F.col("event_id").cast("string")).alias("name"),
        F.concat_ws(",", "event_type", "props").alias("result"),
    )


@query(
    "event_log",
    sql("SELECT strftime(ts, '%Y%m%d %H:%M:%S') || ',' || name || ',' || result AS value FROM log_events", "log_events"),
)
def event_log(spark, sf_dir):
    """The lines as they stand in the log after an append."""
    folder = shared_dir(spark, "event-log")
    sinks.append_log(_log_events(spark, sf_dir), folder)
    return spark.read.text(folder)


@query("event_log_columns", sql("SELECT ts, name, result FROM log_events", "log_events"))
def event_log_columns(spark, sf_dir):
    folder = shared_dir(spark, "event-log")
    sinks.append_log(_log_events(spark, sf_dir), folder)
    return sinks.read_log(spark, folder)


@query(
    "document_archive",
    """SELECT CAST(year(ts) AS INTEGER) AS year, CAST(month(ts) AS INTEGER) AS month, count(*) AS files,
      CAST(sum(length(props)) AS BIGINT) AS bytes FROM events GROUP BY ALL""",
)
def document_archive(spark, sf_dir):
    """Contents stored by year and month, then counted from the archive."""
    root = shared_dir(spark, "documents")
    documents = table(spark, sf_dir, "events").select(
        F.concat(F.lit("event_"), F.col("event_id").cast("string")).alias("name"),
        F.col("props").cast("binary").alias("content"),
        F.date_format("ts", "yyyy").alias("year"),
        F.date_format("ts", "MM").alias("month"),
    )
    sinks.write_documents(documents, root)
    stored = spark.read.parquet(root)
    return stored.groupBy(
        F.col("year").cast("int").alias("year"), F.col("month").cast("int").alias("month")
    ).agg(
        F.count(F.lit(1)).alias("files"),
        F.sum(F.octet_length("content")).cast("bigint").alias("bytes"),
    )
