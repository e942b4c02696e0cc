"""Event log, report and document archive."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import log_stamp


def log_line(ts: Column, name: Column, result: Column) -> Column:
    """``YYYYMMDD HH:MM:SS,name,result``; a missing part stays empty."""
    blank = F.lit("")
    return F.concat_ws(
        ",", log_stamp(ts), F.coalesce(name, blank), F.coalesce(result, blank)
    )


def append_log(events: DataFrame, path: str) -> None:
    """Append ``ts, name, result`` rows as text lines."""
    line = log_line(F.col("ts"), F.col("name"), F.col("result"))
    events.select(line.alias("value")).write.mode("append").text(path)


def read_log(spark, path: str) -> DataFrame:
    """The log as columns; the result may itself hold commas."""
    part = r"^([^,]*),([^,]*),(.*)$"
    line = F.col("value")
    stamp = F.regexp_replace(
        F.regexp_extract(line, part, 1), r"^(\d{4})(\d\d)(\d\d) (.*)$", "$1-$2-$3 $4"
    )
    return spark.read.text(path).select(
        stamp.try_cast("timestamp_ntz").alias("ts"),
        F.regexp_extract(line, part, 2).alias("name"),
        F.regexp_extract(line, part, 3).alias("result"),
    )


def write_report(wide: DataFrame, path: str) -> None:
    """The wide report, a few rows, as CSV with a header."""
    wide.coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def write_documents(documents: DataFrame, root: str) -> None:
    """Store ``name, content`` rows below ``root/year=…/month=…``."""
    documents.write.mode("append").partitionBy("year", "month").parquet(root)
