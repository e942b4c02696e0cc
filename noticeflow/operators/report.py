"""Run reports: counts per stage, bucket contents, wide form, backlog."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schema import FILE_BUCKETS, SOURCE_FILE, STAGE_COUNTS
from .keys import DOCUMENT, EXISTING, LABEL, NEW, CONFLICT, WITH, WITHOUT


def _count_if(condition: Column, name: str) -> Column:
    return F.count_if(F.coalesce(condition, F.lit(False))).alias(name)


def stage_counts(classified: DataFrame, by: str = SOURCE_FILE) -> DataFrame:
    """Rows per stage and source file, in one pass over a classified batch."""
    label, document = F.col(LABEL), F.col(DOCUMENT)
    return classified.groupBy(by).agg(
        F.count(F.lit(1)).alias("filtered"),
        _count_if(label == NEW, "new"),
        _count_if(label == EXISTING, "existing"),
        _count_if(label == CONFLICT, "conflict"),
        _count_if(document == WITHOUT, "without_document"),
        _count_if(document == WITH, "with_document"),
    )


def bucket_items(entries: DataFrame, by: str = SOURCE_FILE) -> DataFrame:
    """Contents of every bucket: one row per name, with the times it was added.

    A list per bucket would put a whole run into one cell; rows hold the same.
    """
    return entries.groupBy(by, "bucket", "name").agg(F.count(F.lit(1)).alias("times"))


def bucket_counts(entries: DataFrame, by: str = SOURCE_FILE) -> DataFrame:
    """Length of every bucket, buckets nothing went into included."""
    lengths = entries.groupBy(by).agg(
        *[_count_if(F.col("bucket") == bucket, bucket) for bucket in FILE_BUCKETS]
    )
    return long_report(lengths, by).withColumnsRenamed({"metric": "bucket", "value": "n"})


def stage_buckets(counts: DataFrame, by: str = SOURCE_FILE) -> DataFrame:
    """The stage buckets of each file, as rows ``(file, bucket, n)``, from a run's counts."""
    values = [
        (F.col(column) if column else F.lit(0)).cast("long").alias(bucket)
        for bucket, column in STAGE_COUNTS.items()
    ]
    lengths = counts.select(by, *values)
    return long_report(lengths, by).withColumnsRenamed({"metric": "bucket", "value": "n"})


def filtered_addresses(classified: DataFrame, by: str = SOURCE_FILE) -> DataFrame:
    """Addresses of the notices in the window, as contents of their bucket."""
    entries = classified.select(by, F.lit("actas_filtradas").alias("bucket"), F.col("URLAnuncio").alias("name"))
    return bucket_items(entries, by)


def run_report(counts: DataFrame, entries: DataFrame, by: str = SOURCE_FILE) -> DataFrame:
    """All buckets of a run, rows ``(file, bucket, n)``: its stages and its files' outcomes."""
    return stage_buckets(counts, by).unionByName(bucket_counts(entries, by))


def long_report(counts: DataFrame, by: str = SOURCE_FILE) -> DataFrame:
    """Count columns as rows ``(file, metric, value)``."""
    metrics = [c for c in counts.columns if c != by]
    return counts.unpivot(by, [F.col(m) for m in metrics], "metric", "value")


def wide_report(report: DataFrame, by: str = SOURCE_FILE) -> DataFrame:
    """One row per metric and one column per source file, all files of the report.

    A wide report has as many columns as files, so it is for runs of up to some
    thousands of them (``spark.sql.pivotMaxValues``); beyond that Spark refuses and the
    long report serves.
    """
    return report.groupBy("metric").pivot(by).agg(F.first("value"))


def backlog(registry: DataFrame) -> DataFrame:
    """Pending uploads, pending downloads and their sum, in one pass."""
    upload = (F.col("ActaPublicada") == 1) & (F.col("UrlActaDL") == "")
    download = (F.col("ActaPublicada") == 0) & (F.col("Url_visitada") == 0)
    counts = registry.agg(
        _count_if(upload, "pending_upload"), _count_if(download, "pending_download")
    )
    total = F.col("pending_upload") + F.col("pending_download")
    return counts.withColumn("backlog", total)
