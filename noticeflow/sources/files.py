"""File inventory: names and sizes, never contents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.nested import megabytes


def file_inventory(spark: SparkSession, root: str, pattern: str = "*") -> DataFrame:
    """``path, modificationTime, length, size_mb`` of all files below a folder."""
    frame = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", pattern)
        .load(root)
    )
    listed = frame.select("path", "modificationTime", "length")
    return listed.withColumn("size_mb", megabytes(F.col("length")))
