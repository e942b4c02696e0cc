"""Notice files inside zip archives."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator
from itertools import islice

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schema import ARCHIVE_MEMBER_PREFIX, RAW_HEADERS, SOURCE_FILE
from ..session import shared_dir
from .notices import read_by_header

# What a task holds of a member's lines before it hands them on.
BATCH_LINES, BATCH_CHARS = 20_000, 1 << 22


def load_archives(spark: SparkSession, path: str) -> DataFrame:
    """``path, content`` of the zip files below a path."""
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*.zip")
        .load(path)
        .select("path", "content")
    )


def _opened(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, zipfile.ZipFile]]:
    """Path and open archive of every row, one after the other, read where the batch holds it.

    Spark limits the bytes of a batch; nothing of it is copied but what is unpacked.
    """
    for batch in batches:
        paths, contents = batch.column("path"), batch.column("content")
        for i in range(batch.num_rows):
            with zipfile.ZipFile(pa.BufferReader(contents[i].as_buffer())) as z:
                yield paths[i].as_py(), z


def list_members(archives: DataFrame, year: str | int) -> DataFrame:
    """``archive, member, bytes`` of the members that hold a year's notices."""
    prefix = f"{ARCHIVE_MEMBER_PREFIX}{year}"

    def names(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = (
            (path, i.filename, i.file_size) for path, z in _opened(batches) for i in z.infolist() if i.filename.startswith(prefix)
        )
        while rows := list(islice(found, BATCH_LINES)):
            kinds = [pa.string(), pa.string(), pa.int64()]
            arrays = [pa.array(c, k) for c, k in zip(zip(*rows), kinds)]
            yield pa.RecordBatch.from_arrays(arrays, names=["archive", "member", "bytes"])

    return archives.select("path", "content").mapInArrow(
        names, "archive string, member string, bytes long"
    )


def unpack_members(archives: DataFrame, year: str | int) -> DataFrame:
    """``archive, member, value``: the lines of the members, in order within each.

    One archive is one task, as zip cannot be split; members are unpacked as streams.
    """
    prefix = f"{ARCHIVE_MEMBER_PREFIX}{year}"

    def lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for path, z in _opened(batches):
            for member in z.namelist():
                if member.startswith(prefix):
                    with z.open(member) as raw:
                        yield from _portions(raw, path, member)

    return archives.select("path", "content").mapInArrow(
        lines, "archive string, member string, value string"
    )


def _portions(raw, archive: str, member: str) -> Iterator[pa.RecordBatch]:
    text, held, size = io.TextIOWrapper(raw, encoding="utf-8-sig", newline="\n"), [], 0

    def batch() -> pa.RecordBatch:
        n = len(held)
        columns = [[archive] * n, [member] * n, held]
        arrays = [pa.array(c, pa.string()) for c in columns]
        return pa.RecordBatch.from_arrays(arrays, names=["archive", "member", "value"])

    for line in text:
        held.append(line.rstrip("\r\n"))
        size += len(line)
        if len(held) == BATCH_LINES or size >= BATCH_CHARS:
            yield batch()
            held.clear()
            size = 0
    if held:
        yield batch()


def read_archives(
    archives: DataFrame, year: str | int, headers: list[str] | None = None
) -> DataFrame:
    """Notices of all members whose name starts with the year's prefix.

    Python only unpacks. The lines are written to the shared folder, a file per member,
    and read from there as other notice files are: by header, by the CSV reader. The
    source file is ``archive/member``, so equal members of two archives stay apart.
    An empty cell is NULL.
    """
    spark = archives.sparkSession
    folder = shared_dir(spark, "members")
    unpacked = unpack_members(archives, year)
    unpacked.write.partitionBy("archive", "member").text(folder)
    schema = T.StructType([T.StructField(h, T.StringType()) for h in headers or RAW_HEADERS])
    parts = ["archive", "member"]
    if unpacked_nothing(spark, folder):
        read = read_by_header(spark, [], schema, folder, parts)
    else:
        read = read_by_header(spark, [f"{folder}/archive=*/member=*"], schema, folder, parts)
    archive = F.regexp_extract("archive", r"[^/]*$", 0)
    return read.withColumn(SOURCE_FILE, F.concat_ws("/", archive, "member"))


def unpacked_nothing(spark: SparkSession, folder: str) -> bool:
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/archive=*/member=*")
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path)
    return found is None or len(found) == 0
