"""CSV records of files of any size, quoted line breaks included, from splits of the files.

Spark's text reader splits a file between lines. Whether a line of a split begins within quotes
depends on the number of quotes before it, so the files are read in two passes:

1. every split is counted: its quotes, and the first line where the split begins its file;
2. prefix sums of the counts over the splits of a file tell how each split begins. Tasks then
   put lines together to records as they read them, in order and without a shuffle.

What a record spans of several splits comes out as fragments, at most two per split, which are
put together afterwards. A split's table has a row of a few numbers per split and is broadcast
after its size is checked; larger ones go through a shuffle by split.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.skew import write_once

_SPLIT = ["file", "block"]
# Whole records, the rest of a record begun before, a record that goes on behind.
WHOLE, REST, BEGUN = 0, 1, 2
_FOUND = "file long, block long, seq long, kind int, record string"


def lines(spark: SparkSession, paths: str | list[str], base: str | None = None, parts: list[str] = ()) -> DataFrame:
    """(file, path, block, at, value): the lines of every split, their ends kept but for the line feed.

    ``parts`` names folder columns below ``base``, which are kept as well.
    """
    reader = spark.read.option("lineSep", "\n")
    if base:
        reader = reader.option("basePath", base)
    return reader.text(paths).select(
        F.xxhash64("_metadata.file_path").alias("file"),
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("at"),
        "value",
        *parts,
    )


def splits(read: DataFrame, parts: list[str] = ()) -> DataFrame:
    """(file, block, path, parts, quotes, first): one row per split; first is NULL but where a file begins."""
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"')))
    first = F.when(F.col("block") == 0, F.min_by("value", "at")).alias("first")
    return read.groupBy(*_SPLIT, "path", *parts).agg(F.sum(quotes).alias("quotes"), first)


def _assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Records of the lines of each split, which knows whether it begins within quotes."""
    key, held, inside, whole, seq, begin = None, [], False, True, 0, 0

    def row(kind: int, record: str) -> tuple:
        return (*key, begin, kind, record)

    def rows(found: list[tuple]) -> pa.RecordBatch:
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.string()]
        columns = [pa.array([f[i] for f in found], k) for i, k in enumerate(kinds)]
        return pa.RecordBatch.from_arrays(columns, names=["file", "block", "seq", "kind", "record"])

    for batch in batches:
        if not batch.num_rows:
            continue
        keys = np.stack([batch.column(c).to_numpy() for c in _SPLIT])
        odd = pc.count_substring(batch.column("value"), '"').to_numpy() % 2 == 1
        edges = np.flatnonzero(np.concatenate([[True], (keys[:, 1:] != keys[:, :-1]).any(axis=0), [True]]))
        for start, stop in zip(edges[:-1].tolist(), edges[1:].tolist()):
            found = []
            own = (int(keys[0, start]), int(keys[1, start]))
            if own != key:
                if held:
                    found.append(row(BEGUN if whole else REST, "\n".join(held)))
                key, held, seq, begin = own, [], 0, 0
                inside = batch.column("inside")[start].as_py()
                whole = not inside
            part = batch.column("value").slice(start, stop - start)
            if not held and not inside and not odd[start:stop].any():
                # No line of these is more than a record.
                n = stop - start
                yield pa.RecordBatch.from_arrays(
                    [
                        *(pa.array(np.full(n, k)) for k in key),
                        pa.array(np.arange(seq, seq + n)),
                        pa.array(np.zeros(n, np.int32)),
                        part,
                    ],
                    names=["file", "block", "seq", "kind", "record"],
                )
                seq += n
                continue
            for line, turns in zip(part.to_pylist(), odd[start:stop].tolist()):
                if not held:
                    begin = seq
                held.append(line)
                seq += 1
                inside ^= turns
                if not inside:
                    found.append(row(WHOLE if whole else REST, "\n".join(held)))
                    held, whole = [], True
            yield rows(found)
    if held:
        yield rows([row(BEGUN if whole else REST, "\n".join(held))])


def records(read: DataFrame, begun: DataFrame) -> DataFrame:
    """(file, seq, record, whole) of all records; ``seq`` sorts those of a file.

    ``begun`` has (file, block, inside) for every split. ``whole`` is false for a file's last
    record if its quotes never close.
    """
    small = write_once(begun, "splits")
    if small.is_small:
        dealt = read.join(F.broadcast(small.frame), _SPLIT)
    else:
        dealt = read.join(small.frame, _SPLIT).sortWithinPartitions(*_SPLIT, "at")
    found = dealt.select(*_SPLIT, "value", "inside").mapInArrow(_assemble, _FOUND)
    # A split is longer than its number of lines, so these numbers rise within a file.
    found = found.withColumn("seq", F.col("block") + F.col("seq"))
    whole = found.filter(F.col("kind") == WHOLE).select("file", "seq", "record", F.lit(True).alias("whole"))
    torn = write_once(found.filter(F.col("kind") != WHOLE), "fragments").frame
    order = Window.partitionBy("file").orderBy("seq", F.col("kind") == BEGUN)
    numbered = torn.withColumn("nth", F.sum((F.col("kind") == BEGUN).cast("int")).over(order))
    pieces = F.array_sort(F.collect_list(F.struct("seq", "kind", "record")))
    joined = numbered.groupBy("file", "nth").agg(F.min("seq").alias("seq"), pieces.alias("p")).select(
        "file",
        "seq",
        F.array_join(F.transform("p", lambda p: p["record"]), "\n").alias("record"),
    )
    quotes = F.length("record") - F.length(F.replace("record", F.lit('"')))
    return whole.union(joined.withColumn("whole", quotes % 2 == 0))


def read_records(
    spark: SparkSession, paths: str | list[str], base: str | None = None, parts: list[str] = ()
) -> tuple[DataFrame, DataFrame]:
    """The records of files, and (file, path, parts, first) with the first line of each."""
    return assembled(lines(spark, paths, base, parts), parts)


def assembled(read: DataFrame, parts: list[str] = ()) -> tuple[DataFrame, DataFrame]:
    """The same for lines, which are read twice; ``parts`` names more columns that are one to a file."""
    counted = write_once(splits(read, parts), "counted").frame
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    begun = counted.select(*_SPLIT, (F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2 == 1).alias("inside"))
    files = counted.filter("block = 0").select("file", "path", *parts, "first")
    return records(read, begun), files
