"""Incremental runs over arriving files, by Structured Streaming."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ..plans.incremental import run_incremental
from ..schema import FILE_ORDER, KEYS, ROW_SEQ, SOURCE_FILE
from ..session import step_folders
from ..sinks.snapshots import SnapshotTable
from ..sources.notices import by_header
from ..sources.records import assembled


@dataclass
class NoticeLines:
    """CSV files as a stream of their lines, from splits of the files; each batch becomes rows."""

    lines: DataFrame
    schema: StructType

    def rows(self, batch: DataFrame) -> DataFrame:
        """The notices of a batch of lines; a header other than the schema's is an error."""
        found, files = assembled(batch.withColumn("at", F.monotonically_increasing_id()), [FILE_ORDER])
        return by_header(found, files, self.schema, [FILE_ORDER], strict=True)


def ingest_batch(
    batch: DataFrame,
    batch_id: int,
    registry: SnapshotTable,
    dim: DataFrame,
    as_of: datetime | str,
    n_days: int,
    reports: str,
    run_ts: datetime | str | None = None,
) -> None:
    """Run one micro-batch against the registry and commit the next version.

    The version follows from the batch id and the state read is the one before
    it, so a batch that is run again gives the same registry; of a registry that is indexed by
    id only the buckets that can hold keys of the batch are read. Below ``reports`` go the
    counts, and every row that does not reach the registry: ``rejects``, with the reason,
    and ``conflicts``.
    """
    if ROW_SEQ not in batch.columns:
        batch = batch.withColumn(ROW_SEQ, F.monotonically_increasing_id())
    before = registry.version(below=batch_id + 1)
    run = run_incremental(
        batch, lambda rows: registry.read_for(rows, KEYS, before), dim, as_of, n_days, run_ts
    )
    for name in ("counts", "rejects", "conflicts"):
        getattr(run, name).write.mode("overwrite").parquet(f"{reports}/{name}/batch={batch_id}")
    registry.merge(run.changed, run.update, run.inserts, version=batch_id + 1)


def start_ingest(
    notices: DataFrame | NoticeLines,
    registry: SnapshotTable,
    dim: DataFrame,
    as_of: datetime | str,
    n_days: int,
    checkpoint: str,
    reports: str,
    run_ts: datetime | str | None = None,
) -> StreamingQuery:
    """Process what has arrived, many files a batch and in their order, then stop.

    ``registry`` needs a fixed writer name, so that a restarted stream may repeat its own
    last version.
    """
    by_line = isinstance(notices, NoticeLines)

    def step(batch: DataFrame, batch_id: int) -> None:
        with step_folders(batch.sparkSession):
            batch = notices.rows(batch) if by_line else batch
            ingest_batch(batch, batch_id, registry, dim, as_of, n_days, reports, run_ts)

    return (
        (notices.lines if by_line else notices).writeStream.foreachBatch(step)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def stream_notices(
    spark: SparkSession, path: str, schema, fmt: str = "csv", files_per_batch: int = 1000
) -> DataFrame | NoticeLines:
    """Notice files as a stream, with their file's name and place in the order of files.

    Files are in the order of their change times, then paths. Those of one micro-batch count one
    after the other (``operators/file_order.py``), so the number of files a batch changes
    no result. CSV files are split between tasks, whatever their quotes hold, and their rows
    numbered (``sources/records.py``); other formats come as their reader splits them.
    A file whose header does not fit the schema stops the stream; rows that do not fit
    the header are marked and end as rejects.
    """
    by_line = fmt == "csv"
    if by_line:
        reader = spark.readStream.format("text").option("lineSep", "\n")
    else:
        reader = spark.readStream.format(fmt).schema(schema)
    loaded = reader.option("maxFilesPerTrigger", files_per_batch).load(path)
    changed = F.unix_micros("_metadata.file_modification_time").cast("string")
    order = F.concat_ws(" ", F.lpad(changed, 20, "0"), "_metadata.file_path")
    if not by_line:
        return loaded.withColumns({SOURCE_FILE: F.col("_metadata.file_name"), FILE_ORDER: order})
    lines = loaded.select(
        F.xxhash64("_metadata.file_path").alias("file"),
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("block"),
        "value",
        order.alias(FILE_ORDER),
    )
    return NoticeLines(lines, schema)
