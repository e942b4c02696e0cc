"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Runtime settings a long job wants. All are ordinary Spark options.
CLUSTER_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.filterPushdown": "true",
}


def local_session(cpus: int | str = "*", partitions: int = 8, app: str = "noticeflow"):
    """A single-machine session for tests and the benchmark."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    for key, value in CLUSTER_CONF.items():
        builder = builder.config(key, value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    return session


def shared_base(spark: SparkSession) -> str:
    """The folder that driver and executors share.

    That is ``spark.checkpoint.dir``, else the folder given to
    ``SparkContext.setCheckpointDir``. Only a session on one machine may do without
    and gets a temporary folder; on a cluster that would be a folder per machine.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = spark.sparkContext.getCheckpointDir()
    if not base:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise ValueError(f"set spark.checkpoint.dir to a shared folder; master is {master}")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="noticeflow-"))
        base = spark.sparkContext.getCheckpointDir()
    return base.rstrip("/")


_steps = threading.local()


@contextmanager
def step_folders(spark: SparkSession) -> Iterator[None]:
    """Remove the shared folders made within, by this thread, at the end.

    For whole runs: DataFrames that read such folders cannot be used afterwards.
    """
    outer, _steps.made = getattr(_steps, "made", None), []
    try:
        yield
    finally:
        made, _steps.made = _steps.made, outer
        for folder in made:
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def shared_dir(spark: SparkSession, name: str) -> str:
    """The path of a fresh folder below the shared one."""
    folder = f"{shared_base(spark)}/{name}-{uuid.uuid4().hex}"
    if getattr(_steps, "made", None) is not None:
        _steps.made.append(folder)
    return folder


_FREE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def written(df: DataFrame, name: str = "step") -> DataFrame:
    """Write a DataFrame to the shared folder and read it back.

    Lineage ends there: plans that follow start from files every executor can read,
    and what a lost executor held is computed from them. The shuffle files of the write
    serve nothing after it and are given back when it ends.
    """
    spark = df.sparkSession
    folder = shared_dir(spark, name)
    before = spark.conf.get(_FREE, "false")
    spark.conf.set(_FREE, "true")
    try:
        df.write.parquet(folder)
    finally:
        spark.conf.set(_FREE, before)
    return spark.read.schema(df.schema).parquet(folder)
