"""Session settings and the shared folder used for checkpoints and scratch."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

_local_scratch: tempfile.TemporaryDirectory | None = None


def local_session(cores: str | int = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A single-machine session for tests and the benchmark."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("quayside")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )


def small_table(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """A few rows the driver knows. Through Arrow they become a local relation, which needs no job."""
    kind = T.StructType.fromDDL(schema)
    if not rows:
        return spark.createDataFrame([], kind)
    columns = {name: [row[n] for row in rows] for n, name in enumerate(kind.names)}
    return spark.createDataFrame(pa.table(columns), kind)


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it.

    ``spark.checkpoint.dir`` decides. Only a local session that leaves it unset
    gets a temporary folder of its own, removed when Python ends.
    """
    global _local_scratch
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    if _local_scratch is None:
        _local_scratch = tempfile.TemporaryDirectory(prefix="quayside-")
    return _local_scratch.name


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh, not yet existing folder below the shared folder."""
    return f"{shared_dir(spark)}/quayside-{label}-{uuid.uuid4().hex}"


def checkpoint(df: DataFrame) -> DataFrame:
    """Materialise ``df`` on reliable storage, so a lost executor costs nothing."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_dir(spark))
    return df.checkpoint(eager=True)


#: Files that a task may hold open in a partitioned write.
OPEN_FILES = 8


@contextmanager
def open_writers(spark: SparkSession) -> Iterator[None]:
    """Partitioned writes inside keep a file open for each of a task's first folders, and sort only rows for further ones.

    Without that Spark sorts all rows of a task by folder first, in memory that grows with them.
    """
    setting = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(setting)
    spark.conf.set(setting, str(max(int(before), OPEN_FILES)))
    try:
        yield
    finally:
        spark.conf.set(setting, before)


@contextmanager
def spent_shuffles(spark: SparkSession) -> Iterator[None]:
    """What runs inside deletes its shuffle files when it ends, and not only when the driver collects its garbage.

    For plans that no later one shares an exchange with: those written to the shared folder, which is read from there on.
    """
    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "true")
    try:
        yield
    finally:
        spark.conf.set(setting, before)
