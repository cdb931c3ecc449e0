"""Which data files of a table hold rows of which landed file.

The index is a small table in the hidden folder ``_files`` of the table it belongs to, in buckets by a hash of the landed file. It is brought
up to date when it is asked: data files that it lacks are read, one column of them, and noted. So each data file is read
for it once, however many files are deleted or loaded again later.
"""

from __future__ import annotations

from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside import SNAPSHOT, SOURCE_NAME
from quayside.session import checkpoint, small_table
from quayside.sinks import storage
from quayside.sources.frames import Files
from quayside.sources.manifest import list_files

SCHEMA = "landed string, file string, bucket int"
BUCKETS = 16


def landed_key(path: Column) -> Column:
    """The part of a landed file's path that tells it from others: from its last snapshot folder on, null without one."""
    return F.nullif(F.regexp_extract(path, f".*({SNAPSHOT}.*)$", 1), F.lit(""))


def _bucket(landed: Column) -> Column:
    return F.pmod(F.xxhash64(landed), F.lit(BUCKETS)).cast("int").alias("bucket")


def _index(spark: SparkSession, root: str, buckets: Sequence[int] | None = None) -> DataFrame:
    table = f"{root}/_files"
    folders = [table] if buckets is None else [f"{table}/bucket={b}" for b in buckets]
    folders = [f for f in folders if storage.exists(spark, f)]
    if not folders:
        return spark.createDataFrame([], SCHEMA)
    return spark.read.schema(SCHEMA).option("basePath", table).parquet(*folders)


def bring_up_to_date(spark: SparkSession, root: str) -> int:
    """Note the data files below ``root`` that the index lacks; returns how many. A data file without landed rows is noted too."""
    listed = list_files(spark, Files.literal([root], "*.parquet")).select(F.col(SOURCE_NAME).alias("file"))
    fresh = [r[0] for r in listed.join(_index(spark, root).select("file"), "file", "left_anti").toLocalIterator()]
    if not fresh:
        return 0
    rows = storage.read_table_files(spark, root, Files.named(fresh).paths)
    if SOURCE_NAME not in rows.columns:
        return 0
    found = rows.select(landed_key(F.col(SOURCE_NAME)).alias("landed"), F.col("_metadata.file_path").alias("file")).distinct()
    # files without rows as well, so that they are not read again
    noted = small_table(spark, [(f,) for f in fresh], "file string").join(found, "file", "left")
    noted = noted.select("landed", "file", _bucket(F.coalesce("landed", F.lit(""))))
    noted.repartition("bucket").write.mode("append").partitionBy("bucket").parquet(f"{root}/_files")
    return len(fresh)


def data_files(spark: SparkSession, root: str, landed: Sequence[str]) -> list[str]:
    """The data files below ``root`` that hold rows of the landed files, given by their keys. Only their buckets are read."""
    bring_up_to_date(spark, root)
    asked = small_table(spark, [(k,) for k in landed], "landed string")
    asked = checkpoint(asked.select("landed", _bucket(F.col("landed"))).distinct())
    buckets = [r[0] for r in asked.select("bucket").distinct().collect()]
    found = _index(spark, root, buckets).join(F.broadcast(asked), ["bucket", "landed"]).select("file").distinct()
    files = sorted(unquote(r["file"]) for r in found.toLocalIterator())
    # files that were rewritten since are gone
    return [f for f in files if storage.exists(spark, f)]
