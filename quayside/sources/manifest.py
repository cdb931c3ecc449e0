"""The list of landed files, as a frame."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside import SOURCE_NAME
from quayside.session import small_table
from quayside.sources.frames import Files

SCHEMA = f"{SOURCE_NAME} string, size bigint, modified timestamp"


def _is_data(path):
    return ~(F.endswith(path, F.lit(".crc")) | F.endswith(path, F.lit("_SUCCESS")))


def list_files(spark: SparkSession, files: Files) -> DataFrame:
    """Path, size and time of every file, without reading any content. Files of no length hold no rows and are left out."""
    listed = files.load(spark, "binaryFile").select(
        F.col("_metadata.file_path").alias(SOURCE_NAME),
        F.col("_metadata.file_size").alias("size"),
        F.col("_metadata.file_modification_time").alias("modified"),
    )
    return listed.where(_is_data(F.col(SOURCE_NAME)))


def empty_files(spark: SparkSession, files: Files, listed: DataFrame) -> DataFrame:
    """Files of no length: those that the scan knows and does not list. Their names stay in the JVM."""
    scan = files.load(spark, "binaryFile")
    names = spark._jvm.scala.collection.immutable.ArraySeq.unsafeWrapArray(scan._jdf.inputFiles())
    strings = spark._jsparkSession.createDataset(names, spark._jvm.org.apache.spark.sql.Encoders.STRING()).toDF()
    # a local file has three slashes here and one in the scan's metadata
    name = F.regexp_replace("value", "^file:/+", "file:/").alias(SOURCE_NAME)
    known = DataFrame(strings, spark).toDF("value").select(name).where(_is_data(F.col(SOURCE_NAME)))
    return known.join(listed.select(SOURCE_NAME), SOURCE_NAME, "left_anti").select(
        SOURCE_NAME, F.lit(0).cast("bigint").alias("size"), F.lit(None).cast("timestamp").alias("modified")
    )


def hidden_files(spark: SparkSession, parents: Sequence[str]) -> DataFrame:
    """Files that no scan reads, as a name in their path begins with ``_`` or ``.``; the file system picks them out by pattern, one level of folders after another."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    conf = spark._jsc.hadoopConfiguration()
    found: dict[str, tuple] = {}

    def note(status) -> None:
        uri = re.sub("^file:/+", "file:/", status.getPath().toUri().toString())
        found[uri] = (uri, status.getLen())

    for parent, pattern in zip(parents, Files.literal(parents).paths):
        place = hadoop.Path(parent)
        fs = place.getFileSystem(conf)
        if not fs.getFileStatus(place).isDirectory():
            if place.getName()[0] in "_.":
                note(fs.getFileStatus(place))
            continue
        while True:
            for status in fs.globStatus(hadoop.Path(f"{pattern}/{{_,.}}*")) or ():
                if status.isDirectory():
                    inside = fs.listFiles(status.getPath(), True)
                    while inside.hasNext():
                        note(inside.next())
                else:
                    note(status)
            below = fs.globStatus(hadoop.Path(f"{pattern}/*"))
            if below is None or len(below) == 0:
                break
            pattern += "/*"
    rows = small_table(spark, list(found.values()), f"{SOURCE_NAME} string, size bigint")
    return rows.withColumn("modified", F.lit(None).cast("timestamp")).where(_is_data(F.col(SOURCE_NAME)))
