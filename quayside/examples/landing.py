"""Writing tables out as landed files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.session import scratch_path

STAMP = "2024_01_01_00_00_00"
MIN_FILES = 8


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def file_count(df: DataFrame, key: str, rows_per_file: int = 1_000_000) -> int:
    """Files to write for a dense integer key: at least eight, and growing with the table."""
    return max(MIN_FILES, (df.agg(F.max(key)).first()[0] or 0) // rows_per_file)


def files_sql(name: str, key: str, rows_per_file: int = 1_000_000) -> str:
    """The same number in SQL."""
    return f"(select greatest({MIN_FILES}, max({key}) // {rows_per_file}) from {name})"


def shard(key: str, files: int) -> Column:
    return F.pmod(F.col(key), F.lit(files)).cast("int").alias("shard")


def placed(rows: DataFrame, files: int, order: list[str]) -> DataFrame:
    """Bring each shard's rows into a task of its own, in order."""
    return rows.repartitionById(files, F.coalesce("shard", F.lit(0))).sortWithinPartitions("shard", *order)


def land_lines(lines: DataFrame, files: int, label: str, order: list[str], stamp: str = STAMP) -> str:
    """Write ``value`` lines, one text file per shard; returns the folder."""
    folder = f"{scratch_path(lines.sparkSession, label)}/snapshot_date={stamp}"
    placed(lines, files, order).select("shard", "value").write.partitionBy("shard").text(folder)
    return folder
