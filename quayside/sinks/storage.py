"""Folder-level work on the table storage: listing partitions, dropping, rewriting files."""

from __future__ import annotations

from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside import SNAPSHOT, SOURCE_NAME
from quayside.sources.frames import Files


def _open(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def exists(spark: SparkSession, path: str) -> bool:
    fs, where = _open(spark, path)
    return fs.exists(where)


def is_folder(spark: SparkSession, path: str) -> bool:
    fs, where = _open(spark, path)
    return fs.getFileStatus(where).isDirectory()


def qualified(spark: SparkSession, path: str) -> str:
    fs, where = _open(spark, path)
    return fs.makeQualified(where).toString()


def remove(spark: SparkSession, path: str) -> None:
    fs, where = _open(spark, path)
    if not fs.delete(where, True) and fs.exists(where):
        raise OSError(f"could not delete {path}")


def make_folder(spark: SparkSession, path: str) -> None:
    fs, where = _open(spark, path)
    fs.mkdirs(where)


def move(spark: SparkSession, path: str, to: str) -> None:
    """Rename a folder or file; the folder that it goes to is made."""
    fs, where = _open(spark, path)
    _, target = _open(spark, to)
    fs.mkdirs(target.getParent())
    if not fs.rename(where, target):
        raise OSError(f"could not move {path} to {to}")


def leaf_folders(spark: SparkSession, root: str, depth: int) -> list[str]:
    """The folders so many ``key=value`` levels below ``root``, by their path from there."""
    found = [""]
    for _ in range(depth):
        found = [f"{f}/{n}" for f in found for n in child_names(spark, root + f) if "=" in n]
    return [f.removeprefix("/") for f in found]


def child_names(spark: SparkSession, path: str) -> list[str]:
    fs, where = _open(spark, path)
    if not fs.exists(where):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(where))


def partition_values(spark: SparkSession, root: str, key: str = SNAPSHOT) -> list[str]:
    """Values of the first-level ``key=value`` folders that hold something."""
    prefix = key + "="
    names = [n for n in child_names(spark, root) if n.startswith(prefix)]
    return [n[len(prefix):] for n in names if _holds_data(spark, f"{root}/{n}")]


def _holds_data(spark: SparkSession, folder: str) -> bool:
    return any(not n.startswith(("_", ".")) for n in child_names(spark, folder))


def read_table_files(spark: SparkSession, root: str, files: Sequence[str] | None = None) -> DataFrame:
    """Parquet files below ``root`` with merged schemas and folder columns as text."""
    reader = spark.read.option("basePath", root)
    paths = list(files) if files else [root]
    found = reader.option("mergeSchema", "true").parquet(*paths)
    in_folders = {n.split("=")[0] for f in found.inputFiles()[:1] for n in f.split("/") if "=" in n}
    schema = T.StructType(
        [T.StructField(f.name, T.StringType() if f.name in in_folders else f.dataType) for f in found.schema]
    )
    return reader.schema(schema).parquet(*paths)


def delete_rows(
    spark: SparkSession, root: str, doomed: Column, partition_by: Sequence[str], scope: str | None = None, among: Sequence[str] | None = None
) -> int:
    """Rewrite just the data files that hold a doomed row; returns how many.

    ``scope`` is a partition folder to look in, ``among`` names the data files to look in. Kept rows are appended before the
    old files go, so a crash in between leaves rows twice rather than not at all.
    """
    where = scope or root
    if not exists(spark, where) or (among is not None and not among):
        return 0
    table = read_table_files(spark, root, [where] if among is None else Files.literal(among).paths)
    hit = table.where(doomed).select(F.col("_metadata.file_path").alias("file")).distinct()
    files = [unquote(r["file"]) for r in hit.toLocalIterator()]
    if not files:
        return 0
    kept = read_table_files(spark, root, Files.literal(files).paths).where(F.coalesce(~doomed, F.lit(True)))
    kept.write.mode("append").partitionBy(*partition_by).parquet(root)
    for file in files:
        remove(spark, file)
    if scope and not _holds_data(spark, scope):
        remove(spark, scope)
    spark.catalog.refreshByPath(root)
    return len(files)


def landed_suffixes(files: Sequence[str]) -> list[str]:
    """The paths of landed files from their snapshot folder on."""
    for file in files:
        if SNAPSHOT not in file:
            raise ValueError(f"cannot delete by file: no {SNAPSHOT} folder in {file!r}")
    return [file[file.find(SNAPSHOT):] for file in files]


def rows_of_files(files: Sequence[str]) -> Column:
    """Rows that came from any of the landed files, told by their paths from the snapshot folder on."""
    suffixes = landed_suffixes(files)
    source = F.col(SOURCE_NAME)
    last = F.regexp_extract(source, f".*({SNAPSHOT}.*)$", 1)
    one_of = last.isin(sorted({s[s.rfind(SNAPSHOT):] for s in suffixes}))
    if all(s.rfind(SNAPSHOT) == 0 for s in suffixes):
        return one_of
    ends = F.array(*map(F.lit, suffixes))
    return one_of & F.exists(ends, lambda s: F.endswith(source, s))
