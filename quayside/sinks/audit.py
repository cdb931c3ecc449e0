"""The append-only table of what happened to each landed file.

It lies in folders by a hash of the ingest id and by the day of the run, so that what is known of a few loads is found in the
folders of their ids, however long the table has grown.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.functions.paths import snapshot_or_null
from quayside.sinks import storage
from quayside.sinks.targets import WriteInfo

# fixed values: the three states of a file
STARTED, SUCCESS, FAILED = "STARTED", "SUCCESS", "FAILED"
#: A file that was found and is not loaded; its error says why.
SKIPPED = "SKIPPED"


def audit_rows(
    files: DataFrame,
    status: str,
    configuration: str | Column,
    at: datetime,
    written: Sequence[WriteInfo] = (),
    error: str | Column | None = None,
) -> DataFrame:
    """One row per file. ``files`` has ``path``, ``ingest_id`` and ``correlation_id``."""
    details = [
        F.struct(
            F.lit(w.path).alias("ingested_path"),
            F.create_map(*[F.lit(t) for pair in w.details.items() for t in pair])
            .cast("map<string,string>")
            .alias("details"),
        )
        for w in written
    ]
    kind = "array<struct<ingested_path:string,details:map<string,string>>>"
    stamp = snapshot_or_null(F.col("path")) if status == SUCCESS else F.lit(None).cast("string")
    return files.select(
        F.col("path").alias("source_path"),
        F.lit(configuration).cast("string").alias("configuration_name"),
        "ingest_id",
        "correlation_id",
        F.lit(status).alias("status"),
        stamp.alias("snapshot_date"),
        (F.array(*details) if details else F.array()).cast(kind).alias("ingested_details"),
        F.lit(error).cast("string").alias("error"),
        F.lit(at).cast("timestamp").alias("at"),
    )


AUDIT_SCHEMA = (
    "source_path string, configuration_name string, ingest_id string, correlation_id string, status string, snapshot_date string, "
    "ingested_details array<struct<ingested_path:string,details:map<string,string>>>, error string, at timestamp, id_bucket int, day string"
)
#: Folders by ingest id. Each write leaves at most one file in each.
BUCKETS = 16


def _bucket(ingest_id: Column) -> Column:
    return F.pmod(F.xxhash64(ingest_id), F.lit(BUCKETS)).cast("int").alias("id_bucket")


def record(rows: DataFrame, path: str | None) -> None:
    if path:
        day = F.date_format("at", "yyyy-MM-dd").alias("day")
        keyed = rows.select("*", _bucket(F.col("ingest_id")), day)
        keyed.repartition("id_bucket").write.mode("append").partitionBy("id_bucket", "day").parquet(path)


def read_audit(spark: SparkSession, path: str, ids: DataFrame | None = None) -> DataFrame:
    """The audit rows, of the given ``ingest_id`` only if there are ids: then no other folders are listed or read. No table gives no rows."""
    if ids is None:
        return _read(spark, path, [path] if storage.exists(spark, path) else [])
    asked = ids.select("ingest_id", _bucket(F.col("ingest_id"))).distinct()
    buckets = sorted(r[0] for r in asked.select("id_bucket").distinct().collect())
    folders = [f for f in (f"{path}/id_bucket={b}" for b in buckets) if storage.exists(spark, f)]
    return _read(spark, path, folders).join(asked, ["id_bucket", "ingest_id"], "left_semi")


def _read(spark: SparkSession, path: str, folders: list[str]) -> DataFrame:
    if not folders:
        return spark.createDataFrame([], AUDIT_SCHEMA)
    return spark.read.schema(AUDIT_SCHEMA).option("basePath", path).parquet(*folders)


def load_states(spark: SparkSession, path: str, ids: DataFrame) -> DataFrame:
    """Per ingest id that ever began: whether it was ``loaded``. One that failed, or did not end, may have left rows behind."""
    rows = read_audit(spark, path, ids)
    return rows.groupBy("ingest_id").agg(F.bool_or(F.col("status") == SUCCESS).alias("loaded"))
