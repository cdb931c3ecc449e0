"""Lineage columns and the per-file facts they need."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside import SNAPSHOT, SOURCE_NAME
from quayside.functions import paths
from quayside.functions.text import sha1_base36
from quayside.operators.lookup import lookup


@dataclass(frozen=True)
class Run:
    """What one load run stamps on its rows. Fixed at the start, so retries agree."""

    at: datetime
    provenance_id: str = "quayside"
    code_revision: str = "unversioned"
    version: str = "0"

    @classmethod
    def now(cls, **kwargs) -> "Run":
        return cls(datetime.now(timezone.utc), **kwargs)

    # fixed values: the tokens that templates may name, and how their dates are written
    @property
    def tokens(self) -> dict[str, str]:
        return {
            "datetime": self.at.strftime("%Y_%m_%d_%H_%M_%S"),
            "date": self.at.strftime("%Y_%m_%d"),
            "time": self.at.strftime("%H_%M_%S"),
            "artifactId": self.provenance_id,
            "version": self.version,
        }


def file_facts(files: DataFrame, snapshot: str | None = None) -> DataFrame:
    """Plain path, lineage id and snapshot stamp for a frame of distinct file URIs.

    The stamp comes from the path unless it is given.
    """
    source = paths.plain_path(F.col(SOURCE_NAME))
    return files.select(
        SOURCE_NAME,
        source.alias("_path"),
        sha1_base36(paths.base_name(source)).alias("meta_lineage_id"),
        (paths.snapshot_required(source) if snapshot is None else F.lit(snapshot)).alias(SNAPSHOT),
    )


def with_lineage(df: DataFrame, facts: DataFrame, run: Run, source_system: str, offset: str) -> DataFrame:
    """Append the lineage columns and the snapshot of each row's file.

    ``df`` carries the file URI in ``meta_source_name``. The hash runs once per
    file, in ``facts``, and reaches the rows through a measured lookup.
    """
    data = [c for c in df.columns if c != SOURCE_NAME]
    stamp = F.lit(run.tokens["datetime"])
    return lookup(df, facts, [SOURCE_NAME]).select(
        *data,
        "meta_lineage_id",
        F.lit(source_system).alias("meta_source_system_name"),
        F.col("_path").alias(SOURCE_NAME),
        F.lit(offset).alias("meta_source_offset"),
        stamp.alias("meta_lineage_datetime"),
        F.lit(run.provenance_id).alias("meta_provenance_id"),
        F.lit(run.code_revision).alias("meta_github_hash"),
        F.lit(run.version).alias("meta_semver"),
        stamp.alias("meta_provenance_datetime"),
        SNAPSHOT,
    )
