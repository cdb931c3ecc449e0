"""What a reader yields, and how it is told which files to read."""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field

from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.readwriter import DataFrameReader

from quayside.session import open_writers


@dataclass(frozen=True)
class Frame:
    """A lazy frame and the tokens that say where it came from.

    The frame carries each row's file in ``meta_source_name``, as the encoded URI
    the scan gives it; lineage later puts the plain path there. ``layout`` is the
    header of the files, for sources that give one frame per distinct header. ``rows`` is
    their number, where reading has told it.
    """

    df: DataFrame
    tokens: dict[str, str] = field(default_factory=dict)
    layout: tuple[str, ...] = ()
    rows: int | None = None

    @property
    def key(self) -> tuple:
        """What tells this frame from the others of its source, whatever files are read."""
        return tuple(sorted(self.tokens.items())), self.layout


@dataclass(frozen=True)
class Files:
    """Files of one kind: folders searched for ``glob``, or files named one by one.

    Folder columns are never guessed from paths, so that the frame holds just what
    the files hold.
    """

    paths: Sequence[str]
    glob: str | None = None

    @classmethod
    def literal(cls, paths: Iterable[str], glob: str | None = None) -> "Files":
        """Paths taken as they are and not as patterns."""
        return cls([re.sub(r"([\\\[\]{}*?])", r"\\\1", p) for p in paths], glob)

    @classmethod
    def named(cls, uris: Iterable[str]) -> "Files":
        """Files by the encoded URIs a scan gives."""
        return cls.literal(map(unquote, uris))

    def reader(self, spark: SparkSession) -> DataFrameReader:
        reader = spark.read.option("recursiveFileLookup", "true")
        return reader.option("pathGlobFilter", self.glob) if self.glob else reader

    def load(self, spark: SparkSession, kind: str, **options) -> DataFrame:
        reader = self.reader(spark).format(kind)
        for key, value in options.items():
            if value is not None:
                reader = reader.option(key, value)
        return reader.load(list(self.paths))


def stage_kinds(records: DataFrame, kinds: Sequence[Column], path: str) -> list[tuple[DataFrame, int]]:
    """The records of each kind and their number, from one pass that writes them to folders by kind.

    ``kinds`` are conditions; a record goes to the folder of each that holds, and nowhere if none does. What is read again is the
    staged columns of one kind.
    """
    spark = records.sparkSession
    numbers = F.filter(F.array(*(F.when(kind, F.lit(n)) for n, kind in enumerate(kinds))), lambda n: n.isNotNull())
    dealt = records.withColumn("_kind", F.explode(numbers))
    counted = Observation()
    counts = [F.count_if(F.col("_kind") == n).alias(f"kind_{n}") for n in range(len(kinds))]
    with open_writers(spark):
        dealt.observe(counted, *counts).write.partitionBy("_kind").parquet(path)
    found = counted.get
    staged = []
    for n in range(len(kinds)):
        rows = found.get(f"kind_{n}", 0)
        df = spark.read.schema(records.schema).parquet(f"{path}/_kind={n}") if rows else spark.createDataFrame([], records.schema)
        staged.append((df, rows))
    return staged
