"""Where a load writes to, and how its data is deleted again."""

from __future__ import annotations

import re
from collections.abc import Collection, Mapping, Sequence
from dataclasses import dataclass, field, replace
from typing import ClassVar

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside import SNAPSHOT, SOURCE_NAME
from quayside.functions.names import quoted
from quayside.functions.paths import fill_text
from quayside.operators.upsert import latest_per_key, merge_by_key
from quayside.session import checkpoint, open_writers
from quayside.sinks import file_index, storage

SAVE_MODES = ("append", "overwrite", "ignore", "errorifexists")
_NAME = re.compile(r"[a-zA-Z_0-9/.]+")


def sql_text(value: str) -> str:
    """A text literal for SQL."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


@dataclass(frozen=True)
class WriteInfo:
    """What one write produced."""

    path: str
    details: Mapping[str, str] = field(default_factory=dict)


class NotRegistered(RuntimeError):
    """The rows were written, but the catalog could not be brought up to date."""


def _check_mode(mode: str) -> None:
    if mode not in SAVE_MODES:
        raise ValueError(f"save mode {mode!r} is none of {SAVE_MODES}")


def _check_name(name: str) -> None:
    if not _NAME.fullmatch(re.sub(r"\$?\{\w+\}", "token", name)):
        raise ValueError(f"not a valid table or database name: {name!r}")


def _listed(files: str | Sequence[str]) -> list[str]:
    return [files] if isinstance(files, str) else list(files)


def with_file_count(df: DataFrame, num_files: int | None) -> DataFrame:
    """Spread rows evenly over ``num_files`` tasks; without a number, write as scanned."""
    return df if num_files is None else df.repartition(num_files)


@dataclass(frozen=True)
class SnapshotFiles:
    """Parquet folders ``<dir>.parquet/snapshot_date=<stamp>``.

    The save mode works per snapshot: ``overwrite`` replaces only the snapshots in
    the frame, ``ignore`` leaves out those already there, ``errorifexists`` raises.
    """

    directory: str
    save_mode: str = "append"
    num_files: int | None = None

    target_type: ClassVar[str] = "parquet"
    suffix: ClassVar[str] = ".parquet"

    def __post_init__(self):
        _check_mode(self.save_mode)

    # fixed values: the tokens that templates may name
    @property
    def tokens(self) -> dict[str, str]:
        return {"targetType": self.target_type, "saveMode": self.save_mode, "parquetDir": self.directory}

    def path(self, tokens: Mapping[str, str]) -> str:
        return fill_text(self.directory, tokens).rstrip("/") + self.suffix

    def write(self, df: DataFrame, tokens: Mapping[str, str], appended: Collection[str] = ()) -> WriteInfo:
        """Write in the save mode; snapshots ``appended`` to belong to the same load and are only added to."""
        spark, path = df.sparkSession, self.path(tokens)
        mode = self.save_mode
        if appended and mode != "append":
            again = F.col(SNAPSHOT).isin(list(appended))
            replace(self, save_mode="append").write(df.where(again), tokens)
            df = df.where(~again)
        if mode in ("ignore", "errorifexists"):
            present = storage.partition_values(spark, path)
            clash = F.col(SNAPSHOT).isin(present)
            if mode == "errorifexists" and present and not df.where(clash).isEmpty():
                raise ValueError(f"a snapshot in the frame already exists below {path}")
            df, mode = df.where(~clash), "append"
        writer = with_file_count(df, self.num_files).write.mode(mode).partitionBy(SNAPSHOT)
        with open_writers(spark):
            writer.option("partitionOverwriteMode", "dynamic").parquet(path)
        try:
            return self.register(spark, df.schema, path, tokens)
        except Exception as error:
            raise NotRegistered(str(error)) from error

    def ignored(self, spark: SparkSession, tokens: Mapping[str, str]) -> Column:
        """Rows that save mode ``ignore`` leaves out, as the target is now."""
        return F.col(SNAPSHOT).isin(storage.partition_values(spark, self.path(tokens)))

    def register(self, spark: SparkSession, schema: T.StructType, path: str, tokens: Mapping[str, str]) -> WriteInfo:
        return WriteInfo(path)

    def unregister(self, spark: SparkSession, path: str, tokens: Mapping[str, str]) -> None:
        """Called after files below ``path`` were removed."""

    def delete(
        self, spark: SparkSession, tokens: Mapping[str, str], snapshot: str | None = None, file: str | Sequence[str] | None = None
    ) -> None:
        """Delete the rows of a file or of several files of a snapshot, one snapshot, or with neither everything."""
        path = self.path(tokens)
        folder = f"{path}/{SNAPSHOT}={snapshot}" if snapshot else path
        if file and self.save_mode != "overwrite":
            storage.delete_rows(spark, path, storage.rows_of_files(_listed(file)), [SNAPSHOT], folder)
        elif storage.exists(spark, folder):
            storage.remove(spark, folder)
        self.unregister(spark, path, tokens)


@dataclass(frozen=True)
class HistoryTable(SnapshotFiles):
    """Snapshot folders behind table ``<name>_history``, with view ``<name>`` on the newest."""

    database: str = "default"
    table: str = ""

    target_type: ClassVar[str] = "hive"
    suffix: ClassVar[str] = "_history.parquet"

    def __post_init__(self):
        super().__post_init__()
        _check_name(self.database)
        _check_name(self.table)

    # fixed values: the tokens that templates may name
    @property
    def tokens(self) -> dict[str, str]:
        return {
            "targetType": self.target_type,
            "hiveDir": self.directory,
            "hiveDbName": self.database,
            "tableName": self.table,
        }

    def names(self, tokens: Mapping[str, str]) -> tuple[str, str]:
        view = f"{self.database}.{fill_text(self.table, tokens)}"
        return view, view + "_history"

    def register(self, spark: SparkSession, schema: T.StructType, path: str, tokens: Mapping[str, str]) -> WriteInfo:
        view, history = self.names(tokens)
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {self.database}")
        create_or_widen(spark, history, schema, path, [SNAPSHOT])
        self._sync(spark, path, view, history)
        details = {"hiveDatabase": self.database, "hiveTableName": history.split(".")[1]}
        return WriteInfo(path, {**details, "hiveViewName": view.split(".")[1]})

    def unregister(self, spark: SparkSession, path: str, tokens: Mapping[str, str]) -> None:
        view, history = self.names(tokens)
        if not spark.catalog.tableExists(history):
            return
        if storage.partition_values(spark, path):
            self._sync(spark, path, view, history)
        else:
            spark.sql(f"DROP VIEW IF EXISTS {view}")
            spark.sql(f"DROP TABLE IF EXISTS {history}")

    def _sync(self, spark: SparkSession, path: str, view: str, history: str) -> None:
        """Bring the catalog's partitions in line with the folders, then move the view."""
        on_disk = set(storage.partition_values(spark, path))
        listed = {r[0].split("=")[1] for r in spark.sql(f"SHOW PARTITIONS {history}").collect()}
        for stamp in sorted(on_disk - listed):
            spark.sql(f"ALTER TABLE {history} ADD IF NOT EXISTS PARTITION ({SNAPSHOT}={sql_text(stamp)})")
        for stamp in sorted(listed - on_disk):
            spark.sql(f"ALTER TABLE {history} DROP IF EXISTS PARTITION ({SNAPSHOT}={sql_text(stamp)})")
        spark.catalog.refreshTable(history)
        # a literal, so that readers of the view prune to one folder at planning
        newest = max(on_disk)
        spark.sql(f"CREATE OR REPLACE VIEW {view} AS SELECT * FROM {history} WHERE {SNAPSHOT} = {sql_text(newest)}")


@dataclass(frozen=True)
class ManagedTable:
    """A registered table ``<database>.<table>`` at ``<dir>``.

    ``overwrite`` replaces the whole table. With ``keys`` each write is a merge: a
    format with row-level operations does it in place, Parquet gets a new version
    folder and the view of that name moves to it, the version before being kept.
    Where the partition columns are among the keys, rows keep their partitions, and a Parquet merge reads and replaces only the
    partitions that updates fall into; the others keep their files and there is no new version.
    One writer per table at a time is assumed.
    """

    database: str
    table: str
    directory: str
    save_mode: str = "append"
    num_files: int | None = None
    partition_columns: Sequence[str] = ()
    keys: Sequence[str] = ()
    delete_unmatched: bool = False
    evolve: bool = True
    format: str = "parquet"

    target_type: ClassVar[str] = "delta"

    def __post_init__(self):
        _check_mode(self.save_mode)
        _check_name(self.database)
        _check_name(self.table)
        if self.keys and self.save_mode != "append":
            raise ValueError("keys need save mode append")

    # fixed values: the tokens that templates may name
    @property
    def tokens(self) -> dict[str, str]:
        return {
            "targetType": self.target_type,
            "hiveDbName": self.database,
            "tableName": self.table,
            "deltaDir": self.directory,
        }

    def path(self, tokens: Mapping[str, str]) -> str:
        return fill_text(self.directory, tokens).rstrip("/")

    def name(self, tokens: Mapping[str, str]) -> str:
        return f"{self.database}.{fill_text(self.table, tokens)}"

    def ignored(self, spark: SparkSession, tokens: Mapping[str, str]) -> Column:
        """Rows that save mode ``ignore`` leaves out, as the target is now: all of them once there is a table."""
        return F.lit(storage.exists(spark, self.path(tokens)))

    def write(self, df: DataFrame, tokens: Mapping[str, str], appended: Collection[str] = ()) -> WriteInfo:
        """Write in the save mode, or add to what the same load wrote before when ``appended`` is not empty."""
        if appended and self.save_mode != "append":
            return replace(self, save_mode="append").write(df, tokens)
        spark, path, name = df.sparkSession, self.path(tokens), self.name(tokens)
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {self.database}")
        if self.keys and self.format == "parquet":
            self._write_version(df, path, name)
        elif self.keys and spark.catalog.tableExists(name):
            self._merge_in_place(self._updates(df), name)
        else:
            self._write_plain(self._updates(df) if self.keys else df, path, name)
        details = {"hiveDatabase": self.database, "hiveTableName": name.split(".")[1]}
        return WriteInfo(path, details)

    def _write_plain(self, df: DataFrame, path: str, name: str) -> None:
        spark = df.sparkSession
        writer = with_file_count(df, self.num_files).write.format(self.format).mode(self.save_mode)
        if self.partition_columns:
            writer = writer.partitionBy(*self.partition_columns)
        with open_writers(spark):
            writer.option("overwriteSchema", "true").option("partitionOverwriteMode", "static").save(path)
        try:
            if self.save_mode == "overwrite":
                spark.sql(f"DROP TABLE IF EXISTS {name}")
            create_or_widen(spark, name, df.schema, path, self.partition_columns, self.format)
            if self.partition_columns and self.format == "parquet":
                spark.sql(f"ALTER TABLE {name} RECOVER PARTITIONS")
            spark.catalog.refreshTable(name)
        except Exception as error:
            raise NotRegistered(str(error)) from error

    def _merge_in_place(self, df: DataFrame, name: str) -> None:
        same = F.lit(True)
        for key in self.keys:
            same = same & (F.col(f"updates.{key}") == F.col(f"{name}.{key}"))
        newer = F.col(f"{name}.{SNAPSHOT}") <= F.col(f"updates.{SNAPSHOT}")
        merge = df.alias("updates").mergeInto(name, same)
        merge = merge.whenMatched(newer).updateAll().whenNotMatched().insertAll()
        if self.delete_unmatched:
            merge = merge.whenNotMatchedBySource().delete()
        (merge.withSchemaEvolution() if self.evolve else merge).merge()

    def _updates(self, df: DataFrame) -> DataFrame:
        """Each key's rows from its newest file; of the newest snapshot only, if keys that it lacks go.

        A first load comes this way too: a backfill holds many snapshots of a key.
        """
        updates = checkpoint(df)  # read several times; the landed files are parsed once
        if self.delete_unmatched:
            newest = updates.agg(F.max(SNAPSHOT)).first()[0]
            updates = updates.where(F.col(SNAPSHOT) == newest)
        return latest_per_key(updates, self.keys)

    # Parquet versions: a folder counts once its _SUCCESS marker is there

    def versions(self, spark: SparkSession, path: str) -> list[int]:
        numbers = [int(n.split("=")[1]) for n in storage.child_names(spark, path) if n.startswith("version=")]
        return sorted(n for n in numbers if storage.exists(spark, f"{path}/version={n}/_SUCCESS"))

    def _write_version(self, df: DataFrame, path: str, name: str) -> None:
        spark = df.sparkSession
        self._finish_moves(spark, path)
        done = self.versions(spark, path)
        merged = self._updates(df)
        if done:
            current = storage.read_table_files(spark, f"{path}/version={done[-1]}")
            # the merge reads its updates several times
            updates = checkpoint(merged)
            if self._keeps_partitions(current, updates):
                self._merge_partitions(current, updates, path, done[-1])
                spark.catalog.refreshTable(name)
                return
            merged = merge_by_key(current, updates, self.keys, self.delete_unmatched, self.evolve)
        fresh = f"{path}/version={done[-1] + 1 if done else 1}"
        writer = with_file_count(merged, self.num_files).write.mode("overwrite")
        if self.partition_columns:
            writer = writer.partitionBy(*self.partition_columns)
        with open_writers(spark):
            writer.parquet(fresh)
        spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT * FROM parquet.{quoted(fresh)}")
        for old in done[:-1]:
            storage.remove(spark, f"{path}/version={old}")

    # partitions: merged rows are written beside the table and moved in once all are there

    def _keeps_partitions(self, current: DataFrame, updates: DataFrame) -> bool:
        """Whether a merge leaves all rows of other partitions, and the table's columns, as they are."""
        among_keys = bool(self.partition_columns) and set(self.partition_columns) <= set(self.keys)
        same_columns = not self.evolve or set(updates.columns) <= set(current.columns)
        return among_keys and same_columns and not self.delete_unmatched

    def _merge_partitions(self, current: DataFrame, updates: DataFrame, path: str, version: int) -> None:
        spark, parts = current.sparkSession, list(self.partition_columns)
        place = F.to_json(F.struct(*(F.col(quoted(c)).cast("string").alias(c) for c in parts)))
        # one text per partition, as many as the catalog would name
        touched = [r[0] for r in updates.select(place).distinct().collect()]
        kinds = {f.name: f.dataType for f in updates.schema}
        before = current.where(place.isin(touched)).withColumns({c: F.col(quoted(c)).cast(kinds[c]) for c in parts})
        merged = merge_by_key(before, updates, self.keys, False, self.evolve)
        work = self._moving(path, version)
        with open_writers(spark):
            with_file_count(merged, self.num_files).write.mode("overwrite").partitionBy(*parts).parquet(work)
        self._finish_moves(spark, path)

    @staticmethod
    def _moving(path: str, version: int) -> str:
        return f"{path}/_moving_{version}"

    def _finish_moves(self, spark: SparkSession, path: str) -> None:
        """Put merged partitions in the place of the old ones, also those that a driver which died left behind.

        A folder without its _SUCCESS marker was not written to the end and goes.
        """
        for name in storage.child_names(spark, path):
            if not name.startswith("_moving_"):
                continue
            work, root = f"{path}/{name}", f"{path}/version={name.removeprefix('_moving_')}"
            if storage.exists(spark, f"{work}/_SUCCESS"):
                for folder in storage.leaf_folders(spark, work, len(self.partition_columns)):
                    storage.remove(spark, f"{root}/{folder}")
                    storage.move(spark, f"{work}/{folder}", f"{root}/{folder}")
                spark.catalog.refreshByPath(root)
            storage.remove(spark, work)

    def delete(
        self, spark: SparkSession, tokens: Mapping[str, str], snapshot: str | None = None, file: str | Sequence[str] | None = None
    ) -> None:
        """Delete the rows of a file or of several files, one snapshot's rows, or with neither everything.

        An index tells which data files hold rows of a landed file; no others are read.
        """
        path, name = self.path(tokens), self.name(tokens)
        if not storage.exists(spark, path):
            return
        if self.save_mode == "overwrite" or not (snapshot or file):
            spark.sql(f"DROP VIEW IF EXISTS {name}" if self._is_view(spark, name) else f"DROP TABLE IF EXISTS {name}")
            storage.remove(spark, path)
            return
        files = _listed(file) if file else []
        doomed = storage.rows_of_files(files) if files else F.col(SNAPSHOT) == snapshot
        if self.format != "parquet":
            ends = " OR ".join(f"endswith({SOURCE_NAME}, {sql_text(s)})" for s in storage.landed_suffixes(files))
            spark.sql(f"DELETE FROM {name} WHERE {ends or f'{SNAPSHOT} = {sql_text(snapshot)}'}")
            return
        root = path
        if self.keys:
            self._finish_moves(spark, path)
            root = f"{path}/version={self.versions(spark, path)[-1]}"
        among = None
        if files:
            among = file_index.data_files(spark, root, sorted({s[s.rfind(SNAPSHOT):] for s in storage.landed_suffixes(files)}))
        storage.delete_rows(spark, root, doomed, self.partition_columns, among=among)

    @staticmethod
    def _is_view(spark: SparkSession, name: str) -> bool:
        return spark.catalog.tableExists(name) and spark.catalog.getTable(name).tableType == "VIEW"


def create_or_widen(
    spark: SparkSession,
    name: str,
    schema: T.StructType,
    path: str,
    partition_by: Sequence[str],
    source: str = "parquet",
) -> None:
    """Register the table over ``path``; on a later call add the columns it lacks."""
    def ddl(fields):
        return ", ".join(f"{quoted(f.name)} {f.dataType.simpleString()}" for f in fields)

    if not spark.catalog.tableExists(name):
        parts = f"PARTITIONED BY ({', '.join(partition_by)})" if partition_by else ""
        columns = "" if source == "delta" else f"({ddl(schema)})"
        parts = "" if source == "delta" else parts
        spark.sql(f"CREATE TABLE IF NOT EXISTS {name} {columns} USING {source} {parts} LOCATION {sql_text(path)}")
        return
    known = {c.lower() for c in spark.table(name).columns}
    fresh = [f for f in schema if f.name.lower() not in known]
    if fresh and source == "parquet":
        spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({ddl(fresh)})")
