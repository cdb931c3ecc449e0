"""Loading requested files: list, resolve specs, read, stamp, write, audit.

All files of one spec are read together, so Spark's tasks and not driver threads
give the parallelism. Driver loops go over specs, frames and requested paths.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass, field, fields, is_dataclass, replace
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside import SNAPSHOT, SOURCE_NAME
from quayside.functions import paths
from quayside.operators.lineage import Run, file_facts, with_lineage
from quayside.operators.routing import first_environment, match_key, match_prefix, roll_up, unresolved_severity
from quayside.operators.schema import clean_columns
from quayside.plans.reports import failure_digest
from quayside.session import checkpoint, scratch_path, small_table
from quayside.sinks import storage
from quayside.sinks.audit import FAILED, SKIPPED, STARTED, SUCCESS, audit_rows, record
from quayside.sinks.targets import NotRegistered, WriteInfo
from quayside.sources.frames import Files, Frame
from quayside.sources.manifest import empty_files, hidden_files, list_files

SOURCE_SNAPSHOT = "source_snapshot"


@dataclass(frozen=True)
class Environment:
    """Where files belong: those whose path contains the line of business and the name."""

    name: str
    line_of_business: str | None = None

    @property
    def text(self) -> str:
        return (f"{self.line_of_business}/" if self.line_of_business else "") + self.name


@dataclass(frozen=True)
class LoadSpec:
    """Files below ``path`` with this extension, where they come from and go to.

    ``path`` is a path prefix as seen after the storage root is cut off. ``notify`` asks for a notice of each file loaded on arrival.
    With ``container`` (and ``account``) the spec is for files of that store whose path up to the snapshot folder is just ``path``; such a
    spec goes before those by prefix. Names and directories may hold ``${name}`` parameters of an environment.
    """

    name: str
    path: str
    extension: str
    source: Any
    target: Any
    notify: bool = False
    container: str | None = None
    account: str | None = None

    def for_environment(self, environment: Environment) -> "LoadSpec":
        """The spec with the environment's parameters in all its texts."""
        parameters = paths.environment_parameters(environment.name, environment.line_of_business)

        def filled(value):
            if isinstance(value, str):
                return paths.fill_parameters(value, parameters)
            if is_dataclass(value):
                return replace(value, **{f.name: filled(getattr(value, f.name)) for f in fields(value) if f.init})
            if isinstance(value, (list, tuple)):
                return type(value)(map(filled, value))
            return value

        return replace(filled(self), name=self.name)

    def frame_tokens(self, run: Run, frame: dict[str, str], snapshot: str | None = None) -> dict[str, str]:
        """All tokens a target template may use for one frame; later ones win."""
        source = {"sourceType": self.source.source_type, "sourceSystem": self.source.source_system}
        stamp = {SOURCE_SNAPSHOT: snapshot} if snapshot else {}
        return {**frame, **source, **self.target.tokens, **run.tokens, **stamp}


@dataclass
class LoadReport:
    """What a load did: the files it planned, and per failed group the error."""

    files: DataFrame
    written: dict[str, list[WriteInfo]] = field(default_factory=dict)
    failures: list[tuple[str, str]] = field(default_factory=list)
    _stamps: dict[str, set[str]] = field(default_factory=dict)
    _frames: dict[str, list[DataFrame]] = field(default_factory=dict)
    _ignored: dict[str, Column] = field(default_factory=dict)

    def write(self, target, rows: DataFrame, tokens: dict[str, str]) -> WriteInfo:
        """Write rows, adding to the snapshots this load wrote before instead of replacing them.

        Which snapshots those are is worked out only when a place is written to twice. What save mode ``ignore``
        leaves out is settled when the load first writes to a place.
        """
        if target.save_mode == "append":
            return target.write(rows, tokens)
        path = target.path(tokens)
        if target.save_mode == "ignore":
            if path not in self._ignored:
                self._ignored[path] = target.ignored(rows.sparkSession, tokens)
            rows = rows.where(~self._ignored[path])
        stamps = self._stamps.setdefault(path, set())
        for frame in self._frames.pop(path, []):
            stamps |= {r[0] for r in frame.select(SNAPSHOT).distinct().collect()}
        info = target.write(rows, tokens, appended=stamps)
        self._frames[path] = [rows]
        return info


class LoadFailed(RuntimeError):
    """Raised after every group was tried, with the digest of what failed."""

    def __init__(self, digest, report: LoadReport):
        self.report = report
        more = lambda n: f"\nand {n} more" if n else ""
        super().__init__(
            f"{digest['failed']} files failed:\n"
            + "\n".join(digest["subjects"])
            + more(digest["more_subjects"])
            + "\n\n"
            + "\n\n".join(digest["errors"])
            + more(digest["more_errors"])
        )


def plan_files(
    spark: SparkSession,
    specs: Sequence[LoadSpec],
    requests: Sequence[str],
    roots: Sequence[str] = (),
    run_id: str = "",
    environments: Sequence[Environment] = (),
) -> DataFrame:
    """Every file under the requests with its request, subject, environment and spec name.

    A file that cannot be loaded has a ``reason`` and a ``severity``: an error if it was requested itself, a warning if it was found in a
    requested folder. Reasons are a path that belongs to no environment, no spec, and a hidden name, which no scan reads. The plan is checkpointed. ``run_id`` tells loads of one file apart.
    """
    asked = [(p, storage.is_folder(spark, p)) for p in (storage.qualified(spark, r.rstrip("/")) for r in requests)]
    requested = small_table(spark, asked, "path string, is_folder boolean")
    folders = {p for p, folder in asked if folder}
    parents = [r["path"] for r in roll_up(requested).collect()]

    files = Files.literal(parents)
    listed = list_files(spark, files).withColumn("hidden", F.lit(False))
    unlisted = empty_files(spark, files, listed).withColumn("hidden", F.lit(False))
    listed = listed.unionByName(unlisted).unionByName(hidden_files(spark, parents).withColumn("hidden", F.lit(True)))
    entries = [(p, p, p not in folders) for p in parents]
    parent_table = small_table(spark, entries, "prefix string, request string, as_file boolean")
    source = F.col("path")
    listed = listed.withColumn("path", paths.plain_path(F.col(SOURCE_NAME)))
    planned = match_prefix(listed, parent_table, "path", "prefix", ["request", "as_file"])

    planned = planned.withColumn("subject", paths.store_subject(source, list(roots)))
    planned = planned.withColumn("extension", paths.extension(source))
    route = first_environment(source, [(e.text, e.text) for e in environments]) if environments else F.lit("")
    planned = resolve_specs(planned.withColumn("environment", route), specs)
    reason = F.when(F.col("hidden"), "hidden file").when(F.col("environment").isNull(), "no environment").when(F.col("spec").isNull(), "no load spec")
    planned = planned.withColumn("reason", reason)
    severity = unresolved_severity(F.when(F.col("reason").isNull(), F.lit("")), F.col("as_file"))
    planned = planned.withColumn("severity", severity)
    planned = planned.withColumn("ingest_id", F.sha2(F.concat_ws("|", source, F.col("modified").cast("string"), F.lit(run_id)), 256))
    return checkpoint(planned.withColumn("correlation_id", F.col("ingest_id")))


def resolve_specs(files: DataFrame, specs: Sequence[LoadSpec]) -> DataFrame:
    """Add the name of each file's spec: that of its account, container, ``subject`` up to the snapshot folder and ``extension``, else the one with the longest path prefix."""
    spark = files.sparkSession
    entries = [(s.path.rstrip("/"), s.extension, s.name) for s in specs if s.container is None]
    table = small_table(spark, entries, "prefix string, extension string, spec string")
    found = match_prefix(files, table, "subject", "prefix", ["spec"], on=["extension"])
    stored = [s for s in specs if s.container is not None]
    for with_account in (False, True):
        keyed = [(s.account or "", s.container, s.path.rstrip("/"), s.extension, s.name) for s in stored if bool(s.account) == with_account]
        if not keyed:
            continue
        kept, key = found.columns, ["_account", "_container", "_short", "extension"]
        account = paths.store_account(F.col("path")) if with_account else F.lit("")
        short = paths.short_subject(F.col("subject"))
        found = found.withColumns({"_account": account, "_container": paths.store_container(F.col("path")), "_short": short})
        found = match_key(found, small_table(spark, keyed, "_account string, _container string, _short string, extension string, _stored string"), key, ["_stored"])
        found = found.withColumn("spec", F.coalesce("_stored", "spec")).select(*kept)
    return found


def load(
    spark: SparkSession,
    specs: Sequence[LoadSpec],
    requests: Sequence[str],
    run: Run | None = None,
    roots: Sequence[str] = (),
    audit: str | None = None,
    reingest: bool = False,
    environments: Sequence[Environment] = (),
) -> LoadReport:
    """Load all requested files; with ``reingest`` delete what they wrote before.

    Every file that is found leaves rows in the audit: those that cannot be loaded say why, those of no length succeed and write nothing. With environments, each
    file goes to the first one that its path names, or to the only one there is, and its spec is filled with that one's parameters.
    """
    run = run or Run.now()
    planned = plan_files(spark, specs, requests, roots, run.at.isoformat(), environments)
    lost = planned.where("severity = 'error'")
    left = planned.where("severity = 'warning'")
    record(audit_rows(left, SKIPPED, F.col("spec"), run.at, error=F.col("reason")), audit)
    if first := [(r["reason"], r["path"]) for r in lost.take(10)]:
        record(audit_rows(lost, FAILED, F.col("spec"), run.at, error=F.col("reason")), audit)
        raise ValueError(f"{first[0][0]} for {lost.count()} requested files, the first of them {[p for _, p in first]}")
    planned = planned.where("severity is null")
    resolved = [s for environment in environments for s in _in_environment(specs, environment)] or list(specs)
    if environments:
        planned = planned.withColumn("spec", F.concat_ws(" in ", "spec", "environment"))
    if reingest:
        delete_loaded(spark, {s.name: s for s in resolved}, planned, run)
    report = load_planned(spark, resolved, planned.where("size > 0"), run, audit)
    empty = planned.where("size = 0")
    record(audit_rows(empty, STARTED, F.col("spec"), run.at), audit)
    record(audit_rows(empty, SUCCESS, F.col("spec"), run.at), audit)
    report.files = planned
    if report.failures:
        frame = small_table(spark, report.failures, "subject string, error string")
        raise LoadFailed(failure_digest(frame).first(), report)
    return report


def _in_environment(specs: Sequence[LoadSpec], environment: Environment) -> list[LoadSpec]:
    return [replace(s.for_environment(environment), name=f"{s.name} in {environment.text}") for s in specs]


def load_planned(
    spark: SparkSession, specs: Sequence[LoadSpec], planned: DataFrame, run: Run, audit: str | None = None
) -> LoadReport:
    """Load files whose spec is known; failures end up in the report."""
    by_name = {s.name: s for s in specs}
    report = LoadReport(planned)
    for row in planned.groupBy("spec").count().orderBy("spec").collect():
        group = planned.where(F.col("spec") == row["spec"])
        _load_group(spark, by_name[row["spec"]], group, run, audit, report)
    return report


def _load_group(spark, spec: LoadSpec, group: DataFrame, run: Run, audit, report: LoadReport, retry: dict | None = None) -> None:
    """Load one spec's files together; if that fails, halve the group to find the bad files.

    ``retry`` tells which frames were already written for all of the group's files.
    """
    if retry is None:
        record(audit_rows(group, STARTED, spec.name, run.at), audit)
    written: list[WriteInfo] = []
    done = dict(retry or {})
    # sources of several record types go through their files once
    staged = scratch_path(spark, "kinds") if hasattr(spec.source, "read_once") else None
    try:
        facts = checkpoint(file_facts(group.select(SOURCE_NAME)))
        files = _scan(group)
        frames = spec.source.read_once(spark, files, staged) if staged else spec.source.read(spark, files)
        stamps = _target_stamps(spec, facts)
        for frame in frames:
            stamped = _stamp(spec, frame, facts, run)
            for stamp in stamps:
                key = (frame.key, stamp)
                if key not in done:
                    rows = stamped if stamp is None else stamped.where(F.col(SNAPSHOT) == stamp)
                    tokens = spec.frame_tokens(run, frame.tokens, stamp)
                    empty = frame.rows == 0 or ((frame.rows is None or len(stamps) > 1) and rows.isEmpty())
                    done[key] = None if empty else report.write(spec.target, rows, tokens)
                if done[key]:
                    written.append(done[key])
    except Exception as error:  # noqa: BLE001 - whatever fails is recorded and isolated
        files = [r[0] for r in group.select("path").orderBy("path").toLocalIterator()]
        # written rows must not be written again, so a group that only failed to register stays whole
        if len(files) == 1 or isinstance(error, NotRegistered):
            report.failures += [(f, str(error)) for f in files]
            record(audit_rows(group, FAILED, spec.name, run.at, error=str(error)), audit)
            return
        middle = files[len(files) // 2]
        for half in (F.col("path") < middle, F.col("path") >= middle):
            _load_group(spark, spec, group.where(half), run, audit, report, done)
        return
    finally:
        if staged and storage.exists(spark, staged):
            storage.remove(spark, staged)
    known = report.written.setdefault(spec.name, [])
    known += [w for w in written if w not in known]
    record(audit_rows(group, SUCCESS, spec.name, run.at, written), audit)


def load_database(
    spark: SparkSession, spec: LoadSpec, snapshot: str, run: Run | None = None
) -> list[WriteInfo]:
    """Load every table of a database source under one snapshot stamp."""
    run = run or Run.now()
    written = []
    for frame in spec.source.read(spark):
        names = checkpoint(frame.df.select(SOURCE_NAME).distinct())
        rows = _stamp(spec, frame, checkpoint(file_facts(names, snapshot)), run)
        if not rows.isEmpty():
            written.append(spec.target.write(rows, spec.frame_tokens(run, frame.tokens, snapshot)))
    return written


def _stamp(spec: LoadSpec, frame: Frame, facts: DataFrame, run: Run) -> DataFrame:
    """Cleaned and stamped rows of the files in ``facts``."""
    offset = frame.tokens.get("sourceOffset", "")
    rows = with_lineage(clean_columns(frame.df), facts, run, spec.source.source_system, offset)
    return rows.where("meta_lineage_id is not null")


def _target_stamps(spec: LoadSpec, facts: DataFrame) -> list[str | None]:
    """The snapshots to write one by one, when the target's place depends on them."""
    if not any("{" + SOURCE_SNAPSHOT + "}" in text for text in spec.target.tokens.values()):
        return [None]
    return sorted(r[0] for r in facts.select(SNAPSHOT).distinct().collect())


def _scan(group: DataFrame) -> Files:
    """The group's files by name, however many: Spark's file index holds them on the driver as well."""
    return Files.named(r[0] for r in group.select(SOURCE_NAME).toLocalIterator())


def delete_loaded(spark: SparkSession, specs: dict[str, LoadSpec], planned: DataFrame, run: Run) -> None:
    """Delete what the planned files wrote: per requested folder and spec, or of the requested files."""
    folders = planned.where("not as_file").select("request", "spec").distinct().collect()
    for row in folders:
        spec = specs[row["spec"]]
        stamp = _last_stamp(row["request"])
        for tokens in spec.source.type_tokens():
            spec.target.delete(spark, spec.frame_tokens(run, tokens, stamp), snapshot=stamp)
    # all files of a spec and a stamp at once, so that a target is rewritten once for them
    together: dict[tuple[str, str], list[str]] = {}
    for row in planned.where("as_file").select("path", "spec").orderBy("path").collect():
        stamp = _last_stamp(row["path"])
        if stamp is None:
            raise ValueError(f"no snapshot stamp in path: {row['path']}")
        together.setdefault((row["spec"], stamp), []).append(row["path"])
    for (name, stamp), files in together.items():
        spec = specs[name]
        for tokens in spec.source.type_tokens():
            spec.target.delete(spark, spec.frame_tokens(run, tokens, stamp), snapshot=stamp, file=files)


def _last_stamp(path: str) -> str | None:
    found = re.fullmatch(paths.STAMP_PATTERN, path)
    return found[1] if found else None
