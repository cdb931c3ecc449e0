"""Loading the files that arrival messages tell of."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside import SOURCE_NAME
from quayside.functions import paths
from quayside.operators.lineage import Run
from quayside.plans.load import LoadSpec, delete_loaded, load_planned, resolve_specs
from quayside.session import checkpoint, small_table
from quayside.sinks import storage
from quayside.sinks.audit import SUCCESS, audit_rows, load_states, read_audit, record
from quayside.sources.frames import Files
from quayside.sources.manifest import empty_files, list_files


@dataclass
class MessageLoader:
    """The ingest callback of ``Arrivals``: loads a batch of messages spec by spec.

    A file of no length succeeds and writes nothing; one with a hidden name, which no scan reads, is a failure. ``location`` says where a file lies, with ``{container}`` and ``{subject}`` in
    it. ``specs`` is asked for at every batch and may raise ``SpecsUnavailable``;
    spec paths are prefixes of ``/<container><subject>``. A message without a spec
    is passed over.

    The audit is the memory of what was loaded: a message with a SUCCESS row is not loaded again, and
    one that began and failed or did not end has its file's rows deleted first. So a batch that runs again adds nothing.

    With ``notices``, files of specs that ask for it leave a row there once they are loaded: message, file and what was written.
    """

    location: str
    specs: Callable[[], Sequence[LoadSpec]]
    audit: str
    run: Callable[[], Run] = Run.now
    notices: str | None = None

    def __call__(self, messages: DataFrame) -> DataFrame | None:
        spark = messages.sparkSession
        specs = list(self.specs())
        tokens = F.create_map(F.lit("container"), F.col("container"), F.lit("subject"), F.col("subject"))
        files = messages.select(
            "message_id",
            "correlation_id",
            paths.fill_template(F.lit(self.location), tokens).alias("path"),
            paths.extension(F.col("subject")).alias("extension"),
            F.concat(F.lit("/"), "container", "subject").alias("subject"),
        )
        known = resolve_specs(files, specs).where("spec is not null")
        states = checkpoint(load_states(spark, self.audit, known.select(F.col("message_id").alias("ingest_id"))))
        loaded = states.where("loaded").select(F.col("ingest_id").alias("message_id"))
        begun = states.where("not loaded").select("ingest_id")
        known = checkpoint(known.join(loaded, "message_id", "left_anti"))

        # one entry per message of this micro-batch
        asked = [(r["path"], storage.qualified(spark, r["path"])) for r in known.select("path").distinct().collect()]
        hidden = {p for p, _ in asked if p.rsplit("/", 1)[-1].startswith(("_", "."))}
        there = {p: storage.exists(spark, p) for p, _ in asked if p not in hidden}
        present = [q for p, q in asked if there.get(p)]
        failed = [(p, "hidden file" if p in hidden else "file does not exist") for p, _ in asked if not there.get(p)]
        if present:
            named = small_table(spark, asked, "asked string, path string")
            files = Files.literal(present)
            listed = list_files(spark, files)
            listed = listed.unionByName(empty_files(spark, files, listed))
            listed = listed.withColumn("path", paths.plain_path(F.col(SOURCE_NAME))).join(named, "path")
            # two messages on one file load it once
            by_file = known.groupBy(F.col("path").alias("asked")).agg(
                F.min_by(F.struct("spec", "message_id", "correlation_id"), "message_id").alias("first")
            )
            planned = listed.join(by_file, "asked").select(
                SOURCE_NAME,
                "path",
                "asked",
                "size",
                F.col("first.spec").alias("spec"),
                F.col("first.message_id").alias("ingest_id"),
                F.col("first.correlation_id").alias("correlation_id"),
            )
            planned, run = checkpoint(planned), self.run()
            self._undo(planned.join(begun, "ingest_id", "left_semi"), specs, run)
            report = load_planned(spark, specs, planned.where("size > 0"), run, self.audit)
            record(audit_rows(planned.where("size = 0"), SUCCESS, F.col("spec"), run.at), self.audit)
            self._notify(specs, planned, run)
            back = {q: p for p, q in asked}
            failed += [(back[q], error) for q, error in report.failures]
        if not failed:
            return None
        errors = small_table(spark, failed, "path string, error string")
        return known.join(errors, "path").select("message_id", "error")

    def _notify(self, specs: Sequence[LoadSpec], planned: DataFrame, run: Run) -> None:
        """A row for each file that this run loaded, of specs that ask for one."""
        asking = [s.name for s in specs if s.notify]
        if not self.notices or not asking:
            return
        spark = planned.sparkSession
        done = read_audit(spark, self.audit, planned.where(F.col("spec").isin(asking)).select("ingest_id"))
        done = done.where((F.col("status") == SUCCESS) & (F.col("at") == F.lit(run.at).cast("timestamp")) & F.col("configuration_name").isin(asking))
        written = F.transform("ingested_details", lambda d: d["ingested_path"])
        rows = done.select(F.col("ingest_id").alias("message_id"), "correlation_id", "source_path", "configuration_name", written.alias("written"), "at")
        if not rows.isEmpty():
            rows.write.mode("append").parquet(self.notices)

    @staticmethod
    def _undo(planned: DataFrame, specs: Sequence[LoadSpec], run: Run) -> None:
        """Delete what a load that did not end may have added. Targets that replace need no delete."""
        adding = {s.name: s for s in specs if s.target.save_mode == "append"}
        files = planned.where(F.col("spec").isin(list(adding)) & paths.snapshot_or_null(F.col("path")).isNotNull())
        delete_loaded(planned.sparkSession, adding, files.select("path", "spec", F.col("path").alias("request"), F.lit(True).alias("as_file")), run)
