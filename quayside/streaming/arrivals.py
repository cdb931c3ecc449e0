"""Loading files as their arrival messages come in, with Structured Streaming.

Each micro-batch leaves one folder in the outcome table, written in overwrite mode
under its batch id, so a batch that runs again replaces what it wrote before. What
the stream must remember lies beside it, in tables of which a batch reads only the parts it needs:

* ``seen``: the ids handled so far, in buckets by hash and day. A batch reads the buckets of its own ids.
  Repeats that follow shortly do not come that far: the stream's state store drops them.
* ``delayed``: messages that wait, by the hour they are due. A batch reads hours that have come. An hour leaves
  when all its messages were handled.

What a batch wrote counts for the batches after it, and not for itself when it runs again.
"""

from __future__ import annotations

import threading
import time
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamReader, StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener

from quayside.session import scratch_path
from quayside.sinks import storage
from quayside.streaming.messages import (
    DEAD_LETTER,
    DELAY,
    INGEST,
    MESSAGE_SCHEMA,
    SPEC_WAIT_SECONDS,
    classify,
    retry_outcome,
)

OUTCOME_SCHEMA = (
    MESSAGE_SCHEMA + ", environment string, container string, full_subject string, subject string, "
    "correlation_id string, reason string, due_at timestamp, requeue_id string, batch_id bigint, outcome string"
)
SEEN_SCHEMA = "message_id string, batch_id bigint, bucket int, day int"
DELAYED_SCHEMA = MESSAGE_SCHEMA + ", requeue_id string, due_at timestamp, due_hour bigint, batch_id bigint"

#: Buckets of the seen ids. A batch of few messages reads few of them.
BUCKETS = 16
#: How long the state store keeps an id. Repeats after that are found among the seen ids.
REPEAT_WINDOW = "10 minutes"
#: A listening run stops after this time without a message.
IDLE_LIMIT = timedelta(minutes=5)
_HOUR, _DAY = 3600, 86400


class SpecsUnavailable(RuntimeError):
    """Raised by the ingest callback when load specs cannot be had at the moment."""


class _Activity(StreamingQueryListener):
    """Notes when a query last took in rows, and whether it has looked for any yet."""

    def __init__(self) -> None:
        self.query_id: str | None = None
        self.looked = False
        self.last = time.monotonic()

    def note(self) -> None:
        self.last = time.monotonic()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        if str(event.progress.id) == self.query_id:
            self.looked = True
            if event.progress.numInputRows > 0:
                self.note()

    def onQueryIdle(self, event) -> None:
        if str(event.id) == self.query_id:
            self.looked = True

    def onQueryTerminated(self, event) -> None:
        pass


@dataclass
class Arrivals:
    """``ingest`` gets the messages to load; it returns ``(message_id, error)`` of
    those that failed, or None. ``remember_days`` bounds how far back repeats are
    sought; None means always. ``state`` is the folder of what the stream remembers, by
    default beside the outcomes.
    """

    outcomes: str
    environments: Sequence[tuple[str, str]]
    ingest: Callable[[DataFrame], DataFrame | None]
    remember_days: int | None = None
    clock: Callable[[], datetime] = lambda: datetime.now(timezone.utc)
    state: str = ""
    _lock: threading.Lock = field(default_factory=threading.Lock, repr=False)
    _session: SparkSession | None = field(default=None, repr=False)

    def __post_init__(self) -> None:
        self.state = (self.state or f"{self.outcomes}_state").rstrip("/")

    def run(self, spark: SparkSession, messages: str, checkpoint_dir: str, files_per_batch: int = 100) -> None:
        """Handle all messages there are, then delayed ones that are due, then stop."""
        query = self._start(spark, messages, checkpoint_dir, files_per_batch, availableNow=True)
        query.awaitTermination()
        self.release(spark)

    def listen(
        self,
        spark: SparkSession,
        messages: str,
        checkpoint_dir: str,
        files_per_batch: int = 100,
        every: str = "10 seconds",
        idle: timedelta = IDLE_LIMIT,
    ) -> None:
        """Handle messages as they come, and delayed ones when they are due, until none came for the time ``idle``.

        A query listener tells when rows were taken in. The query is stopped between two micro-batches.
        """
        activity = _Activity()
        spark.streams.addListener(activity)
        try:
            query = self._start(spark, messages, checkpoint_dir, files_per_batch, processingTime=every)
            activity.query_id = str(query.id)
            poll = min(max(idle.total_seconds() / 10, 0.1), 10)
            while not query.awaitTermination(poll):
                if self._busy(query) or not (activity.looked or query.lastProgress):
                    # a long start or micro-batch is no silence
                    activity.note()
                elif self._release(spark, settled=False):
                    activity.note()
                elif time.monotonic() - activity.last > idle.total_seconds():
                    break
            # no micro-batch is cut off
            with self._lock:
                query.stop()
        finally:
            spark.streams.removeListener(activity)

    @staticmethod
    def _busy(query: StreamingQuery) -> bool:
        status = query.status
        looking = "Getting offsets" in status["message"]
        return status["isDataAvailable"] or (status["isTriggerActive"] and not looking) or status["message"].startswith("Initializing")

    def _start(self, spark: SparkSession, messages: str, checkpoint_dir: str, files_per_batch: int, **trigger) -> StreamingQuery:
        self._session = spark
        reader: DataStreamReader = spark.readStream.schema(MESSAGE_SCHEMA).option("maxFilesPerTrigger", files_per_batch)
        # time of arrival, so that no message is late; the column goes again behind the state store
        arrived = reader.json(messages).withColumn("_arrived", F.current_timestamp()).withWatermark("_arrived", REPEAT_WINDOW)
        once = arrived.dropDuplicatesWithinWatermark(["message_id"]).drop("_arrived")
        writer = once.writeStream.foreachBatch(self.process).option("checkpointLocation", checkpoint_dir)
        return writer.trigger(**trigger).start()

    def release(self, spark: SparkSession) -> None:
        """Handle delayed messages that are due, with or without new ones.

        Such a pass has a negative number, one below all that were finished. If it breaks off, the next has the same
        number, finds the same messages due and replaces what it wrote.
        """
        self._release(spark, settled=True)

    def _release(self, spark: SparkSession, settled: bool) -> bool:
        with self._lock:
            finished = f"{self.state}/finished"
            numbers = [int(n) for n in storage.child_names(spark, finished)]
            number = max(numbers, default=0) + 1
            due = self._due(spark, -number)
            if due is None or due.isEmpty():
                return False
            self._handle(due.sparkSession.createDataFrame([], T.StructType.fromDDL(MESSAGE_SCHEMA)), -number, settled)
            storage.make_folder(spark, f"{finished}/{number}")
            for old in numbers:
                storage.remove(spark, f"{finished}/{old}")
            return True

    def history(self, spark: SparkSession) -> DataFrame:
        """Outcomes so far."""
        if not storage.exists(spark, self.outcomes):
            return spark.createDataFrame([], T.StructType.fromDDL(OUTCOME_SCHEMA))
        return spark.read.schema(OUTCOME_SCHEMA).parquet(self.outcomes)

    def process(self, batch: DataFrame, batch_id: int) -> None:
        """Handle a micro-batch. One that runs again does not look at what it wrote before."""
        with self._lock:
            self._handle(batch, batch_id, settled=True)

    # what the stream remembers

    def seen(self, spark: SparkSession, ids: DataFrame, batch_id: int) -> DataFrame:
        """Which of these message ids another batch has handled. Only folders of their buckets are listed and read."""
        table = f"{self.state}/seen"
        asked = ids.select("message_id", _bucket("message_id")).distinct()
        buckets = sorted(r[0] for r in asked.select("bucket").distinct().collect())
        folders = [p for p in (f"{table}/bucket={b}" for b in buckets) if storage.exists(spark, p)]
        if not folders:
            return asked.select("message_id").where(F.lit(False))
        known = spark.read.schema(SEEN_SCHEMA).option("basePath", table).parquet(*folders)
        known = known.where(F.col("batch_id") != batch_id)
        if self.remember_days is not None:
            known = known.where(F.col("day") >= int(self.clock().timestamp()) // _DAY - self.remember_days)
        return asked.join(known.select("bucket", "message_id"), ["bucket", "message_id"], "left_semi").select("message_id")

    def _note_seen(self, spark: SparkSession, handled: DataFrame, batch_id: int) -> None:
        day = int(self.clock().timestamp()) // _DAY
        rows = handled.select("message_id", F.lit(batch_id).cast("bigint").alias("batch_id"), _bucket("message_id"), F.lit(day).alias("day"))
        rows.repartition("bucket").write.mode("append").partitionBy("bucket", "day").parquet(f"{self.state}/seen")

    def _hours(self, spark: SparkSession) -> list[int]:
        """The hours for which messages wait, up to the present one."""
        present = int(self.clock().timestamp()) // _HOUR
        listed = (n.removeprefix("due_hour=") for n in storage.child_names(spark, f"{self.state}/delayed"))
        return [int(h) for h in listed if h.lstrip("-").isdigit() and int(h) <= present]

    def _waiting(self, spark: SparkSession, hours: Sequence[int]) -> DataFrame:
        table = f"{self.state}/delayed"
        return spark.read.schema(DELAYED_SCHEMA).option("basePath", table).parquet(*(f"{table}/due_hour={h}" for h in hours))

    def _due(self, spark: SparkSession, batch_id: int) -> DataFrame | None:
        """Delayed messages whose time has come and that have not come back yet, under their new ids. Only hours that have come are read."""
        hours = self._hours(spark)
        if not hours:
            return None
        back = self._waiting(spark, hours).where((F.col("due_at") <= _at(self.clock())) & (F.col("batch_id") != batch_id))
        back = back.withColumn("message_id", F.col("requeue_id")).withColumn("delay_count", F.coalesce("delay_count", F.lit(0)) + 1)
        back = back.select(*T.StructType.fromDDL(MESSAGE_SCHEMA).names)
        return back.join(self.seen(spark, back, batch_id), "message_id", "left_anti")

    def _note_delayed(self, spark: SparkSession, handled: DataFrame, batch_id: int) -> None:
        rows = handled.where(F.col("outcome") == DELAY)
        hour = F.floor(F.unix_seconds("due_at") / _HOUR).alias("due_hour")
        number = F.lit(batch_id).cast("bigint").alias("batch_id")
        rows = rows.select(*T.StructType.fromDDL(MESSAGE_SCHEMA).names, "requeue_id", "due_at", hour, number)
        rows.repartition("due_hour").write.mode("append").partitionBy("due_hour", "batch_id").parquet(f"{self.state}/delayed")

    def _drop_attempt(self, spark: SparkSession, batch_id: int) -> None:
        """Delete the delayed messages that this batch noted when it ran before."""
        for hour in storage.child_names(spark, f"{self.state}/delayed"):
            folder = f"{self.state}/delayed/{hour}/batch_id={batch_id}"
            if hour.startswith("due_hour=") and storage.exists(spark, folder):
                storage.remove(spark, folder)

    def _drop_hours(self, spark: SparkSession, batch_id: int) -> None:
        """Delete past hours whose messages have all come back in batches before this one, which are finished."""
        past = [h for h in self._hours(spark) if h < int(self.clock().timestamp()) // _HOUR]
        if not past:
            return
        rows = self._waiting(spark, past).select(F.col("requeue_id").alias("message_id"), "due_hour")
        left = rows.join(self.seen(spark, rows, batch_id), "message_id", "left_anti")
        waiting = {r[0] for r in left.select("due_hour").distinct().collect()}
        for hour in set(past) - waiting:
            storage.remove(spark, f"{self.state}/delayed/due_hour={hour}")

    # handling

    def _handle(self, batch: DataFrame, batch_id: int, settled: bool) -> None:
        """``settled`` tells that all earlier batches are finished, so that what they have handled can leave the tables.

        A micro-batch comes in a session of the stream, whose plans are not adaptive and have as many tasks as the state store has parts. So its rows are
        written, and what follows runs in the session that started the stream.
        """
        spark, now = self._session or batch.sparkSession, _at(self.clock())
        names = T.StructType.fromDDL(MESSAGE_SCHEMA).names
        self._drop_attempt(spark, batch_id)
        if settled:
            self._drop_hours(spark, batch_id)
        work = scratch_path(spark, "batch")
        try:
            todo = _written(spark, batch.select(*names), f"{work}/arrived")
            back = self._due(spark, batch_id)
            if back is not None:
                todo = todo.unionByName(back)
            todo = todo.dropDuplicates(["message_id"]).join(self.seen(spark, todo, batch_id), "message_id", "left_anti")
            # handled several times below; the copy keeps all of them alike
            self._settle(spark, _written(spark, classify(todo, self.environments), f"{work}/handled"), batch_id, now)
        finally:
            storage.remove(spark, work)

    def _settle(self, spark: SparkSession, handled: DataFrame, batch_id: int, now: Column) -> None:
        """Load what is to be loaded, and write down the outcomes."""
        result = self._ingest(handled)
        count = F.coalesce("delay_count", F.lit(0))
        wait = F.make_dt_interval(secs=F.col("delay_seconds").cast("decimal(18,6)"))
        is_delay = F.col("outcome") == DELAY
        result = result.withColumn("due_at", F.when(is_delay, now + wait))
        result = result.withColumn(
            "requeue_id", F.when(is_delay, F.concat_ws("-", "message_id", (count + 1).cast("string")))
        )
        columns = [c for c in T.StructType.fromDDL(OUTCOME_SCHEMA).names if c != "batch_id"]
        target = f"{self.outcomes}/batch_id={batch_id}"
        result.select(*columns).write.mode("overwrite").partitionBy("outcome").parquet(target)
        self._note_delayed(spark, result, batch_id)
        self._note_seen(spark, handled, batch_id)

    def _ingest(self, handled: DataFrame) -> DataFrame:
        """Run the callback and turn what failed into delays or dead letters."""
        to_load = handled.where(F.col("outcome") == INGEST)
        if to_load.isEmpty():
            return handled
        loading = F.col("outcome") == INGEST
        try:
            failed = self.ingest(to_load)
        except SpecsUnavailable as error:
            retry = retry_outcome(F.coalesce("delay_count", F.lit(0)))
            return (
                handled.withColumn("reason", F.when(loading, F.lit(str(error))).otherwise(F.col("reason")))
                .withColumn("delay_seconds", F.when(loading, F.lit(SPEC_WAIT_SECONDS)).otherwise(F.col("delay_seconds")))
                .withColumn("outcome", F.when(loading, retry).otherwise(F.col("outcome")))
            )
        if failed is None:
            return handled
        marked = handled.join(failed.select("message_id", F.col("error").alias("_error")), "message_id", "left")
        hit = F.col("_error").isNotNull()
        return (
            marked.withColumn("outcome", F.when(hit, F.lit(DEAD_LETTER)).otherwise(F.col("outcome")))
            .withColumn("reason", F.when(hit, F.col("_error")).otherwise(F.col("reason")))
            .drop("_error")
        )


def _written(spark: SparkSession, rows: DataFrame, path: str) -> DataFrame:
    """The rows, from a folder, in this session."""
    rows.write.parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def _at(moment: datetime) -> Column:
    return F.lit(moment).cast("timestamp")


def _bucket(column: str) -> Column:
    return F.pmod(F.xxhash64(column), F.lit(BUCKETS)).cast("int").alias("bucket")
