"""Arrival messages made from events: each event tells of one file."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside import SOURCE_NAME
from quayside.examples import query
from quayside.examples.landing import STAMP, file_count, table
from quayside.examples.text import ORDER_FILES, land_orders_csv
from quayside.functions import paths
from quayside.plans.load import LoadSpec
from quayside.session import scratch_path
from quayside.sinks import storage
from quayside.sinks.targets import SnapshotFiles
from quayside.sources.delimited import Delimited
from quayside.sources.frames import Files
from quayside.sources.manifest import list_files
from quayside.streaming.arrivals import Arrivals
from quayside.streaming.ingest import MessageLoader
from quayside.streaming.messages import MESSAGE_SCHEMA, classify, retry_outcome

ENVIRONMENTS = [("prod", "LakeProd"), ("test", "laketest")]


def _pick(index: Column, values: list) -> Column:
    return F.get(F.array(*[F.lit(v) for v in values]), F.pmod(index, F.lit(len(values))).cast("int"))


def _messages(events: DataFrame) -> DataFrame:
    n = F.col("event_id")
    subject = F.concat(
        F.when(n % 13 == 0, F.lit("/other/")).otherwise(F.lit("/blobServices/default/containers/raw/blobs/")),
        F.lit("in/"), n.cast("string"), F.lit(".csv"),
    )
    event = F.struct(
        _pick(n, ["/accounts/lakeprod", "/accounts/laketest", "/accounts/elsewhere"]).alias("topic"),
        subject.alias("subject"),
        F.when(n % 11 == 0, "Microsoft.Storage.BlobDeleted").otherwise("Microsoft.Storage.BlobCreated").alias("eventType"),
        F.struct(_pick(n, ["PutBlob", "CreateFile", "CopyBlob", "FlushWithClose"]).alias("api")).alias("data"),
    )
    body = F.to_json(event)
    wrapped = F.concat(
        F.lit("@\x06string\x083http://schemas.microsoft.com/2003/10/Serialization/??"), body, F.lit("\x01")
    )
    return events.select(
        n.cast("string").alias("message_id"),
        F.col("ts").cast("timestamp").alias("enqueued"),
        F.when(n % 17 == 0, F.lit("{broken")).when(n % 19 == 0, wrapped).otherwise(body).alias("body"),
        _pick(F.floor(n / 4), ["pending", "success", "aborted", "failed", None]).alias("copy_status"),
        F.when(n % 2 == 0, F.create_map(F.lit("CorrelationId"), F.concat(F.lit("c"), n.cast("string")))).alias("metadata"),
        F.lit(0).alias("delay_count"),
    )


_CLASSIFIED_SQL = """
    select cast(event_id as varchar) as message_id,
           case when event_id % 2 = 0 then 'c' else '' end || event_id as correlation_id,
           case when event_id % 17 = 0 then 'dead_letter'
                when event_id % 3 = 2 then 'ignore'
                when event_id % 11 = 0 then 'dead_letter'
                when event_id % 4 = 1 then 'ignore'
                when event_id % 13 = 0 then 'ignore'
                when event_id % 4 = 2 and (event_id // 4) % 5 = 0 then 'delay'
                when event_id % 4 = 2 and (event_id // 4) % 5 in (2, 3) then 'ignore'
                else 'ingest' end as outcome,
           case when event_id % 17 <> 0 then case event_id % 3 when 0 then 'prod' when 1 then 'test' end end as environment,
           case when event_id % 17 <> 0 and event_id % 13 <> 0 then 'raw' end as container
    from events"""


@query(_CLASSIFIED_SQL)
def classify_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    classified = classify(_messages(table(spark, sf_dir, "events")), ENVIRONMENTS)
    return classified.select("message_id", "correlation_id", "outcome", "environment", "container")


def _sent_twice(spark: SparkSession, sf_dir: str) -> tuple[Arrivals, str, int]:
    """A stream, its folder, and the number of message files there: every message twice."""
    events = table(spark, sf_dir, "events")
    files = file_count(events, "event_id")
    sent = _messages(events).select("*", F.explode(F.array(F.lit(0), F.lit(1))).alias("copy")).drop("copy")
    folder = scratch_path(spark, "stream")
    sent.repartition(files).write.json(f"{folder}/messages")
    arrivals = Arrivals(
        f"{folder}/outcomes",
        ENVIRONMENTS,
        ingest=lambda messages: None,
        clock=lambda: datetime(2024, 3, 1, tzinfo=timezone.utc),
    )
    return arrivals, folder, files


_OUTCOMES_SQL = f"""
    select outcome, environment, count(*) as messages from ({_CLASSIFIED_SQL}) group by outcome, environment"""


@query(_OUTCOMES_SQL)
def stream_idle_stop(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same messages through a stream that listens, and stops after two seconds without one."""
    arrivals, folder, files = _sent_twice(spark, sf_dir)
    arrivals.listen(spark, f"{folder}/messages", f"{folder}/checkpoint", max(1, files // 3), "500 milliseconds", timedelta(seconds=2))
    return arrivals.history(spark).groupBy("outcome", "environment").agg(F.count(F.lit(1)).alias("messages"))


@query(_OUTCOMES_SQL, name="stream_dedupe_outcomes")
def stream_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every message twice, in files the stream takes in several batches; each is handled once."""
    arrivals, folder, files = _sent_twice(spark, sf_dir)
    arrivals.run(spark, f"{folder}/messages", f"{folder}/checkpoint", files_per_batch=max(1, files // 3))
    return arrivals.history(spark).groupBy("outcome", "environment").agg(F.count(F.lit(1)).alias("messages"))


@query("""
    select event_id, case when event_id % 6 <= 3 then 'delay' else 'dead_letter' end as outcome from events""")
def retry_budget(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", retry_outcome(F.col("event_id") % 6).alias("outcome"))


_ARRIVED_SQL = f"""
    select cast(o_orderkey as varchar) as o_orderkey, '{STAMP}' as snapshot_date,
           1 + row_number() over (partition by o_orderkey % {ORDER_FILES} order by o_orderkey) as meta_source_line_number
    from orders"""


def _arrived(spark: SparkSession, sf_dir: str, again: bool = False) -> DataFrame:
    """Rows loaded from one message per landed order file, each sent twice; ``again`` runs one micro-batch twice."""
    landed = storage.qualified(spark, land_orders_csv(spark, sf_dir))
    root, folder = landed.rsplit("/", 1)
    path = paths.plain_path(F.col(SOURCE_NAME))
    subject = F.concat(F.lit("/blobServices/default/containers/raw/blobs"), F.substring(path, F.lit(len(root) + 1), F.length(path)))
    event = F.struct(
        F.lit("/accounts/lakeprod").alias("topic"),
        subject.alias("subject"),
        F.lit("Microsoft.Storage.BlobCreated").alias("eventType"),
        F.struct(F.lit("PutBlob").alias("api")).alias("data"),
    )
    messages = list_files(spark, Files([landed])).select(
        F.sha2(SOURCE_NAME, 256).alias("message_id"),
        F.col("modified").alias("enqueued"),
        F.to_json(event).alias("body"),
        F.explode(F.array(F.lit(0), F.lit(1))).alias("delay_count"),
    )
    work = scratch_path(spark, "arrival")
    messages.repartition(2, "delay_count").write.json(f"{work}/messages")
    target = SnapshotFiles(f"{work}/orders")
    spec = LoadSpec("orders", f"/raw/{folder}", "csv", Delimited("erp"), target)
    loader = MessageLoader(f"{root}{{subject}}", lambda: [spec], f"{work}/audit")
    arrivals = Arrivals(f"{work}/outcomes", ENVIRONMENTS, loader)
    if again:
        batch = spark.read.schema(MESSAGE_SCHEMA).json(f"{work}/messages")
        arrivals.process(batch, 0)
        arrivals.process(batch, 0)
    else:
        arrivals.run(spark, f"{work}/messages", f"{work}/checkpoint", 1)
    loaded = storage.read_table_files(spark, target.path({}))
    return loaded.select("o_orderkey", "snapshot_date", "meta_source_line_number")


@query(_ARRIVED_SQL)
def load_on_arrival(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One message per landed order file, each sent twice; the stream loads every file once."""
    return _arrived(spark, sf_dir)


@query(_ARRIVED_SQL)
def stream_replay_loads_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same messages as one micro-batch that runs twice."""
    return _arrived(spark, sf_dir, again=True)


@query(f"""
    with m as ({_CLASSIFIED_SQL})
    select outcome, count(*) as messages, count(distinct case when outcome = 'delay' then message_id end) as delayed
    from (select message_id, outcome from m union all select message_id || '-1', outcome from m where outcome = 'delay')
    group by outcome""")
def stream_delayed_return(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Delayed messages come back when the stream runs a day later, without a new message."""
    folder = scratch_path(spark, "delayed")
    events = table(spark, sf_dir, "events")
    _messages(events).repartition(file_count(events, "event_id")).write.json(f"{folder}/messages")
    for day in (1, 2):
        clock = datetime(2024, 3, day, tzinfo=timezone.utc)
        arrivals = Arrivals(f"{folder}/outcomes", ENVIRONMENTS, ingest=lambda messages: None, clock=lambda clock=clock: clock)
        arrivals.run(spark, f"{folder}/messages", f"{folder}/checkpoint")
    delayed = F.count_distinct(F.when(F.col("outcome") == "delay", F.col("message_id"))).alias("delayed")
    return arrivals.history(spark).groupBy("outcome").agg(F.count(F.lit(1)).alias("messages"), delayed)
