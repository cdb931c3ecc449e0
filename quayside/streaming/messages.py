"""What a file-arrival message says and what is to be done with it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.functions.paths import blob_container, blob_subject
from quayside.operators.routing import first_environment

MESSAGE_SCHEMA = (
    "message_id string, enqueued timestamp, body string, copy_status string, "
    "metadata map<string,string>, delay_count int"
)
BODY_SCHEMA = "topic string, subject string, eventType string, data struct<api:string>"

# fixed values: event names, waiting times, and the envelope older senders put around the body
CREATED_EVENT = "Microsoft.Storage.BlobCreated"
CREATE_API, COPY_API = "CreateFile", "CopyBlob"
COPY_WAIT_SECONDS = 300
SPEC_WAIT_SECONDS = 120
SPEC_RETRIES = 3
ENVELOPE = r"^@\x06string\x083http://schemas\.microsoft\.com/2003/10/Serialization/[^{]*|\x01"
ENVELOPE_SHAPE = r"(?s)^@\x06.*\x01$"

INGEST, IGNORE, DELAY, DEAD_LETTER = "ingest", "ignore", "delay", "dead_letter"


def parse_body(body: Column) -> Column:
    """The event as a struct, or null when a required field is missing."""
    bare = F.when(body.rlike(ENVELOPE_SHAPE), F.regexp_replace(body, ENVELOPE, ""))
    read = F.array(F.from_json(body, BODY_SCHEMA), F.from_json(bare, BODY_SCHEMA))
    return F.get(F.filter(read, _is_complete), F.lit(0))


def _is_complete(event: Column) -> Column:
    whole = event["data"]["api"].isNotNull()
    for name in ("topic", "subject", "eventType"):
        whole = whole & event[name].isNotNull()
    return whole


def correlation_id(metadata: Column, message_id: Column) -> Column:
    """The metadata value under any spelling of the key, else the message id."""
    named = F.map_filter(metadata, lambda k, v: F.lower(k) == F.lit("correlationid"))
    return F.coalesce(F.get(F.map_values(named), F.lit(0)), message_id)


def classify(messages: DataFrame, environments: Sequence[tuple[str, str]]) -> DataFrame:
    """Add outcome, reason, delay and what is needed to load the file.

    ``environments`` are (name, account) pairs; the account is sought in the topic.
    """
    event = F.col("event")
    parsed = messages.withColumn("event", parse_body(F.col("body")))
    parsed = parsed.withColumn("environment", first_environment(event["topic"], environments, ignore_case=True))
    parsed = parsed.withColumn("container", blob_container(event["subject"]))
    status = F.lower("copy_status")
    is_copy = event["data"]["api"] == COPY_API
    unhandled = F.concat(F.lit("not an event of a new file: "), event["eventType"])

    rules = [
        (event.isNull(), DEAD_LETTER, F.lit("unparsable message")),
        (F.col("environment").isNull(), IGNORE, F.lit("no environment for topic")),
        (event["eventType"] != CREATED_EVENT, DEAD_LETTER, unhandled),
        (event["data"]["api"] == CREATE_API, IGNORE, F.lit("file not written yet")),
        (F.col("container").isNull(), IGNORE, F.lit("no container in subject")),
        (is_copy & (status == "pending"), DELAY, F.lit("copy pending")),
        (is_copy & status.isin("aborted", "failed"), IGNORE, F.concat(F.lit("copy "), status)),
    ]
    outcome, reason = F.lit(INGEST), F.lit(None).cast("string")
    for condition, result, why in reversed(rules):
        outcome = F.when(condition, F.lit(result)).otherwise(outcome)
        reason = F.when(condition, why).otherwise(reason)
    decided = parsed.withColumn("outcome", outcome).withColumn("reason", reason)
    return decided.select(
        *messages.columns,
        "environment",
        "container",
        event["subject"].alias("full_subject"),
        blob_subject(event["subject"]).alias("subject"),
        correlation_id(F.col("metadata"), F.col("message_id")).alias("correlation_id"),
        "outcome",
        "reason",
        F.when(F.col("outcome") == DELAY, F.lit(COPY_WAIT_SECONDS)).alias("delay_seconds"),
    )


def retry_outcome(delay_count: Column) -> Column:
    """Outcome when the load specs cannot be had: wait, or give up after some tries."""
    return F.when(delay_count <= SPEC_RETRIES, F.lit(DELAY)).otherwise(F.lit(DEAD_LETTER))
