"""Reports on the audit table and the message log."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quayside.operators.numbering import exclusive_running_sum

ERROR_TEXT = 250
TICK_SECONDS = 120


def written_targets(audit: DataFrame) -> DataFrame:
    """Distinct targets each load wrote: the view, else the table, else the path."""
    detail = F.col("detail.details")
    database = detail["hiveDatabase"]
    table = F.coalesce(detail["hiveViewName"], detail["hiveTableName"])
    target = F.when(database.isNotNull(), F.concat_ws(".", database, table))
    return (
        audit.where("status = 'SUCCESS'")
        .select("ingest_id", F.explode("ingested_details").alias("detail"))
        .select("ingest_id", F.coalesce(target, F.col("detail.ingested_path")).alias("target"))
        .distinct()
    )


def failure_digest(
    failures: DataFrame, group: Sequence[str] = (), subjects: int = 10, errors: int = 2
) -> DataFrame:
    """Per group: the first failed subjects and errors, and how many more there are.

    ``failures`` has ``subject`` and ``error``. Only the top rows of a group are
    collected; the ranking limit runs in each task before the shuffle.
    """
    by = list(group) or ["_all"]
    base = failures if group else failures.withColumn("_all", F.lit(1))
    order = Window.partitionBy(*by).orderBy("subject", "error")
    top = (
        base.withColumn("_rank", F.row_number().over(order))
        .where(F.col("_rank") <= max(subjects, errors))
        .groupBy(*by)
        .agg(F.array_sort(F.collect_list(F.struct("_rank", "subject", "error"))).alias("_top"))
    )
    total = base.groupBy(*by).agg(F.count(F.lit(1)).alias("failed"))

    def shortened(text):
        return F.when(F.length(text) > ERROR_TEXT, F.concat(F.left(text, F.lit(ERROR_TEXT - 3)), F.lit("..."))).otherwise(text)

    return total.join(top, by).select(
        *group,
        "failed",
        F.transform(F.slice("_top", 1, subjects), lambda r: r["subject"]).alias("subjects"),
        F.greatest(F.col("failed") - subjects, F.lit(0)).alias("more_subjects"),
        F.transform(F.slice("_top", 1, errors), lambda r: shortened(r["error"])).alias("errors"),
        F.greatest(F.col("failed") - errors, F.lit(0)).alias("more_errors"),
    )


def load_rate(finished: DataFrame, at: str) -> DataFrame:
    """Files done per two-minute tick, per minute, and in all up to then."""
    # counted from the epoch as written, whatever the session's time zone
    epoch = F.lit("1970-01-01").cast(dict(finished.dtypes)[at])
    tick = F.floor(F.timestamp_diff("SECOND", epoch, F.col(at)) / TICK_SECONDS).cast("long")
    ticks = finished.groupBy(tick.alias("tick")).agg(F.count(F.lit(1)).alias("files"))
    summed = exclusive_running_sum(ticks, "files", "tick", "_earlier")
    return summed.select(
        "tick",
        "files",
        F.floor(F.col("files") / 2).cast("long").alias("per_minute"),
        (F.col("_earlier") + F.col("files")).alias("done"),
    )


def last_messages(log: DataFrame, seen: str, count: int = 10) -> DataFrame:
    """The messages seen last."""
    return log.orderBy(F.col(seen).desc(), "message_id").limit(count)
