"""Joining a large frame to a lookup table whose size is measured first."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.functions.names import quoted

BROADCAST_BYTES = 64 << 20
SALTS = 32


def row_bytes() -> Column:
    """Aggregate: approximate size of all rows, from their JSON text."""
    return F.coalesce(F.sum(F.length(F.to_json(F.struct("*")))), F.lit(0))


def measured_bytes(df: DataFrame) -> int:
    return df.agg(row_bytes()).first()[0]


def lookup(
    facts: DataFrame,
    table: DataFrame,
    on: list[str],
    salt: Column | None = None,
    size: int | None = None,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Left join to ``table``, which has unique keys and is cheap to read twice.

    A table measured below ``broadcast_bytes`` is broadcast and ``facts`` is not
    shuffled. A larger one is repeated once per salt and joined on key and salt,
    so rows of one hot key spread over ``SALTS`` tasks. The salt must come out the
    same when a lost task runs again: it defaults to a hash of the row and its
    partition number. ``size`` gives a bound measured before.
    """
    if (measured_bytes(table) if size is None else size) <= broadcast_bytes:
        return facts.join(F.broadcast(table), on, "left")
    if salt is None:
        hashed = [F.col(quoted(f.name)) for f in facts.schema if "map<" not in f.dataType.simpleString()]
        salt = F.xxhash64(F.spark_partition_id(), *hashed)
    spread = table.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salted = facts.withColumn("_salt", F.pmod(salt, F.lit(SALTS)).cast("int"))
    return salted.join(spread, [*on, "_salt"], "left").drop("_salt")
