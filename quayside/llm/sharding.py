"""Sharding by a lookup table that shards fill in turn.

Each shard prefers the slots of a prime-sized table in an order of its own: it begins at one slot
and goes on by a fixed step, which reaches every slot as the size is prime. Shards
take turns and claim their next preferred free slot until none is free. So shards own equal numbers of
slots, give or take one, and when a shard comes or goes few slots change hands besides its own.
A row's slot is a hash of its key, modulo the table's size.

The table is a few thousand numbers however many rows there are; as a constant of the query it goes to
every task, and a row is placed by one look-up. Nothing is shuffled.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.llm.registry import query

#: A prime, some hundred times the number of shards: slots of two shards differ by one at most.
SLOTS = 8191
SHARDS = tuple(f"shard-{i:02d}" for i in range(64))


def _number(text: str) -> int:
    return int(hashlib.md5(text.encode()).hexdigest()[:15], 16)


def fill(shards: Sequence[str], slots: int = SLOTS) -> np.ndarray:
    """The shard number of every slot. Shards are told apart by name; ``slots`` must be prime and no less than the shards."""
    if len(set(shards)) != len(shards) or not 0 < len(shards) <= slots:
        raise ValueError("shards must have different names and not outnumber the slots")
    if slots < 2 or any(slots % d == 0 for d in range(2, int(slots**0.5) + 1)):
        raise ValueError(f"{slots} is not prime")
    at = [_number(f"begin {s}") % slots for s in shards]
    step = [_number(f"step {s}") % (slots - 1) + 1 for s in shards]
    table = np.full(slots, -1, np.int64)
    free = slots
    while free:
        for shard in range(len(shards)):
            while table[at[shard]] >= 0:
                at[shard] = (at[shard] + step[shard]) % slots
            table[at[shard]] = shard
            free -= 1
            if not free:
                break
    return table


def slot(key: Column, slots: int = SLOTS) -> Column:
    """The slot of a key: fifteen hexadecimal digits of the MD5 of its text, modulo the slots. Null counts as empty text."""
    digits = F.substring(F.md5(F.coalesce(key.cast("string"), F.lit("")).cast("binary")), 1, 15)
    return F.pmod(F.conv(digits, 16, 10).cast("bigint"), F.lit(slots))


def assign(df: DataFrame, key: Column, shards: Sequence[str] = SHARDS, slots: int = SLOTS, to: str = "shard") -> DataFrame:
    """Add the name of each row's shard.

    Equal keys share a shard, so repeated rows stay together; rows whose keys are null or empty
    share one. Give a key that tells rows apart, not a source or a language, and no shard gets more than its
    part. A column already called ``to`` is replaced; an empty table stays empty.
    """
    table = F.split(F.lit(",".join(str(i) for i in fill(shards, slots))), ",")
    number = F.element_at(table, (slot(key, slots) + 1).cast("int")).cast("int")
    return df.withColumn(to, F.element_at(F.array(*map(F.lit, shards)), number + 1))


def write_shards(df: DataFrame, path: str, key: Column, shards: Sequence[str] = SHARDS, slots: int = SLOTS) -> None:
    """Write each shard to a folder of its own, ``shard=<name>``, in one pass without a shuffle."""
    assign(df, key, shards, slots).write.mode("overwrite").partitionBy("shard").parquet(path)


ORACLE = f"""
with slots as (select unnest({[int(i) for i in fill(SHARDS)]}) as shard, unnest(range({SLOTS})) as slot)
select doc_id, d.slot, format('shard-{{:02d}}', shard) as shard
from (select doc_id, ('0x' || substr(md5(coalesce(cast(doc_id as varchar), '')), 1, 15))::bigint % {SLOTS} as slot from documents) d
join slots using (slot)
"""


@query(ORACLE)
def op6_shard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The slot and the shard of every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id")
    return assign(docs.withColumn("slot", slot(F.col("doc_id"))), F.col("doc_id"))
