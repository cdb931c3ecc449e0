"""Pairs of near members of buckets, without all pairs of a bucket."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.session import scratch_path, spent_shuffles
from quayside.sinks import storage

#: Leaders that a bucket has in each round but the first.
LEADERS = 64


def written(df: DataFrame, label: str) -> DataFrame:
    """The rows, from the shared folder: the plan so far ends here, with its shuffle files, and a lost executor costs nothing."""
    path = scratch_path(df.sparkSession, label)
    with spent_shuffles(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def discard(df: DataFrame) -> None:
    """Delete what ``written`` gave, when no plan reads it any more."""
    storage.remove(df.sparkSession, df.inputFiles()[0].rsplit("/", 1)[0])


def name(a: Column | str, b: Column | str) -> Column:
    """A node of two numbers as text."""
    return F.concat_ws(" ", F.hex(a), F.hex(b))


def near_pairs(members: DataFrame, near: Callable[[DataFrame], DataFrame], first: int = 1) -> DataFrame:
    """Pairs (k1, k2, l1, l2) of near members, from rows (bucket, k1, k2): a member has two numbers.

    Each bucket has leaders: ``first`` of them in the first round and up to ``LEADERS`` in the next. Those lead that meet most others in
    all their buckets, so the text that many copies were made from leads all of them. All members of a bucket are compared with its leaders, unless
    they are in one group already; ``near`` keeps the pairs that are near. After the first round members of a bucket's largest
    group do not lead, and a bucket is done when all others have led it: of any two members, they are in one group or one has
    led. So a round has as many pairs as members, times a constant, and a bucket is never gathered in one task.
    """
    from quayside.llm.components import components

    sizes = members.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1")
    joined = members.join(sizes, "bucket")
    degrees = joined.groupBy("k1", "k2").agg(F.sum("n").alias("degree"))
    rows = joined.drop("n").join(degrees, ["k1", "k2"]).withColumns({"group": name("k1", "k2"), "led": F.lit(False), "main": F.lit("")})
    rows, parts, found = written(rows, "members"), first, None
    last = rows
    may_lead = ~F.col("led") & (F.col("group") != F.col("main"))
    while True:
        best = rows.where(may_lead).groupBy("bucket", F.pmod(F.xxhash64("k1", "k2"), F.lit(parts)).alias("part")).agg(F.max(F.struct("degree", "k1", "k2", "group")).alias("x"))
        leaders = written(best.select("bucket", F.col("x.k1").alias("l1"), F.col("x.k2").alias("l2"), F.col("x.group").alias("leader_group")), "leaders")
        met = rows.join(leaders, "bucket").where(F.col("group") != F.col("leader_group"))
        # two leaders meet twice, and are compared once
        first_one = F.struct("k1", "k2") <= F.struct("l1", "l2")
        ends = [F.when(first_one, F.col(x)).otherwise(F.col(y)).alias(x) for x, y in (("k1", "l1"), ("k2", "l2"), ("l1", "k1"), ("l2", "k2"))]
        pairs = written(near(met.select(*ends).distinct()), "near")
        found = pairs if found is None else found.unionByName(pairs)
        groups = components(found.select(name("k1", "k2").alias("a"), name("l1", "l2").alias("b")), "a", "b")
        done = leaders.select("bucket", F.col("l1").alias("k1"), F.col("l2").alias("k2"), F.lit(True).alias("leads"))
        rows = rows.withColumn("node", name("k1", "k2")).join(groups, "node", "left").withColumn("group", F.coalesce("component", "node")).drop("node", "component", "main")
        rows = rows.join(done, ["bucket", "k1", "k2"], "left").withColumn("led", F.col("led") | F.coalesce("leads", F.lit(False))).drop("leads")
        grouped = written(rows, "grouped")
        for read in (groups, leaders, last):
            discard(read)
        rows = grouped
        shares = rows.groupBy("bucket", "group").agg(F.count("*").alias("n"), F.count_if(~F.col("led")).alias("new"))
        largest = shares.groupBy("bucket").agg(F.max(F.struct("n", "new", "group")).alias("x"), F.sum("new").alias("new"))
        # some member outside the largest group has not led
        largest = largest.where("new > x.new").select("bucket", F.col("x.group").alias("main"))
        rows = last = written(rows.join(largest, "bucket"), "waiting")
        discard(grouped)
        if rows.isEmpty():
            discard(rows)
            return found.distinct()
        parts = LEADERS
