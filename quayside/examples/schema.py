"""Names, types and nesting."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.examples import query
from quayside.examples.landing import table
from quayside.operators.flatten import FlattenTarget, flatten_all, flatten_targets
from quayside.operators.schema import cast_leaves_to_string, clean_columns


@query("""
    select l_orderkey as order_num, l_partkey as part_id, l_linenumber as line_no,
           l_quantity as qty, l_discount as disc_pct, l_returnflag as flag
    from lineitem""")
def clean_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    dirty = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("Order #"),
        F.col("l_partkey").alias("  Part.Id "),
        F.col("l_linenumber").alias("LINE__NO_"),
        F.col("l_quantity").alias("_Qty"),
        F.col("l_discount").alias("Disc %"),
        F.col("l_returnflag").alias("FLAG"),
    )
    return clean_columns(dirty)


@query("""
    select cast(event_id as varchar) as event_id, cast(user_id as varchar) as user, event_type as kind,
           cast(user_id as varchar) || ',' || cast(event_id as varchar) as ids
    from events""")
def cast_leaves(spark: SparkSession, sf_dir: str) -> DataFrame:
    nested = table(spark, sf_dir, "events").select(
        F.col("event_id").alias("Event Id"),
        F.struct(
            F.struct(F.col("user_id").alias("User #"), F.col("event_type").alias("Kind")).alias("Who"),
            F.array(F.array("user_id", "event_id")).alias("Ids"),
        ).alias("Body"),
    )
    typed = cast_leaves_to_string(nested)
    return typed.select(
        "event_id",
        F.col("body.who.user_num").alias("user"),
        F.col("body.who.kind").alias("kind"),
        F.concat_ws(",", F.flatten("body.ids")).alias("ids"),
    )


@query("""
    select doc_id, lang, about_source, about_size,
           unnest(case when length(text) > 0 then string_split(text, chr(10)) else [null] end) as lines
    from (select doc_id, lang, source as about_source, n_chars as about_size, text from documents)""", name="flatten_all")
def flatten_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    nested = table(spark, sf_dir, "documents").select(
        "doc_id",
        F.when(F.length("text") > 0, F.array(F.split("text", "\n", -1))).alias("lines"),
        "lang",
        F.struct("source", F.col("n_chars").alias("size")).alias("about"),
    )
    return flatten_all(nested)


@query("""
    select c.conv_id, c.turn, c.role, unnest([c.role, c.text]) as parts from conversations c""")
def flatten_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    nested = table(spark, sf_dir, "conversations").select(
        "conv_id", "turn", "role", F.array("role", "text").alias("parts")
    )
    return flatten_targets(nested, [FlattenTarget("PARTS")])


@query("""
    select source as about_source, n_chars as about_size from documents""")
def flatten_target_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    nested = table(spark, sf_dir, "documents").select(
        "doc_id", F.struct("source", F.col("n_chars").alias("size")).alias("about")
    )
    return flatten_targets(nested, [FlattenTarget("about", include_others=False)])
