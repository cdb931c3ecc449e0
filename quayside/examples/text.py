"""Delimited and fixed-width text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside import LINE_NUMBER
from quayside.examples import query
from quayside.examples.landing import STAMP, file_count, files_sql, land_lines, placed, shard, table
from quayside.functions.text import line_breaks
from quayside.operators.numbering import exclusive_running_sum
from quayside.session import scratch_path
from quayside.sources.delimited import Delimited, DelimitedRecords, RecordType
from quayside.sources.fixed_width import FixedColumn, FixedType, FixedWidth, FixedWidthRecords
from quayside.sources.frames import Files

ORDER_FILES = files_sql("orders", "o_orderkey")
CUSTOMER_FILES = files_sql("customer", "c_custkey")
DOC_FILES = files_sql("documents", "doc_id", 50_000)


def order_text(orders: DataFrame) -> DataFrame:
    """Orders as text columns."""
    return orders.select(
        "o_orderkey",
        F.col("o_custkey").cast("string").alias("o_custkey"),
        "o_orderstatus",
        F.col("o_totalprice").cast("decimal(18,2)").cast("string").alias("o_totalprice"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("o_orderdate"),
        "o_orderpriority",
    )


def land_orders_csv(spark: SparkSession, sf_dir: str, stamp: str = STAMP) -> str:
    orders = table(spark, sf_dir, "orders")
    files = file_count(orders, "o_orderkey")
    folder = f"{scratch_path(spark, 'orders')}/snapshot_date={stamp}"
    rows = order_text(orders).withColumn("shard", shard("o_orderkey", files))
    placed(rows, files, ["o_orderkey"]).write.partitionBy("shard").option("header", True).csv(folder)
    return folder


@query(f"""
    select cast(o_orderkey as varchar) as o_orderkey, cast(o_custkey as varchar) as o_custkey, o_orderstatus,
           cast(cast(o_totalprice as decimal(18,2)) as varchar) as o_totalprice,
           strftime(o_orderdate, '%Y-%m-%d') as o_orderdate, o_orderpriority,
           1 + row_number() over (partition by o_orderkey % {ORDER_FILES} order by o_orderkey)
             as meta_source_line_number
    from orders""")
def csv_scan_line_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    frame = Delimited("erp").read(spark, Files([land_orders_csv(spark, sf_dir)]))[0]
    return frame.df.drop("meta_source_name")


@query(f"""
    select cast(c_custkey as varchar) as member_id, c_name as member_name, c_mktsegment as segment,
           4 + row_number() over (partition by c_custkey % {CUSTOMER_FILES} order by c_custkey)
             as meta_source_line_number
    from customer""")
def csv_skip_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = table(spark, sf_dir, "customer")
    files = file_count(customer, "c_custkey")
    rows = customer.select(
        shard("c_custkey", files),
        F.col("c_custkey").alias("at"),
        F.concat_ws(" | ", "c_custkey", "c_name", "c_mktsegment").alias("value"),
    )
    junk = ["exported for test", "", "rows follow | see below", "Id | Name | Segment"]
    heads = spark.range(files).select(
        F.col("id").cast("int").alias("shard"),
        F.posexplode(F.array(*map(F.lit, junk))).alias("at", "value"),
    )
    heads = heads.select("shard", (F.col("at") - len(junk)).cast("bigint").alias("at"), "value")
    folder = land_lines(heads.unionByName(rows), files, "skip", ["at"])
    source = Delimited("crm", "|", skip_lines=3, header_columns=["member_id", "member_name", "segment"])
    return source.read(spark, Files([folder]))[0].df.drop("meta_source_name")


@query(f"""
    select doc_id, 1 + row_number() over w
             + coalesce(sum(breaks) over (partition by shard order by doc_id
                          rows between unbounded preceding and 1 preceding), 0) as meta_source_line_number, letters
    from (select doc_id, doc_id % {DOC_FILES} as shard, md5(regexp_replace(coalesce(text, ''), '[ \\t\\n\\r\\f\\x0b]+', '', 'g')) as letters,
                 len(regexp_extract_all(text, '\\r\\n|\\r|\\n')) as breaks from documents)
    window w as (partition by shard order by doc_id)""")
def multiline_physical_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    files = file_count(documents, "doc_id", 50_000)
    folder = f"{scratch_path(spark, 'documents')}/snapshot_date={STAMP}"
    rows = documents.select("doc_id", "text", shard("doc_id", files))
    writer = placed(rows, files, ["doc_id"]).write.partitionBy("shard").options(
        header=True, quoteAll=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
    )
    writer.csv(folder)
    frame = Delimited("archive", multi_line=True, escape='"').read(spark, Files([folder]))[0]
    letters = F.md5(F.regexp_replace(F.coalesce("text", F.lit("")), r"[ \t\n\r\f\x0b]+", "")).alias("letters")
    return frame.df.select(F.col("doc_id").cast("bigint").alias("doc_id"), LINE_NUMBER, letters)


@query("""
    select doc_id, len(regexp_extract_all(text, '\\r\\n|\\r|\\n')) as breaks,
           coalesce(sum(len(regexp_extract_all(text, '\\r\\n|\\r|\\n'))) over (order by doc_id
             rows between unbounded preceding and 1 preceding), 0)::bigint as breaks_before
    from documents""")
def running_line_breaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = table(spark, sf_dir, "documents").select("doc_id", line_breaks([F.col("text")]).alias("breaks"))
    return exclusive_running_sum(counted, "breaks", "doc_id", "breaks_before")


def land_order_records(spark: SparkSession, sf_dir: str) -> str:
    """Files of order and line records, told apart by their first field."""
    orders = table(spark, sf_dir, "orders").select(F.lit("O"), "o_orderkey", "o_custkey", F.lit("unused"))
    lines = table(spark, sf_dir, "lineitem").select(F.lit("L"), "l_orderkey", "l_partkey", F.lit(""))
    both = orders.union(lines)
    folder = f"{scratch_path(spark, 'records')}/snapshot_date={STAMP}"
    both.select(F.concat_ws("|", *both.columns)).write.text(folder)
    return folder


@query("""
    select 'O' as tag, cast(o_orderkey as varchar) as k, cast(o_custkey as varchar) as v from orders
    union all select 'L', cast(l_orderkey as varchar), cast(l_partkey as varchar) from lineitem""")
def delimited_record_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order and line records in the same folder of files, split again by their tag."""
    folder = land_order_records(spark, sf_dir)
    types = [RecordType("header", "^O$", ["tag", "k", "customer"]), RecordType("detail", "^L$", ["tag", "k", "part"])]
    header, detail = DelimitedRecords("erp", "|", 1, types).read(spark, Files([folder]))
    whole = header.df.withColumnRenamed("customer", "v").unionByName(detail.df.withColumnRenamed("part", "v"))
    return whole.select("tag", "k", "v")


def land_customers_fixed(spark: SparkSession, sf_dir: str, stamp: str = STAMP) -> str:
    customer = table(spark, sf_dir, "customer")
    files = file_count(customer, "c_custkey")
    cents = F.round(F.col("c_acctbal") * 100).cast("bigint").cast("string")
    line = F.concat(
        F.lpad(F.col("c_custkey").cast("string"), 12, " "), F.rpad("c_name", 25, " "),
        F.rpad("c_mktsegment", 12, " "), F.lpad(cents, 14, " "),
    )
    lines = customer.select(shard("c_custkey", files), "c_custkey", line.alias("value"))
    return land_lines(lines, files, "customer", ["c_custkey"], stamp)


CUSTOMER_LAYOUT = FixedWidth(
    "crm",
    [FixedColumn("Cust Key", 12), FixedColumn("name", 25), FixedColumn("segment", 12), FixedColumn("Balance #", 14)],
)


@query(f"""
    select cast(c_custkey as varchar) as "Cust Key", c_name as name, c_mktsegment as segment,
           cast(cast(round(c_acctbal * 100) as bigint) as varchar) as "Balance #",
           row_number() over (partition by c_custkey % {CUSTOMER_FILES} order by c_custkey)
             as meta_source_line_number
    from customer""")
def fixed_width_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = Files([land_customers_fixed(spark, sf_dir)])
    return CUSTOMER_LAYOUT.read(spark, files)[0].df.drop("meta_source_name")


@query(f"""
    with lines as (
      select c_custkey as k, 'CU' as tag, c_name as name from customer
      union all select s_suppkey, 'SUP', s_name from supplier)
    select tag, cast(k as varchar) as key, name,
           row_number() over (partition by k % {CUSTOMER_FILES} order by k, tag) as meta_source_line_number
    from lines""")
def fixed_width_record_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = table(spark, sf_dir, "customer")
    files = file_count(customer, "c_custkey")
    both = customer.select(F.col("c_custkey").alias("k"), F.lit("CU").alias("tag"), F.col("c_name").alias("name"))
    both = both.union(table(spark, sf_dir, "supplier").select("s_suppkey", F.lit("SUP"), "s_name"))
    line = F.concat(F.rpad("tag", 4, " "), F.lpad(F.col("k").cast("string"), 12, " "), F.col("name"))
    folder = land_lines(both.select(shard("k", files), "k", "tag", line.alias("value")), files, "tagged", ["k", "tag"])
    columns = [FixedColumn("tag", 4), FixedColumn("key", 12), FixedColumn("name", 40)]
    types = [FixedType("customer", "^CU$", columns), FixedType("supplier", "^SUP$", columns, tag_width=3)]
    customers, suppliers = FixedWidthRecords("crm", 1, 2, types).read(spark, Files([folder]))
    return customers.df.unionByName(suppliers.df).drop("meta_source_name")
