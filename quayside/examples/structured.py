"""JSON, XML, Parquet, workbooks and the file list."""

from __future__ import annotations

import bz2
import io
import zipfile
from collections.abc import Iterable
from xml.sax.saxutils import escape

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside import SOURCE_NAME
from quayside.examples import query
from quayside.examples.landing import file_count, files_sql, land_lines, shard, table
from quayside.examples.text import ORDER_FILES, land_orders_csv
from quayside.functions.paths import extension
from quayside.session import checkpoint, scratch_path
from quayside.sources.frames import Files
from quayside.sources.manifest import list_files
from quayside.sources.structured import Json, Parquet, Xml, XmlRow
from quayside.sources.workbook import NamedRange, SheetOption, WorkbookRanges, WorkbookUnion, sheet_rows

ROWS_PER_BOOK = 2_000


@query("""
    select cast(event_id as varchar) as event_id, event_type, cast(user_id as varchar) as user_id,
           json_extract_string(props, '$.k') as props_k
    from events""")
def json_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    files = file_count(events, "event_id")
    body = F.to_json(
        F.struct("event_id", "event_type", "user_id", F.from_json("props", "k bigint").alias("props"))
    )
    folder = land_lines(events.select(shard("event_id", files), "event_id", body.alias("value")), files, "json", ["event_id"])
    frame = Json("web", flatten=True).read(spark, Files([folder]))[0]
    return frame.df.drop(SOURCE_NAME)


@query("""
    select cast(p_partkey as varchar) as id, p_name as name, p_brand as brand_name,
           cast(p_size as varchar) as brand_size
    from part""")
def xml_rowtag(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part")
    folder = scratch_path(spark, "xml")
    rows = part.select(
        F.col("p_partkey").alias("_id"),
        F.col("p_name").alias("name"),
        F.struct(F.col("p_brand").alias("name"), F.col("p_size").alias("size")).alias("brand"),
    )
    rows.write.format("xml").options(rootTag="parts", rowTag="part").save(folder)
    frame = Xml("erp", [XmlRow("part", flatten=True, split=True)]).read(spark, Files([folder]))[0]
    return frame.df.drop(SOURCE_NAME)


@query("""
    select cast(c_custkey as varchar) as id, c_name as text, null as plan_code from customer
    union all select cast(s_suppkey as varchar), null, s_name from supplier""")
def xml_two_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two kinds of elements in each file; leaves stay text without inference, and one kind is read by several tasks a file."""
    members = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("_id"), F.col("c_name").alias("_VALUE"))
    plans = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("_id"), F.col("s_name").alias("code"))
    files = file_count(members, "_id")
    elements = [rows.select(F.col("_id").alias("at"), F.to_xml(F.struct("*"), {"rowTag": tag}).alias("value")) for rows, tag in ((members, "member"), (plans, "plan"))]
    dealt = elements[0].union(elements[1]).select(shard("at", files), "at", "value")
    ends = spark.range(files).selectExpr("cast(id as int) as shard", "stack(2, -1L, '<all>', 9223372036854775807L, '</all>') as (at, value)")
    folder = land_lines(dealt.union(ends), files, "xml", ["at"])
    member, plan = Xml("erp", [XmlRow("member", split=True), XmlRow("plan", infer=False)]).read(spark, Files([folder]))
    return member.df.select("id", F.col("value").alias("text"), F.lit(None).cast("string").alias("plan_code")).union(
        plan.df.select("id", F.lit(None).cast("string"), "code")
    )


@query("""
    select c_custkey as id, c_name as full_name, c_nationkey as nation, c_acctbal as balance, c_mktsegment as segment
    from customer""")
def parquet_rename(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = Parquet("crm", ["id", "full_name", "nation", "balance", "segment"])
    return source.read(spark, Files([f"{sf_dir}/customer.parquet"]))[0].df.drop(SOURCE_NAME)


@query(f"""
    select 'shard=' || (o_orderkey % {ORDER_FILES}) as folder, 'csv' as extension, 1::bigint as files
    from orders group by 1""")
def file_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = F.col(SOURCE_NAME)
    listed = list_files(spark, Files([land_orders_csv(spark, sf_dir)]))
    folder = F.regexp_extract(path, "/(shard=[0-9]+)/", 1)
    return listed.groupBy(folder.alias("folder"), extension(path).alias("extension")).agg(
        F.count(F.lit(1)).alias("files")
    )


# fixed values: the parts of a minimal workbook
_MAIN = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
_RELS = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
_PACKAGE = "http://schemas.openxmlformats.org/package/2006/relationships"


def build_workbook(sheets: dict[str, Iterable[dict[str, object]]]) -> bytes:
    """A workbook from cells by address: numbers as numbers, text inline or as raw cell XML."""
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as book:
        listed = "".join(
            f'<sheet name="{escape(n)}" sheetId="{i}" r:id="rId{i}"/>' for i, n in enumerate(sheets, 1)
        )
        book.writestr("xl/workbook.xml", f'<workbook xmlns="{_MAIN}" xmlns:r="{_RELS}"><sheets>{listed}</sheets></workbook>')
        links = "".join(
            f'<Relationship Id="rId{i}" Type="{_RELS}/worksheet" Target="worksheets/sheet{i}.xml"/>'
            for i in range(1, len(sheets) + 1)
        )
        book.writestr("xl/_rels/workbook.xml.rels", f'<Relationships xmlns="{_PACKAGE}">{links}</Relationships>')
        for i, rows in enumerate(sheets.values(), 1):
            body = "".join(_row_xml(r) for r in rows)
            book.writestr(
                f"xl/worksheets/sheet{i}.xml",
                f'<worksheet xmlns="{_MAIN}"><sheetData>{body}</sheetData></worksheet>',
            )
    return out.getvalue()


def _row_xml(cells: dict[str, object]) -> str:
    number = "".join(c for c in next(iter(cells)) if c.isdigit())
    return f'<row r="{number}">' + "".join(_cell_xml(a, v) for a, v in cells.items()) + "</row>"


def _cell_xml(address: str, value: object) -> str:
    if isinstance(value, int):
        return f'<c r="{address}"><v>{value}</v></c>'
    return f'<c r="{address}" t="inlineStr"><is><t>{escape(str(value))}</t></is></c>'


def _supplier_book(rows: pd.DataFrame) -> pd.DataFrame:
    book = int(rows["book"].iloc[0])
    head = {"B3": "Supplier", "C3": "Name", "E3": "Nation"}
    ordered = rows.sort_values("s_suppkey")
    body = [
        {f"A{n}": "x", f"B{n}": int(r.s_suppkey), f"C{n}": r.s_name, f"E{n}": int(r.s_nationkey)}
        for n, r in enumerate(ordered.itertuples(), 4)
    ]
    content = build_workbook({"Notes": [{"A1": "nothing here"}], "Data": [head, *body]})
    return pd.DataFrame({SOURCE_NAME: [f"book{book}.xlsx.bz2"], "content": [bz2.compress(content)]})


@query(f"""
    select 'book' || (s_suppkey // {ROWS_PER_BOOK}) || '.xlsx.bz2' as meta_source_name, cast(s_suppkey as varchar) as "Supplier",
           s_name as "Name", cast(s_nationkey as varchar) as "Nation"
    from supplier""")
def workbook_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    supplier = table(spark, sf_dir, "supplier")
    book = F.floor(F.col("s_suppkey") / ROWS_PER_BOOK).cast("bigint").alias("book")
    books = (
        supplier.select("s_suppkey", "s_name", "s_nationkey", book)
        .groupBy("book")
        .applyInPandas(_supplier_book, f"{SOURCE_NAME} string, content binary")
    )
    source = WorkbookRanges("crm", [NamedRange("suppliers", "B3", True, sheet="Data")])
    return source.extract(checkpoint(sheet_rows(books)))[0].df


def _customer_book(rows: pd.DataFrame) -> pd.DataFrame:
    book = int(rows["book"].iloc[0])
    sheets: dict[str, list] = {"Summary": [{"A1": "ignored"}]}
    for segment, part in rows.groupby("c_mktsegment"):
        part = part.sort_values("c_custkey")
        sheets[f"{segment} 2024"] = [{"A1": "Cust Key", "B1": "Name"}] + [
            {f"A{n}": int(r.c_custkey), f"B{n}": r.c_name} for n, r in enumerate(part.itertuples(), 2)
        ]
    return pd.DataFrame({SOURCE_NAME: [f"book{book}.xlsx"], "content": [build_workbook(sheets)]})


@query("""
    select cast(c_custkey as varchar) as cust_key, c_name as name,
           case when c_mktsegment = 'BUILDING' then 'construction' else c_mktsegment end as segment
    from customer""")
def workbook_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = table(spark, sf_dir, "customer")
    book = F.floor(F.col("c_custkey") / ROWS_PER_BOOK).cast("bigint").alias("book")
    books = (
        customer.select("c_custkey", "c_name", "c_mktsegment", book)
        .groupBy("book")
        .applyInPandas(_customer_book, f"{SOURCE_NAME} string, content binary")
    )
    options = [
        SheetOption("^BUILDING", "A1", True, custom_name="construction"),
        SheetOption(r"^(\w+) 2024$", "A1", True),
    ]
    source = WorkbookUnion("crm", "Segment", options)
    return source.extract(checkpoint(sheet_rows(books)))[0].df.drop(SOURCE_NAME)
