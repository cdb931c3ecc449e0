"""Stamps, templates, lineage ids, and finding the spec of a path."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.examples import query
from quayside.examples.landing import table
from quayside.functions import paths
from quayside.functions.text import sha1_base36
from quayside.operators.lookup import lookup
from quayside.operators.routing import first_environment, match_key, match_prefix, roll_up, unresolved_severity
from quayside.session import checkpoint

# host and path of a page, without scheme, query and fragment
_PAGE_PATH = "regexp_replace(regexp_replace(url, '^[a-z]+://', ''), '[?#].*$', '')"


def page_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", "url", F.expr(_PAGE_PATH).alias("path"))


@query("""
    with made as (
      select page_id, 'abfss://zone' || (page_id % 3) || '@store.example/in/' || page_id || '/snapshot_date=2023_01_02_03_04_05/'
               || case when page_id % 2 = 0 then 'x_2024_05_06_07_08_09.csv' else 'plain.v1.json' end as path from pages)
    select page_id, 'zone' || (page_id % 3) as container, '/in/' || page_id as short_subject,
           case when page_id % 2 = 0 then '2024_05_06_07_08_09' else '2023_01_02_03_04_05' end as snapshot,
           case when page_id % 2 = 0 then 'csv' else 'json' end as extension,
           case when page_id % 2 = 0 then 'x_2024_05_06_07_08_09' else 'plain.v1' end as base_name,
           case when page_id % 2 = 0 then timestamp '2024-05-06 07:08:09' else timestamp '2023-01-02 03:04:05' end
             as snapshot_time
    from made""")
def snapshot_from_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = table(spark, sf_dir, "pages").select(
        "page_id",
        F.concat(
            F.lit("abfss://zone"), (F.col("page_id") % 3).cast("string"), F.lit("@store.example/in/"),
            F.col("page_id").cast("string"), F.lit("/snapshot_date=2023_01_02_03_04_05/"),
            F.when(F.col("page_id") % 2 == 0, "x_2024_05_06_07_08_09.csv").otherwise("plain.v1.json"),
        ).alias("path"),
    )
    path = F.col("path")
    return made.select(
        "page_id",
        paths.store_container(path).alias("container"),
        paths.short_subject(paths.store_subject(path, ["@store.example"])).alias("short_subject"),
        paths.snapshot_required(path).alias("snapshot"),
        paths.extension(path).alias("extension"),
        paths.base_name(path).alias("base_name"),
        paths.snapshot_time(paths.snapshot_or_null(path)).cast("timestamp_ntz").alias("snapshot_time"),
    )


@query("""
    select c_custkey, c_mktsegment || '/n' || c_nationkey || '/' || c_mktsegment || '_{other}' as directory
    from customer""")
def token_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokens = F.create_map(
        F.lit("segment"), F.col("c_mktsegment"), F.lit("nation"), F.col("c_nationkey").cast("string")
    )
    template = F.lit("{segment}/n{nation}/{segment}_{other}")
    return table(spark, sf_dir, "customer").select("c_custkey", paths.fill_template(template, tokens).alias("directory"))


def _base36_sql() -> str:
    """SHA-1 to base 36 by repeated long division of five 32-bit words."""
    words = ", ".join(f"('0x' || substr(h, {1 + 8 * i}, 8))::bigint as w{i}" for i in range(5))
    steps, rest = [], "0"
    for i in range(5):
        whole = f"(({rest}) * 4294967296 + w{i})"
        steps.append(f"{whole} // 36 as w{i}")
        rest = f"{whole} % 36"
    digit = f"substr('0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ', ({rest})::int + 1, 1)"
    return f"""
    with recursive start as (
      select page_id, sha1(regexp_replace(regexp_extract(url, '([^/]*)$', 1), '[.][^.]*$', '')) as h from pages),
    turns as (
      select page_id, {words}, '' as id from start
      union all
      select page_id, {", ".join(steps)}, {digit} || id from turns where w0 + w1 + w2 + w3 + w4 > 0)
    select page_id, id as lineage_id from turns where w0 + w1 + w2 + w3 + w4 = 0"""


@query(_base36_sql())
def lineage_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return pages.select("page_id", sha1_base36(paths.base_name(F.col("url"))).alias("lineage_id"))


@query(f"""
    with p as (select page_id, split_part(url, '/', 3) as host, {_PAGE_PATH} as path,
                      case when page_id % 3 = 0 then 'csv' else 'json' end as extension from pages),
    k as (select host, extension, min(page_id) as first_page from p group by host, extension having min(page_id) % 2 = 0)
    select page_id, case when first_page is not null then host || '.' || extension || ' spec' end as spec
    from p left join k using (host, extension)""")
def spec_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Specs kept under (container, short subject, extension), looked up for each landed path."""
    host = F.substring_index("path", "/", 1)
    kind = F.when(F.col("page_id") % 3 == 0, "csv").otherwise("json")
    url = F.concat(F.lit("abfss://"), host, F.lit("@lake/in/snapshot_date=2024_01_01_00_00_00/p."), kind)
    landed = page_paths(spark, sf_dir).select("page_id", url.alias("url"))
    keyed = landed.select(
        "page_id",
        paths.store_container(F.col("url")).alias("container"),
        paths.short_subject(paths.store_subject(F.col("url"), ["@lake"])).alias("subject"),
        paths.extension(F.col("url")).alias("extension"),
    )
    key = ["container", "subject", "extension"]
    specs = keyed.groupBy(*key).agg(F.min("page_id").alias("first")).where(F.col("first") % 2 == 0)
    name = F.concat("container", F.lit("."), "extension", F.lit(" spec")).alias("spec")
    return match_key(keyed, checkpoint(specs.select(*key, name)), key, ["spec"]).select("page_id", "spec")


def _spec_table(pages: DataFrame) -> DataFrame:
    """A spec per host, and a deeper one per host and language for French and Spanish."""
    host = F.substring_index("path", "/", 1)
    folder = F.substring_index("path", "/", 2)
    deeper = pages.where(F.col("path").rlike("^[^/]+/(fr|es)/"))
    every = pages.select(host.alias("prefix")).union(deeper.select(folder.alias("prefix"))).distinct()
    return every.select("prefix", F.concat(F.lit("spec of "), "prefix").alias("spec"))


@query(f"""
    with p as (select page_id, {_PAGE_PATH} as path from pages),
    specs as (
      select distinct split_part(path, '/', 1) as prefix from p
      union select split_part(path, '/', 1) || '/' || split_part(path, '/', 2) from p
        where split_part(path, '/', 2) in ('fr', 'es') and split_part(path, '/', 3) is not null
          and regexp_matches(path, '^[^/]+/(fr|es)/'))
    select page_id, 'spec of ' || arg_max(prefix, length(prefix)) as spec
    from p join specs on path = prefix or starts_with(path, prefix || '/')
    group by page_id""")
def spec_longest_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = page_paths(spark, sf_dir)
    return match_prefix(pages, _spec_table(pages), "path", "prefix", ["spec"]).select("page_id", "spec")


@query(f"""
    with p as (select distinct {_PAGE_PATH} as path from pages),
    folders as (
      select distinct split_part(path, '/', 1) || '/' || split_part(path, '/', 2) as folder from p
        where regexp_matches(path, '^[^/]+/(fr|es)/')
      union select distinct split_part(path, '/', 1) from p where starts_with(path, 'blog.')),
    asked as (select path from p union select folder from folders)
    select distinct coalesce(best, path) as path from (
      select a.path, arg_min(folder, length(folder)) as best
      from asked a left join folders on a.path = folder or starts_with(a.path, folder || '/')
      group by a.path)""")
def rollup_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = page_paths(spark, sf_dir).select("path")
    deep = files.where(F.col("path").rlike("^[^/]+/(fr|es)/")).select(F.substring_index("path", "/", 2).alias("path"))
    top = files.where(F.startswith("path", F.lit("blog."))).select(F.substring_index("path", "/", 1).alias("path"))
    folders = deep.union(top).distinct().withColumn("is_folder", F.lit(True))
    return roll_up(files.distinct().withColumn("is_folder", F.lit(False)).union(folders))


ENVIRONMENTS = [("prod", "example.com"), ("stage", "blog."), ("test", "example.net")]


@query("""
    select page_id,
           case when contains(url, 'example.com') then 'prod' when contains(url, 'blog.') then 'stage'
                when contains(url, 'example.net') then 'test' end as environment,
           case when contains(url, 'example.com') or contains(url, 'blog.') or contains(url, 'example.net') then null
                when page_id % 2 = 0 then 'error' else 'warning' end as severity
    from pages""")
def route_environment(spark: SparkSession, sf_dir: str) -> DataFrame:
    routed = table(spark, sf_dir, "pages").withColumn("environment", first_environment(F.col("url"), ENVIRONMENTS))
    severity = unresolved_severity(F.col("environment"), F.col("page_id") % 2 == 0)
    return routed.select("page_id", "environment", severity.alias("severity"))
