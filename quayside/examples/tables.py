"""Writing, merging, deleting, re-loading and reporting."""

from __future__ import annotations

import uuid
from datetime import datetime, timezone
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.examples import query
from quayside.examples.landing import STAMP, table
from quayside.examples.text import (
    CUSTOMER_FILES,
    CUSTOMER_LAYOUT,
    ORDER_FILES,
    land_customers_fixed,
    land_order_records,
    land_orders_csv,
)
from quayside.operators.lineage import Run
from quayside.operators.upsert import merge_by_key
from quayside.plans.load import Environment, LoadReport, LoadSpec, load
from quayside.plans.reports import failure_digest, last_messages, load_rate, written_targets
from quayside.session import scratch_path
from quayside.sinks import storage
from quayside.sinks.audit import read_audit
from quayside.sinks.targets import SAVE_MODES, HistoryTable, ManagedTable, SnapshotFiles
from quayside.sources.delimited import Delimited, DelimitedRecords, RecordType

DATABASE = "quayside_examples"
RUN = Run(datetime(2024, 6, 1, 12, 0, 0, tzinfo=timezone.utc), "loader", "rev1", "1.0")


def _fresh_name(label: str) -> str:
    return f"{label}_{uuid.uuid4().hex[:12]}"


def _events_by_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with a snapshot per day and the file each would have come from."""
    stamp = F.date_format("ts", "yyyy_MM_dd_00_00_00")
    return table(spark, sf_dir, "events").select(
        "event_id",
        "event_type",
        F.concat(F.lit("/landing/snapshot_date="), stamp, F.lit("/"), "event_type", F.lit(".json")).alias("meta_source_name"),
        stamp.alias("snapshot_date"),
    )


EVENT_ROWS = """select event_id, event_type, strftime(ts, '%Y_%m_%d_00_00_00') as snapshot_date from events"""


@query(f"""
    with e as ({EVENT_ROWS}) select * from e where snapshot_date = (select max(snapshot_date) from e)""")
def snapshot_write_current_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = HistoryTable(scratch_path(spark, "history"), "overwrite", database=DATABASE, table=_fresh_name("events"))
    target.write(_events_by_day(spark, sf_dir), {})
    return spark.table(target.names({})[0]).select("event_id", "event_type", "snapshot_date")


@query(f"""select * from ({EVENT_ROWS})""")
def snapshot_files_modes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Half the events appended, some days replaced with all their events, the other days ignored or appended."""
    directory = scratch_path(spark, "modes")
    events = _events_by_day(spark, sf_dir)
    even, replaced = F.col("event_id") % 2 == 0, F.col("snapshot_date") < "2024_01_10"
    SnapshotFiles(directory, "append").write(events.where(even), {})
    SnapshotFiles(directory, "overwrite").write(events.where(replaced), {})
    SnapshotFiles(directory, "ignore").write(events.withColumn("event_type", F.lit("lost")), {})
    SnapshotFiles(directory, "append").write(events.where(~even & ~replaced), {})
    return _read_events(spark, SnapshotFiles(directory).path({}))


@query(f"""select * from ({EVENT_ROWS})""")
def managed_table_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = ManagedTable(
        DATABASE, _fresh_name("events"), scratch_path(spark, "managed"), partition_columns=["event_type"]
    )
    events = _events_by_day(spark, sf_dir)
    early = F.col("event_id") % 2 == 0
    target.write(events.where(early).drop("meta_source_name"), {})
    target.write(events.where(~early), {})
    return spark.table(target.name({})).select("event_id", "event_type", "snapshot_date")


def _written_events(spark: SparkSession, sf_dir: str) -> tuple[SnapshotFiles, DataFrame, str]:
    target = SnapshotFiles(scratch_path(spark, "events"))
    events = _events_by_day(spark, sf_dir)
    target.write(events, {})
    return target, events, target.path({})


def _read_events(spark: SparkSession, path: str) -> DataFrame:
    return storage.read_table_files(spark, path).select("event_id", "event_type", "snapshot_date")


@query(f"""
    with e as ({EVENT_ROWS}) select * from e
    where not (event_type = 'click' and snapshot_date = '2024_01_03_00_00_00')""")
def delete_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    target, _, path = _written_events(spark, sf_dir)
    stamp = "2024_01_03_00_00_00"
    target.delete(spark, {}, stamp, f"/landing/snapshot_date={stamp}/click.json")
    return _read_events(spark, path)


@query(f"""
    with e as ({EVENT_ROWS}) select * from e
    where not (event_type in ('click', 'view') and snapshot_date = '2024_01_03_00_00_00')""")
def delete_file_managed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of two landed files deleted from a managed table at once: only data files that hold some are read and rewritten."""
    target = ManagedTable(DATABASE, _fresh_name("events"), scratch_path(spark, "managed"), partition_columns=["event_type"])
    target.write(_events_by_day(spark, sf_dir), {})
    stamp = "2024_01_03_00_00_00"
    target.delete(spark, {}, stamp, [f"/landing/snapshot_date={stamp}/{kind}.json" for kind in ("click", "view")])
    return spark.table(target.name({})).select("event_id", "event_type", "snapshot_date")


@query(f"""
    with e as ({EVENT_ROWS}) select * from e where snapshot_date <> '2024_01_03_00_00_00'""")
def delete_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    target, _, path = _written_events(spark, sf_dir)
    target.delete(spark, {}, "2024_01_03_00_00_00")
    return _read_events(spark, path)


@query(f"""
    with e as ({EVENT_ROWS}) select kind, event_id, event_type, snapshot_date
    from e, (values ('files'), ('history'), ('managed'), ('keyed')) k(kind) where event_id % 2 = 0""")
def delete_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events written to each kind of target, everything deleted, tables and views with it, and half the events written again."""
    events = _events_by_day(spark, sf_dir)
    work, name = scratch_path(spark, "all"), _fresh_name("events")
    targets = {
        "files": SnapshotFiles(f"{work}/files"),
        "history": HistoryTable(f"{work}/history", "append", database=DATABASE, table=name + "_h"),
        "managed": ManagedTable(DATABASE, name + "_m", f"{work}/managed"),
        "keyed": ManagedTable(DATABASE, name + "_k", f"{work}/keyed", keys=["event_id"]),
    }
    read = []
    for kind, target in targets.items():
        target.write(events, {})
        target.delete(spark, {})
        tables = target.names({}) if kind == "history" else [target.name({})] if kind != "files" else []
        left = [t for t in tables if spark.catalog.tableExists(t)] + [target.path({})] * storage.exists(spark, target.path({}))
        if left:
            raise AssertionError(f"{left} after everything was deleted")
        target.write(events.where("event_id % 2 = 0"), {})
        # the view shows the newest snapshot, its history table all of them
        rows = spark.table(tables[-1]) if tables else storage.read_table_files(spark, target.path({}))
        read.append(rows.select(F.lit(kind).alias("kind"), "event_id", "event_type", "snapshot_date"))
    return reduce(DataFrame.unionByName, read)


@query(f"""
    with e as ({EVENT_ROWS}) select snapshot_date, count(*) as events, 3::bigint as files from e group by snapshot_date having count(*) > 60""")
def written_file_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events written by three tasks: three files to each snapshot that has rows for all of them."""
    target = SnapshotFiles(scratch_path(spark, "counted"), num_files=3)
    target.write(_events_by_day(spark, sf_dir), {})
    rows = storage.read_table_files(spark, target.path({})).select("snapshot_date", F.col("_metadata.file_path").alias("file"))
    counted = rows.groupBy("snapshot_date").agg(F.count(F.lit(1)).alias("events"), F.count_distinct("file").alias("files"))
    return counted.where("events > 60")


def _orders_spec(spark: SparkSession, folder: str) -> LoadSpec:
    target = HistoryTable(scratch_path(spark, "orders"), "append", database=DATABASE, table=_fresh_name("orders"))
    root = storage.qualified(spark, folder.rsplit("/", 1)[0])
    return LoadSpec("orders", root, "csv", Delimited("erp"), target)


@query(f"""
    select cast(o_orderkey as varchar) as o_orderkey, o_orderpriority,
           1 + row_number() over (partition by o_orderkey % {ORDER_FILES} order by o_orderkey) as meta_source_line_number,
           'erp' as meta_source_system_name, '' as meta_source_offset, '2024_06_01_12_00_00' as meta_lineage_datetime,
           'loader' as meta_provenance_id, 'rev1' as meta_github_hash, '1.0' as meta_semver,
           '2024_06_01_12_00_00' as meta_provenance_datetime, '{STAMP}' as snapshot_date
    from orders""")
def load_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = land_orders_csv(spark, sf_dir)
    spec = _orders_spec(spark, folder)
    load(spark, [spec], [folder], RUN)
    return spark.table(spec.target.names({})[0]).select(
        "o_orderkey", "o_orderpriority", "meta_source_line_number", "meta_source_system_name", "meta_source_offset",
        "meta_lineage_datetime", "meta_provenance_id", "meta_github_hash", "meta_semver",
        "meta_provenance_datetime", "snapshot_date",
    )


@query(f"""
    with o as (select o_orderkey as k, case o_orderkey % 3 when 0 then 'prod' when 1 then 'test' end as environment from orders)
    select environment, cast(k as varchar) as k, case environment when 'prod' then 'bank/prod' else 'test' end as folder, '{STAMP}' as snapshot_date
    from o where environment is not null""")
def load_routed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order files of two environments and of none in one folder: one spec, whose tables and folders are named by the environment's parameters."""
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k"))
    folder, work, name = scratch_path(spark, "landed"), scratch_path(spark, "routed"), _fresh_name("orders")
    places = ["bank/prod", "test", "elsewhere"]
    for n, place in enumerate(places):
        orders.where(F.col("k") % 3 == n).write.option("header", True).csv(f"{folder}/{place}/snapshot_date={STAMP}")
    directory = work + "/${lineOfBusinessDirectory}${environment}/orders"
    target = HistoryTable(directory, "append", database="${hiveDbPrefix}" + DATABASE, table=name)
    environments = [Environment("prod", "bank"), Environment("test")]
    load(spark, [LoadSpec("orders", storage.qualified(spark, folder), "csv", Delimited("erp"), target)], [folder], RUN, environments=environments)
    written = [
        spark.table(f"{prefix}{DATABASE}.{name}_history").select(
            F.lit(environment).alias("environment"), "k",
            F.regexp_extract(F.col("_metadata.file_path"), f"{work.rsplit('/', 1)[1]}/(.*)/orders_history", 1).alias("folder"), "snapshot_date",
        )
        for environment, prefix in (("prod", ""), ("test", "test_"))
    ]
    return written[0].unionByName(written[1])


@query(f"""
    select * from (values
      ('SUCCESS', 'orders', null, {ORDER_FILES}::bigint, {ORDER_FILES}::bigint), ('SKIPPED', 'customer', 'no load spec', {CUSTOMER_FILES}::bigint, 0::bigint),
      ('SKIPPED', 'old', 'hidden file', 1::bigint, 0::bigint), ('SUCCESS', 'none', null, 1::bigint, 0::bigint)) t(status, kind, error, files, targets)""")
def load_audit_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the audit says of files that load, have no spec, lie in a hidden folder, or hold nothing."""
    orders, audit = land_orders_csv(spark, sf_dir), scratch_path(spark, "audit")
    nation, other = table(spark, sf_dir, "nation").select("n_name"), scratch_path(spark, "other")
    nation.coalesce(1).write.csv(f"{other}/_old/snapshot_date={STAMP}")
    nation.where("n_name is null").coalesce(1).write.csv(f"{other}/none/snapshot_date={STAMP}")
    requests = {"orders": orders, "customer": land_customers_fixed(spark, sf_dir), "old": f"{other}/_old", "none": f"{other}/none"}
    root = storage.qualified(spark, orders).split("/quayside-")[0]
    spec = LoadSpec("all", root, "csv", Delimited("erp"), SnapshotFiles(scratch_path(spark, "out")))
    load(spark, [spec], [requests["orders"], requests["customer"], other], RUN, audit=audit)
    kind = F.coalesce(*(F.when(F.contains("source_path", F.lit(folder.split("/quayside-")[1])), F.lit(k)) for k, folder in requests.items()))
    ended = read_audit(spark, audit).where("status <> 'STARTED'").withColumn("kind", kind)
    return ended.groupBy("status", "kind", "error").agg(
        F.count(F.lit(1)).alias("files"), F.sum(F.size("ingested_details")).cast("bigint").alias("targets")
    )


@query(f"""
    select 'orders_header' as target, cast(o_orderkey as varchar) as k, cast(o_custkey as varchar) as v, '{STAMP}' as snapshot_date from orders
    union all select 'orders_detail', cast(l_orderkey as varchar), cast(l_partkey as varchar), '{STAMP}' from lineitem""")
def load_record_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of two record types, loaded by a spec of three into a target per type; the type without rows gets none."""
    folder, work = land_order_records(spark, sf_dir), scratch_path(spark, "types")
    types = [RecordType("header", "^O$", ["tag", "k", "v"]), RecordType("none", "^X$", ["tag", "k", "v"]), RecordType("detail", "^L$", ["tag", "k", "v"])]
    root = storage.qualified(spark, folder.rsplit("/", 1)[0])
    spec = LoadSpec("orders", root, "txt", DelimitedRecords("erp", "|", 1, types), SnapshotFiles(f"{work}/orders_{{type}}"))
    report = load(spark, [spec], [folder], RUN)
    frames = [
        storage.read_table_files(spark, w.path).select(F.lit(w.path.rsplit("/", 1)[1].removesuffix(".parquet")).alias("target"), "k", "v", "snapshot_date")
        for w in report.written["orders"]
    ]
    return reduce(DataFrame.unionByName, frames)


@query(f"""
    select status, 'shard=' || (o_orderkey % {ORDER_FILES}) as folder,
           case when status = 'SUCCESS' then '{STAMP}' end as snapshot_date,
           case when status = 'SUCCESS' then 1 else 0 end as targets
    from orders, (values ('STARTED'), ('SUCCESS')) as s(status) group by 1, 2""")
def load_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = land_orders_csv(spark, sf_dir)
    audit = scratch_path(spark, "audit")
    load(spark, [_orders_spec(spark, folder)], [folder], RUN, audit=audit)
    shard = F.regexp_extract("source_path", "/(shard=[0-9]+)/", 1).alias("folder")
    return spark.read.parquet(audit).select("status", shard, "snapshot_date", F.size("ingested_details").alias("targets"))


@query(f"""
    select cast(o_orderkey as varchar) as o_orderkey, '{STAMP}' as snapshot_date from orders""")
def reingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = land_orders_csv(spark, sf_dir)
    spec = _orders_spec(spark, folder)
    load(spark, [spec], [folder], RUN)
    load(spark, [spec], [folder], RUN, reingest=True)
    return spark.table(spec.target.names({})[1]).select("o_orderkey", "snapshot_date")


def customer_balances(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers through fixed-width files, a load, and the current view, then summed by segment."""
    folder = land_customers_fixed(spark, sf_dir)
    target = HistoryTable(scratch_path(spark, "customer"), database=DATABASE, table=_fresh_name("customer"))
    root = storage.qualified(spark, folder.rsplit("/", 1)[0])
    load(spark, [LoadSpec("customer", root, "txt", CUSTOMER_LAYOUT, target)], [folder], RUN)
    return (
        spark.table(target.names({})[0])
        .groupBy("segment")
        .agg(
            F.count(F.lit(1)).alias("customers"),
            F.sum(F.col("balance_num").cast("bigint")).alias("balance_cents"),
            F.sum("meta_source_line_number").alias("line_sum"),
        )
    )


query(f"""
    select segment, count(*) as customers, cast(sum(cents) as bigint) as balance_cents, cast(sum(n) as bigint) as line_sum
    from (select c_mktsegment as segment, cast(round(c_acctbal * 100) as bigint) as cents,
                 row_number() over (partition by c_custkey % {CUSTOMER_FILES} order by c_custkey) as n
          from customer)
    group by segment""")(customer_balances)


# merges: existing rows at a middle stamp, updates older and newer than that

_EXISTING_SQL = """
    select o_orderkey as k, o_orderstatus as status, cast(o_custkey as varchar) as only_old,
           '2024_01_02_00_00_00' as snapshot_date
    from orders where o_orderkey % 3 <> 0"""
_UPDATES_SQL = """
    select o_orderkey as k, 'new ' || o_orderstatus as status, o_orderpriority as only_new,
           case when o_orderkey % 5 = 0 then '2024_01_01_00_00_00' else '2024_01_03_00_00_00' end as snapshot_date
    from orders where o_orderkey % 2 = 0"""
_MERGE_SQL = f"""
    with e as ({_EXISTING_SQL}), u as ({_UPDATES_SQL})
    select coalesce(e.k, u.k) as k,
           case when e.k is null or e.snapshot_date <= u.snapshot_date then u.status else e.status end as status,
           e.only_old,
           case when e.k is null or e.snapshot_date <= u.snapshot_date then u.only_new end as only_new,
           case when e.k is null or e.snapshot_date <= u.snapshot_date then u.snapshot_date else e.snapshot_date end
             as snapshot_date
    from e {{kind}} join u on e.k = u.k"""


def _merge_sides(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    orders = table(spark, sf_dir, "orders")
    key = F.col("o_orderkey")
    existing = orders.where(key % 3 != 0).select(
        key.alias("k"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_custkey").cast("string").alias("only_old"),
        F.lit("2024_01_02_00_00_00").alias("snapshot_date"),
    )
    stamp: Column = F.when(key % 5 == 0, "2024_01_01_00_00_00").otherwise("2024_01_03_00_00_00")
    updates = orders.where(key % 2 == 0).select(
        key.alias("k"),
        F.concat(F.lit("new "), "o_orderstatus").alias("status"),
        F.col("o_orderpriority").alias("only_new"),
        stamp.alias("snapshot_date"),
    )
    return existing, updates


@query(_MERGE_SQL.format(kind="full"))
def upsert_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge_by_key(*_merge_sides(spark, sf_dir), ["k"])


@query(_MERGE_SQL.format(kind="right"))
def upsert_mirror(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge_by_key(*_merge_sides(spark, sf_dir), ["k"], delete_unmatched=True)


@query(_MERGE_SQL.format(kind="full"))
def upsert_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The merge written to a keyed table in two loads."""
    existing, updates = _merge_sides(spark, sf_dir)
    target = ManagedTable(DATABASE, _fresh_name("orders"), scratch_path(spark, "keyed"), keys=["k"])
    name = F.concat(F.lit("/landing/snapshot_date="), "snapshot_date", F.lit("/orders.csv")).alias("meta_source_name")
    target.write(existing.select("*", name), {})
    target.write(updates.select("*", name), {})
    return spark.table(target.name({})).drop("meta_source_name")


@query("""
    select o_orderkey as k, o_orderpriority as priority,
           case when o_orderpriority < '3' and o_orderkey % 2 = 0 then 'new ' else '' end || o_orderstatus as status,
           case when o_orderpriority < '3' and o_orderkey % 2 = 0 then '2024_01_03_00_00_00' else '2024_01_02_00_00_00' end as snapshot_date
    from orders
    union all
    select -o_orderkey, o_orderpriority, 'new ' || o_orderstatus, '2024_01_03_00_00_00' from orders
    where o_orderpriority < '3' and o_orderkey % 2 = 0""")
def upsert_partitioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Updates and new orders of two priorities: the partitions of the others keep their files."""
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("k"), F.col("o_orderpriority").alias("priority"), F.col("o_orderstatus").alias("status")
    )

    def landed(rows: DataFrame, stamp: str) -> DataFrame:
        return rows.withColumn("meta_source_name", F.lit(f"/landing/snapshot_date={stamp}/orders.csv")).withColumn("snapshot_date", F.lit(stamp))

    # order 0 and its new order have one number, as have orders k and -k: what tells them apart is a key too
    orders = orders.withColumn("mirrored", F.lit(False))
    keys = ["k", "priority", "mirrored"]
    target = ManagedTable(DATABASE, _fresh_name("orders"), scratch_path(spark, "parts"), keys=keys, partition_columns=["priority"])
    target.write(landed(orders, "2024_01_02_00_00_00"), {})
    changed = orders.where((F.col("priority") < "3") & (F.col("k") % 2 == 0)).withColumn("status", F.concat(F.lit("new "), "status"))
    new = changed.withColumns({"k": -F.col("k"), "mirrored": F.lit(True)})
    target.write(landed(changed.unionByName(new), "2024_01_03_00_00_00"), {})
    return spark.table(target.name({})).select("k", "priority", "status", "snapshot_date")


_FIRST_LOAD_SQL = f"""
    with e as ({EVENT_ROWS})
    select * from e {{where}} qualify row_number() over (partition by event_id % 1000 order by snapshot_date desc, event_type desc, event_id desc) = 1"""


def _first_load(spark: SparkSession, sf_dir: str, delete_unmatched: bool) -> DataFrame:
    """A keyed table's first load is a backfill: every key comes in many snapshots."""
    target = ManagedTable(DATABASE, _fresh_name("events"), scratch_path(spark, "first"), keys=["k"], delete_unmatched=delete_unmatched)
    events = _events_by_day(spark, sf_dir).withColumn("k", F.col("event_id") % 1000)
    # one row for each key in a file
    once = events.groupBy("k", "meta_source_name", "snapshot_date").agg(F.max_by(F.struct("event_id", "event_type"), "event_id").alias("e"))
    target.write(once.select("k", "e.event_id", "e.event_type", "meta_source_name", "snapshot_date"), {})
    return spark.table(target.name({})).select("event_id", "event_type", "snapshot_date")


@query(_FIRST_LOAD_SQL.format(where=""))
def upsert_first_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _first_load(spark, sf_dir, False)


@query(_FIRST_LOAD_SQL.format(where="where snapshot_date = (select max(snapshot_date) from e)"))
def upsert_first_mirror(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _first_load(spark, sf_dir, True)


@query(f"""
    with e as ({EVENT_ROWS}), d as (select *, dense_rank() over (order by snapshot_date) as day from e)
    select 'append' as mode, event_id, event_type, snapshot_date from d
    union all select 'append', event_id, event_type, snapshot_date from d where day > 1
    union all select 'overwrite', event_id, event_type, snapshot_date from d where day > 1
    union all select 'ignore', event_id, event_type, snapshot_date from d where day = 1
    union all select 'errorifexists', event_id, event_type, snapshot_date from d where day = 1""")
def managed_table_modes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first day, then all later days as two frames of one load, in every save mode."""
    events = _events_by_day(spark, sf_dir)
    first = events.agg(F.min("snapshot_date")).first()[0]
    begun, later = events.where(F.col("snapshot_date") == first), events.where(F.col("snapshot_date") > first)
    found = []
    for mode in SAVE_MODES:
        name, folder = _fresh_name("modes"), scratch_path(spark, "modes")
        ManagedTable(DATABASE, name, folder).write(events if mode == "append" else begun, {})
        target, report = ManagedTable(DATABASE, name, folder, mode), LoadReport(events)
        try:
            for half in (0, 1):
                report.write(target, later.where(F.col("event_id") % 2 == half), {})
        except AnalysisException:
            if mode != "errorifexists":
                raise
        found.append(spark.table(f"{DATABASE}.{name}").select(F.lit(mode).alias("mode"), "event_id", "event_type", "snapshot_date"))
    return reduce(DataFrame.unionByName, found)


# reports, with events standing in for finished loads


def _audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One audit row per event: errors failed, the rest wrote one of three kinds of target."""
    path = F.concat(F.lit("/lake/"), "event_type")
    database = F.create_map(F.lit("hiveDatabase"), F.lit("lake"), F.lit("hiveTableName"), F.col("event_type"))
    viewed = F.map_concat(database, F.create_map(F.lit("hiveViewName"), F.lit("current")))
    details = (
        F.when(F.col("event_type") == "click", viewed)
        .when(F.col("event_type") == "view", database)
        .otherwise(F.create_map().cast("map<string,string>"))
    )
    return table(spark, sf_dir, "events").select(
        F.col("user_id").alias("ingest_id"),
        F.concat(F.lit("/in/"), F.lpad(F.col("event_id").cast("string"), 12, "0")).alias("source_path"),
        F.when(F.col("event_type") == "error", "FAILED").otherwise("SUCCESS").alias("status"),
        F.array(F.struct(path.alias("ingested_path"), details.alias("details"))).alias("ingested_details"),
        F.concat(F.lit("failed on "), F.repeat("props", 40)).alias("error"),
        "ts",
    )


@query("""
    select distinct user_id as ingest_id,
           case event_type when 'click' then 'lake.current' when 'view' then 'lake.view'
                else '/lake/' || event_type end as target
    from events where event_type <> 'error'""")
def audit_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return written_targets(_audit(spark, sf_dir))


@query("""
    with f as (
      select user_id as ingest_id, '/in/' || lpad(cast(event_id as varchar), 12, '0') as subject,
             'failed on ' || repeat(props, 40) as error from events where event_type = 'error'),
    r as (select *, row_number() over (partition by ingest_id order by subject, error) as n from f)
    select ingest_id, count(*) as failed,
           string_agg(case when n <= 10 then subject end, '\n' order by n) as subjects,
           greatest(count(*) - 10, 0) as more_subjects,
           string_agg(case when n <= 2 then case when length(error) > 250 then left(error, 247) || '...' else error end end,
                      '\n' order by n) as errors,
           greatest(count(*) - 2, 0) as more_errors
    from r group by ingest_id""", name="failure_digest")
def failures_by_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    failed = _audit(spark, sf_dir).where("status = 'FAILED'")
    digest = failure_digest(failed.select("ingest_id", F.col("source_path").alias("subject"), "error"), ["ingest_id"])
    return digest.withColumn("subjects", F.concat_ws("\n", "subjects")).withColumn("errors", F.concat_ws("\n", "errors"))


@query("""
    with t as (select cast(floor(epoch(ts) / 120) as bigint) as tick, count(*) as files from events group by 1)
    select tick, files, files // 2 as per_minute, cast(sum(files) over (order by tick) as bigint) as done from t""", name="load_rate")
def files_per_minute(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load_rate(table(spark, sf_dir, "events"), "ts")


@query("""
    select event_id as message_id, event_type, ts as seen from events order by ts desc, event_id limit 10""", name="last_messages")
def newest_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = table(spark, sf_dir, "events").select(
        F.col("event_id").alias("message_id"), "event_type", F.col("ts").alias("seen")
    )
    return last_messages(log, "seen")
