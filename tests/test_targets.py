import uuid

import pytest
from pyspark.sql import functions as F

from conftest import values
from quayside.sinks import storage
from quayside.sinks.targets import HistoryTable, ManagedTable, SnapshotFiles

S1, S2, S3 = "2024_01_01_00_00_00", "2024_01_02_00_00_00", "2024_01_03_00_00_00"


@pytest.fixture
def rows(spark):
    """Three snapshots of two files with two rows each."""
    made = [(f"{s[8:10]}{f}{n}", f"file:/in/snapshot_date={s}/{f}.csv", s) for s in (S1, S2, S3) for f in "ab" for n in (1, 2)]
    return spark.createDataFrame(made, "id string, meta_source_name string, snapshot_date string")


def ids(df):
    return sorted(r["id"] for r in df.collect())


@pytest.fixture
def name():
    return "t" + uuid.uuid4().hex[:8]


def test_snapshot_files_modes(spark, rows, tmp_path):
    path = str(tmp_path / "{kind}/x/")
    target = SnapshotFiles(path, "append")
    first = rows.where(F.col("snapshot_date") != S3)
    info = target.write(first, {"kind": "k"})
    assert info.path == str(tmp_path / "k/x.parquet")

    def stored():
        return ids(storage.read_table_files(spark, info.path))

    assert stored() == ids(first)
    with pytest.raises(ValueError, match="already exists"):
        SnapshotFiles(path, "errorifexists").write(rows, {"kind": "k"})
    SnapshotFiles(path, "ignore").write(rows.withColumn("id", F.upper("id")), {"kind": "k"})
    assert stored() == sorted(ids(first) + ["03A1", "03A2", "03B1", "03B2"])
    SnapshotFiles(path, "overwrite", num_files=1).write(rows.where(f"snapshot_date = '{S3}'").limit(1), {"kind": "k"})
    assert len(stored()) == 9 and storage.partition_values(spark, info.path) == [S1, S2, S3]


@pytest.mark.parametrize("kind", ["files", "history", "managed", "managed_by_snapshot"])
def test_deletes(spark, rows, tmp_path, name, kind):
    directory = str(tmp_path / "t")
    target = {
        "files": SnapshotFiles(directory),
        "history": HistoryTable(directory, database="qs_test", table=name),
        "managed": ManagedTable("qs_test", name, directory),
        "managed_by_snapshot": ManagedTable("qs_test", name, directory, partition_columns=["snapshot_date"]),
    }[kind]
    target.write(rows, {})
    path = target.path({})

    def stored():
        return ids(storage.read_table_files(spark, path))

    target.delete(spark, {}, S2, f"/elsewhere/snapshot_date={S2}/a.csv")
    assert stored() == [i for i in ids(rows) if not i.startswith("02a")]
    target.delete(spark, {}, S3)
    assert stored() == [i for i in ids(rows) if not i.startswith(("02a", "03"))]
    if kind.startswith("managed"):
        assert ids(spark.table(target.name({}))) == stored()
    if kind == "history":
        view, history = target.names({})
        assert ids(spark.table(view)) == ["02b1", "02b2"] and ids(spark.table(history)) == stored()
    with pytest.raises(ValueError, match="cannot delete by file"):
        target.delete(spark, {}, S2, "/no/stamp.csv")
    # both rows of the last file of a snapshot: its folder goes too
    target.delete(spark, {}, S2, f"/in/snapshot_date={S2}/b.csv")
    assert stored() == ["01a1", "01a2", "01b1", "01b2"]
    if kind in ("files", "history"):
        assert storage.partition_values(spark, path) == [S1]
    target.delete(spark, {})
    assert not storage.exists(spark, path)
    if kind != "files":
        assert not spark.catalog.tableExists(f"qs_test.{name}")
    target.delete(spark, {})
    target.write(rows, {})
    assert stored() == ids(rows)


def test_overwrite_mode_deletes_more(spark, rows, tmp_path):
    target = SnapshotFiles(str(tmp_path / "t"), "overwrite")
    target.write(rows, {})
    target.delete(spark, {}, S2, f"/in/snapshot_date={S2}/a.csv")
    assert ids(storage.read_table_files(spark, target.path({}))) == [i for i in ids(rows) if not i.startswith("02")]


def test_history_view_follows_the_newest_and_columns_grow(spark, rows, tmp_path, name):
    target = HistoryTable(str(tmp_path / "t"), database="qs_test", table="{kind}" + name)
    tokens = {"kind": "k"}
    info = target.write(rows.where(f"snapshot_date = '{S2}'"), tokens)
    view, history = target.names(tokens)
    assert info.details == {"hiveDatabase": "qs_test", "hiveTableName": f"k{name}_history", "hiveViewName": f"k{name}"}
    target.write(rows.where(f"snapshot_date = '{S1}'"), tokens)
    assert {r["snapshot_date"] for r in spark.table(view).collect()} == {S2}
    target.write(rows.where(f"snapshot_date = '{S3}'").withColumn("extra", F.lit(1)), tokens)
    assert values(spark.table(view), "id", "extra") == [(f"03{f}{n}", 1) for f in "ab" for n in (1, 2)]
    assert spark.table(history).where("extra is null").count() == 8
    plan = spark.table(view)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(snapshot_date" in plan


def test_managed_overwrite_replaces_all(spark, rows, tmp_path, name):
    target = ManagedTable("qs_test", name, str(tmp_path / "t"), "overwrite", num_files=2)
    target.write(rows, {})
    target.write(rows.limit(1).withColumn("extra", F.lit(1)), {})
    assert spark.table(f"qs_test.{name}").select("extra").collect()[0][0] == 1
    assert spark.table(f"qs_test.{name}").count() == 1


def test_keyed_table_keeps_two_versions_and_deletes(spark, rows, tmp_path, name):
    target = ManagedTable("qs_test", name, str(tmp_path / "t"), keys=["id"])
    target.write(rows.where(f"snapshot_date = '{S1}'"), {})
    for stamp in (S2, S3):
        target.write(rows.where(f"snapshot_date = '{stamp}'"), {})
    assert target.versions(spark, str(tmp_path / "t")) == [2, 3]
    table = f"qs_test.{name}"
    assert ids(spark.table(table)) == ids(rows)
    target.delete(spark, {}, S3)
    assert ids(spark.table(table)) == [i for i in ids(rows) if not i.startswith("03")]
    target.delete(spark, {})
    assert not spark.catalog.tableExists(table)


def test_keyed_mirror_keeps_only_the_newest_snapshot(spark, rows, tmp_path, name):
    target = ManagedTable("qs_test", name, str(tmp_path / "t"), keys=["id"], delete_unmatched=True)
    target.write(rows.where(f"snapshot_date = '{S1}'"), {})
    target.write(rows.where(f"snapshot_date <> '{S1}'"), {})
    assert ids(spark.table(f"qs_test.{name}")) == ["03a1", "03a2", "03b1", "03b2"]


def test_specs_are_checked():
    with pytest.raises(ValueError, match="save mode"):
        SnapshotFiles("/x", "upsert")
    with pytest.raises(ValueError, match="keys need"):
        ManagedTable("d", "t", "/x", "overwrite", keys=["k"])
    with pytest.raises(ValueError, match="not a valid"):
        HistoryTable("/x", database="d", table="t[1]")
    HistoryTable("/x", database="d", table="t_{type}")


def test_delete_with_odd_partition_values(spark, rows, tmp_path, name):
    target = ManagedTable("qs_test", name, str(tmp_path / "t"), partition_columns=["kind"])
    odd = rows.withColumn("kind", F.when(F.col("id").endswith("1"), "a b:%[x]").otherwise("007"))
    target.write(odd, {})
    target.delete(spark, {}, S2)
    table = spark.table(f"qs_test.{name}")
    assert ids(table) == [i for i in ids(rows) if not i.startswith("02")]
    assert {r["kind"] for r in table.collect()} == {"a b:%[x]", "007"}


@pytest.mark.parametrize("mirror", [False, True])
def test_first_keyed_load_keeps_the_newest_row_of_each_key(spark, tmp_path, name, mirror):
    old = [(k, "old", f"/in/snapshot_date={S1}/a.csv", S1) for k in (1, 2, 3)]
    new = [(k, "new", f"/in/snapshot_date={S2}/a.csv", S2) for k in (1, 2)]
    rows = spark.createDataFrame(old + new, "k int, v string, meta_source_name string, snapshot_date string")
    target = ManagedTable("qs_test", name, str(tmp_path / "t"), keys=["k"], delete_unmatched=mirror)
    target.write(rows, {})
    assert values(spark.table(target.name({})), "k", "v") == [(1, "new"), (2, "new")] + [(3, "old")] * (not mirror)


@pytest.mark.parametrize("kind", ["files", "managed"])
def test_ignore_leaves_out_what_was_there_for_all_frames(spark, rows, tmp_path, name, kind):
    from quayside.plans.load import LoadReport

    make = lambda mode: SnapshotFiles(str(tmp_path / "t"), mode) if kind == "files" else ManagedTable("qs_test", name, str(tmp_path / "t"), mode)
    make("append").write(rows.where(f"snapshot_date = '{S1}'"), {})
    report, target = LoadReport(rows), make("ignore")
    for half in ("a", "b"):
        report.write(target, rows.where(f"substring(id, 3, 1) = '{half}'"), {})
    want = rows if kind == "files" else rows.where(f"snapshot_date = '{S1}'")
    assert ids(storage.read_table_files(spark, target.path({}))) == ids(want)


def test_folders_may_hold_quotes(spark, rows, tmp_path, name):
    target = HistoryTable(str(tmp_path / "it's"), database="qs_test", table=name)
    target.write(rows, {})
    assert spark.table(target.names({})[0]).count() == 4
    keyed = ManagedTable("qs_test", name + "k", str(tmp_path / "it's `k`"), keys=["id"])
    keyed.write(rows, {})
    assert spark.table(keyed.name({})).count() == rows.count()


def keyed_rows(spark, rows, stamp):
    made = [(k, d, v, f"/in/snapshot_date={stamp}/x.csv", stamp) for k, d, v in rows]
    return spark.createDataFrame(made, "k int, d string, v string, meta_source_name string, snapshot_date string")


def files_of(folder):
    return {str(p.relative_to(folder)) for p in folder.rglob("*.parquet")}


def test_a_merge_replaces_touched_partitions_only(spark, tmp_path, name, monkeypatch):
    target = ManagedTable("qs_test", name, str(tmp_path / "t"), keys=["k", "d"], partition_columns=["d"])
    target.write(keyed_rows(spark, [(1, "a", "x"), (2, "a", "x"), (1, "b", "x"), (3, "c/ d", "x"), (4, None, "x")], S1), {})
    version = tmp_path / "t" / "version=1"
    before = files_of(version)
    target.write(keyed_rows(spark, [(1, "a", "y"), (9, "c/ d", "y"), (5, "new", "y"), (4, None, "y")], S2), {})

    def stored():
        return values(spark.table(target.name({})), "k", "d", "v")

    want = [(1, "a", "y"), (1, "b", "x"), (2, "a", "x"), (3, "c/ d", "x"), (4, None, "x"), (4, None, "y"), (5, "new", "y"), (9, "c/ d", "y")]
    assert stored() == sorted(want, key=repr)
    kept = {f for f in before if f.startswith("d=b/")}
    assert kept <= files_of(version) and files_of(version) & before == kept
    assert not (tmp_path / "t" / "version=2").exists()

    # a driver that dies between two moves: the next write finishes them first
    real, moved = storage.move, []

    def dies(*args):
        if moved:
            raise KeyboardInterrupt
        moved.append(real(*args))

    monkeypatch.setattr(storage, "move", dies)
    with pytest.raises(KeyboardInterrupt):
        target.write(keyed_rows(spark, [(1, "a", "z"), (1, "b", "z")], S3), {})
    monkeypatch.undo()
    # what was not written to the end does not count
    (tmp_path / "t" / "_moving_1x" / "d=b").mkdir(parents=True)
    target.write(keyed_rows(spark, [(7, "e", "z")], S3), {})
    assert not list((tmp_path / "t").glob("_moving*"))
    got = {(k, d): v for k, d, v in stored() if d in ("a", "b", "e")}
    assert got == {(1, "a"): "z", (2, "a"): "x", (1, "b"): "z", (7, "e"): "z"}


def test_a_merge_that_may_move_rows_makes_a_version(spark, tmp_path, name):
    target = ManagedTable("qs_test", name, str(tmp_path / "t"), keys=["k"], partition_columns=["d"])
    target.write(keyed_rows(spark, [(1, "a", "x"), (2, "b", "x")], S1), {})
    target.write(keyed_rows(spark, [(1, "b", "y")], S2), {})
    assert values(spark.table(target.name({})), "k", "d", "v") == [(1, "b", "y"), (2, "b", "x")]
    assert (tmp_path / "t" / "version=2").exists()
    wider = ManagedTable("qs_test", name + "w", str(tmp_path / "w"), keys=["k", "d"], partition_columns=["d"])
    wider.write(keyed_rows(spark, [(1, "a", "x"), (2, "b", "x")], S1), {})
    wider.write(keyed_rows(spark, [(1, "a", "y")], S2).withColumn("more", F.lit("m")), {})
    assert values(spark.table(wider.name({})), "k", "d", "v", "more") == [(1, "a", "y", "m"), (2, "b", "x", None)]


def test_deletes_read_only_data_files_of_the_landed_files(spark, tmp_path, name, monkeypatch):
    from quayside.sinks import file_index

    target = ManagedTable("qs_test", name, str(tmp_path / "t"))
    root = tmp_path / "t"

    def landed(file, n, stamp=S1):
        made = [(f"{file}{i}", f"file:/in/snapshot_date={stamp}/{file}.csv", stamp) for i in range(n)]
        return spark.createDataFrame(made, "id string, meta_source_name string, snapshot_date string").coalesce(1)

    for file in "abcd":
        target.write(landed(file, 3), {})
    target.write(landed("d", 2).unionByName(landed("e", 1)).coalesce(1), {})
    names = {f.name: f for f in root.glob("*.parquet")}
    read = []
    real = storage.read_table_files
    monkeypatch.setattr(storage, "read_table_files", lambda s, r, files=None: read.append(sorted(files or [])) or real(s, r, files))
    target.delete(spark, {}, S1, ["/x/snapshot_date=" + S1 + "/d.csv", "/x/snapshot_date=" + S1 + "/a.csv"])
    assert ids(spark.table(target.name({}))) == ["b0", "b1", "b2", "c0", "c1", "c2", "e0"]
    # all files for the index, three to look in, the same three to rewrite at once
    assert [len(r) for r in read] == [5, 3, 3] and read[1] == read[2]
    kept = {f.name for f in root.glob("*.parquet")}
    assert len(kept & set(names)) == 2
    read.clear()
    target.write(landed("f", 1), {})
    target.delete(spark, {}, S1, "/x/snapshot_date=" + S1 + "/f.csv")
    # the index knows all but the rewritten files and the new one
    assert [len(r) for r in read] == [len(kept) - 2 + 1, 1, 1]
    read.clear()
    target.delete(spark, {}, S1, "/x/snapshot_date=" + S1 + "/gone.csv")
    # no data file to look in
    assert len(read) <= 1 and ids(spark.table(target.name({})))[-1] == "e0"
    assert file_index.bring_up_to_date(spark, str(root)) == 0


def test_rows_of_files_in_nested_snapshot_folders(spark):
    names = ["/a/snapshot_date=1/b.csv", "/snapshot_date=1/x/snapshot_date=2/b.csv", "/snapshot_date=3/x/snapshot_date=2/b.csv", "/a/b.csv"]
    rows = spark.createDataFrame([(n,) for n in names], "meta_source_name string")
    hit = lambda *files: [r[0] for r in rows.where(storage.rows_of_files(files)).collect()]
    assert hit("s3://x/snapshot_date=1/b.csv") == names[:1]
    assert hit("/q/snapshot_date=1/x/snapshot_date=2/b.csv") == names[1:2]
    assert hit("/q/snapshot_date=1/b.csv", "/snapshot_date=3/x/snapshot_date=2/b.csv") == [names[0], names[2]]
    with pytest.raises(ValueError, match="no snapshot_date folder"):
        hit("/a/b.csv")


def test_mirrored_orders_are_new_whatever_their_numbers(spark, tmp_path):
    """Order 0 is its own mirror image, and 6 and -6 are each other's: all their new orders are inserted."""
    from quayside.examples import tables

    made = [(k, p, "F") for k, p in [(0, "1-URGENT"), (6, "2-HIGH"), (-6, "2-HIGH"), (7, "1-URGENT"), (8, "5-LOW")]]
    spark.createDataFrame(made, "o_orderkey bigint, o_orderpriority string, o_orderstatus string").write.parquet(str(tmp_path / "orders.parquet"))
    got = [tuple(r) for r in tables.upsert_partitioned(spark, str(tmp_path)).collect()]
    old = [(k, p, s, "2024_01_02_00_00_00") for k, p, s in made if k in (7, 8)]
    new = [(i, p, "new F", "2024_01_03_00_00_00") for k, p, _ in made if k not in (7, 8) for i in (k, -k)]
    assert sorted(got) == sorted(old + new)


def test_partitioned_writes_sort_no_rows_of_few_folders(spark, tmp_path, monkeypatch):
    """Files are held open instead, and what lies in further folders is written all the same."""
    from pyspark.sql.readwriter import DataFrameWriter

    from quayside.sources.frames import stage_kinds

    setting, seen, write = "spark.sql.maxConcurrentOutputFileWriters", [], DataFrameWriter.parquet
    before = spark.conf.get(setting)
    monkeypatch.setattr(DataFrameWriter, "parquet", lambda self, *a, **b: (seen.append(int(spark.conf.get(setting))), write(self, *a, **b))[1])
    made = spark.range(0, 400, 1, 2).selectExpr("cast(id as string) as id", "'f' as meta_source_name", "format_string('2024_01_%02d_00_00_00', id % 20 + 1) as snapshot_date")
    target = SnapshotFiles(str(tmp_path / "many"), "append")
    target.write(made, {})
    staged = stage_kinds(made.select("id"), [F.col("id") % 3 == n for n in range(3)], str(tmp_path / "kinds"))
    assert len(seen) == 2 and min(seen) >= 3 and spark.conf.get(setting) == before
    assert values(storage.read_table_files(spark, target.path({})).select("id", "snapshot_date")) == values(made.select("id", "snapshot_date"))
    assert [n for _, n in staged] == [134, 133, 133] and ids(staged[0][0]) == sorted(str(i) for i in range(0, 400, 3))
