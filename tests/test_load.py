import uuid
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from conftest import values
from quayside.operators.lineage import Run
from quayside.plans.load import LoadFailed, LoadSpec, load, load_database
from quayside.plans.reports import written_targets
from quayside.sinks import storage
from quayside.sinks.targets import HistoryTable, ManagedTable, SnapshotFiles
from quayside.sources.delimited import Delimited, DelimitedRecords, RecordType
from quayside.sources.frames import Frame
from quayside.sources.structured import Json

S1, S2 = "2024_01_01_00_00_00", "2024_01_02_00_00_00"
RUN = Run(datetime(2024, 6, 1, tzinfo=timezone.utc), "art", "rev", "1.2")


def base36(number):
    digits = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return digits[number] if number < 36 else base36(number // 36) + digits[number % 36]


def csv_spec(tmp_path, target=None, source=None, path=None):
    root = f"file:{path or tmp_path / 'in'}"
    return LoadSpec("orders", root, "csv", source or Delimited("erp"), target or SnapshotFiles(str(tmp_path / "out")))


def stored(spark, spec):
    return storage.read_table_files(spark, spec.target.path({}))


def test_load_stamps_lineage(spark, land, tmp_path):
    import hashlib

    folder = land({"a b.csv": "Id,V #\n1,x\n2,y\n"})
    spec = csv_spec(tmp_path)
    load(spark, [spec], [folder], RUN)
    row = stored(spark, spec).where("id = 1").first().asDict()
    assert row == {
        "id": "1",
        "v_num": "x",
        "meta_source_line_number": 2,
        "meta_lineage_id": base36(int(hashlib.sha1(b"a b").hexdigest(), 16)),
        "meta_source_system_name": "erp",
        "meta_source_name": f"file:{folder}/a b.csv",
        "meta_source_offset": "",
        "meta_lineage_datetime": "2024_06_01_00_00_00",
        "meta_provenance_id": "art",
        "meta_github_hash": "rev",
        "meta_semver": "1.2",
        "meta_provenance_datetime": "2024_06_01_00_00_00",
        "snapshot_date": S1,
    }


def test_files_of_several_snapshots_load_together(spark, land, tmp_path):
    land({"a.csv": "id\n1\n", "x.json": '{"id": 5}\n', "_SUCCESS": "", "odd.bin": "?"}, S1)
    land({"a.csv": "id\n2\n", "deep/b.csv": "id\n3\n"}, S2)
    specs = [
        csv_spec(tmp_path),
        LoadSpec("json", f"file:{tmp_path}/in", "json", Json("web"), SnapshotFiles(str(tmp_path / "json"))),
    ]
    report = load(spark, specs, [str(tmp_path / "in")], RUN)
    assert values(stored(spark, specs[0]), "id", "snapshot_date") == [("1", S1), ("2", S2), ("3", S2)]
    assert values(stored(spark, specs[1]), "id") == [("5",)]
    assert sorted(report.written) == ["json", "orders"]


def test_deeper_spec_wins_and_requested_file_needs_a_spec(spark, land, tmp_path):
    folder = land({"a.csv": "id\n1\n", "special/b.csv": "id\n2\n", "c.bin": "?"})
    deep = LoadSpec("special", f"file:{folder}/special", "csv", Delimited("x"), SnapshotFiles(str(tmp_path / "special")))
    spec = csv_spec(tmp_path)
    load(spark, [spec, deep], [folder], RUN)
    assert values(stored(spark, spec), "id") == [("1",)] and values(stored(spark, deep), "id") == [("2",)]
    with pytest.raises(ValueError, match="c.bin"):
        load(spark, [spec], [f"{folder}/c.bin"], RUN)


@pytest.mark.parametrize("bad", ["bad.csv", "zbad.csv"])
def test_bad_files_are_isolated(spark, land, tmp_path, bad):
    land({f"f{n}.csv": f"id,v\n{n},x\n" for n in range(2)} | {bad: "a b,a.b\n1,2\n", "empty.csv": "id,v\n"})
    no_stamp = tmp_path / "in" / "loose.csv"
    no_stamp.write_text("id,v\n9,x\n")
    spec, audit = csv_spec(tmp_path), str(tmp_path / "audit")
    with pytest.raises(LoadFailed) as caught:
        load(spark, [spec], [str(tmp_path / "in")], RUN, audit=audit)
    assert "2 files failed" in str(caught.value) and bad in str(caught.value) and "loose.csv" in str(caught.value)
    assert values(stored(spark, spec), "id") == [(str(n),) for n in range(2)]

    log = spark.read.parquet(audit)
    last = {r["source_path"].rsplit("/", 1)[1]: r["status"] for r in log.where("status <> 'STARTED'").collect()}
    assert last == {**{f"f{n}.csv": "SUCCESS" for n in range(2)}, "empty.csv": "SUCCESS", bad: "FAILED", "loose.csv": "FAILED"}
    assert log.where("status = 'STARTED'").count() == 5
    assert log.where("status = 'SUCCESS'").select("snapshot_date").distinct().collect()[0][0] == S1
    assert {r["target"] for r in written_targets(log).collect()} == {spec.target.path({})}


def test_record_types_go_to_their_own_tables(spark, land, tmp_path):
    folder = land({"a.csv": "H|1\nD|x|2\nD|y|3\n"})
    types = [RecordType("head", "^H$", ["t", "n"]), RecordType("line", "^D$", ["t", "v", "n"]), RecordType("none", "^Z$", ["t"])]
    name = uuid.uuid4().hex[:8]
    target = HistoryTable(str(tmp_path / "out/{type}"), database="qs_test", table="{type}_" + name)
    spec = csv_spec(tmp_path, target, DelimitedRecords("erp", "|", 1, types))
    load(spark, [spec], [folder], RUN)
    assert values(spark.table(f"qs_test.line_{name}"), "v", "n", "meta_source_line_number") == [("x", "2", 2), ("y", "3", 3)]
    assert spark.table(f"qs_test.head_{name}").count() == 1
    assert not spark.catalog.tableExists(f"qs_test.none_{name}")
    load(spark, [spec], [folder], RUN, reingest=True)
    assert spark.table(f"qs_test.line_{name}_history").count() == 2


def test_reingest_by_file_snapshot_and_history(spark, land, tmp_path):
    one = land({"a.csv": "id\n1\n", "b.csv": "id\n2\n"}, S1)
    land({"a.csv": "id\n3\n"}, S2)
    spec = csv_spec(tmp_path)
    everything = str(tmp_path / "in")
    load(spark, [spec], [everything], RUN)
    later = Run(datetime(2024, 7, 1, tzinfo=timezone.utc))

    def runs():
        return values(stored(spark, spec), "id", "meta_lineage_datetime")

    old, new = "2024_06_01_00_00_00", "2024_07_01_00_00_00"
    load(spark, [spec], [f"{one}/a.csv"], later, reingest=True)
    assert runs() == [("1", new), ("2", old), ("3", old)]
    load(spark, [spec], [one], later, reingest=True)
    assert runs() == [("1", new), ("2", new), ("3", old)]
    load(spark, [spec], [everything], RUN, reingest=True)
    assert runs() == [("1", old), ("2", old), ("3", old)]


def test_keyed_load_takes_the_newest_file(spark, land, tmp_path):
    land({"a.csv": "id,v\n1,old\n2,old\n"}, S1)
    name = uuid.uuid4().hex[:8]
    target = ManagedTable("qs_test", "t" + name, str(tmp_path / "out"), keys=["id"])
    spec = csv_spec(tmp_path, target)
    load(spark, [spec], [str(tmp_path / "in")], RUN)
    land({"b.csv": "id,v\n2,new\n3,new\n"}, S2)
    load(spark, [spec], [str(tmp_path / "in")], RUN)
    assert values(spark.table(f"qs_test.t{name}"), "id", "v") == [("1", "old"), ("2", "new"), ("3", "new")]


def test_files_of_other_specs_in_a_folder_are_not_read(spark, land, tmp_path):
    folder = land({"a.csv": "id\n1\n", "b.csv": "id\n2\n", "special/c.csv": "id\n3\n"})
    deep = LoadSpec("special", f"file:{folder}/special", "csv", Delimited("x"), SnapshotFiles(str(tmp_path / "special")))
    spec = csv_spec(tmp_path)
    load(spark, [spec, deep], [folder], RUN)
    assert values(stored(spark, spec), "id") == [("1",), ("2",)] and values(stored(spark, deep), "id") == [("3",)]


def test_target_place_may_depend_on_the_snapshot(spark, land, tmp_path):
    land({"a.csv": "id\n1\n"}, S1)
    land({"a.csv": "id\n2\n"}, S2)
    spec = csv_spec(tmp_path, SnapshotFiles(str(tmp_path / "out/{source_snapshot}/{date}")))
    load(spark, [spec], [str(tmp_path / "in")], RUN)
    for stamp, want in ((S1, "1"), (S2, "2")):
        path = spec.target.path({"source_snapshot": stamp, "date": "2024_06_01"})
        assert values(storage.read_table_files(spark, path), "id") == [(want,)]


def test_database_tables_load_under_one_stamp(spark, tmp_path):
    class Tables:
        source_type, source_system = "jdbc", "erp"

        def read(self, session):
            made = {"A": [(1, "x")], "B_B": [(2, "y"), (3, "z")], "NONE": []}
            return [
                Frame(session.createDataFrame(r, "`Id #` int, V string").withColumn("meta_source_name", F.lit("jdbc:x:y")), {"type": t})
                for t, r in made.items()
            ]

    spec = LoadSpec("db", "", "", Tables(), SnapshotFiles(str(tmp_path / "{type}")))
    written = load_database(spark, spec, S1, RUN)
    assert [w.path for w in written] == [str(tmp_path / "A.parquet"), str(tmp_path / "B_B.parquet")]
    rows = storage.read_table_files(spark, written[1].path)
    assert values(rows, "id_num", "v", "meta_source_name", "snapshot_date") == [(2, "y", "jdbc:x:y", S1), (3, "z", "jdbc:x:y", S1)]


@pytest.mark.parametrize("managed", [False, True])
def test_overwriting_keeps_all_files_of_one_load(spark, land, tmp_path, managed):
    """Files with different headers, and one bad file that makes the group be halved."""
    name = uuid.uuid4().hex[:8]
    if managed:
        target = ManagedTable("qs_test", "t" + name, str(tmp_path / "out"), "overwrite")
    else:
        target = SnapshotFiles(str(tmp_path / "out"), "overwrite")
    spec = csv_spec(tmp_path, target)
    land({"a.csv": "id\nold\n"}, S1)
    load(spark, [spec], [str(tmp_path / "in")], RUN)
    land({"a.csv": "id\n1\n", "b.csv": "id,v\n2,x\n", "c.csv": "a b,a.b\n1,2\n", "d.csv": "id\n3\n"}, S1)
    with pytest.raises(LoadFailed, match="1 files failed"):
        load(spark, [spec], [str(tmp_path / "in")], RUN)
    assert values(stored(spark, spec), "id", "v") == [("1", None), ("2", "x"), ("3", None)]


def ran(spark, after=-1):
    """What the session ran after an execution: by number, the plan."""
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    runs = spark._jsparkSession.sharedState().statusStore().executionsList()
    found = (runs.apply(i) for i in range(runs.size()))
    return {r.executionId(): r.physicalPlanDescription() for r in found if r.executionId() > after}


def five_types(kind):
    if kind == "delimited":
        types = [RecordType(t, f"^{t}$", ["t", "v"]) for t in "ABCDZ"]
        return DelimitedRecords("erp", "|", 1, types), "A|1\nB|2\nC|3\nD|4\nA|5\nother|9\n"
    from quayside.sources.fixed_width import FixedColumn, FixedType, FixedWidthRecords

    types = [FixedType(t, f"^{t}$", [FixedColumn("t", 1), FixedColumn("v", 2)]) for t in "ABCDZ"]
    return FixedWidthRecords("erp", 1, 1, types), "A1\nB2\nC3\nD4\nA5\nX9\n"


@pytest.mark.parametrize("kind", ["delimited", "fixed"])
def test_files_of_five_types_are_scanned_twice(spark, land, tmp_path, kind):
    """Once to count lines and once to parse them, however many types there are."""
    source, text = five_types(kind)
    land({"a.txt": text, "b.txt": text})
    spec = LoadSpec("five", f"file:{tmp_path}", "txt", source, SnapshotFiles(str(tmp_path / "out-{type}")))
    before = max(ran(spark), default=-1)
    report = load(spark, [spec], [str(tmp_path / "in")], RUN)
    assert len([p for p in ran(spark, before).values() if "Scan text" in p]) == 2
    got = {w.path.removesuffix(".parquet")[-1]: values(storage.read_table_files(spark, w.path), "v", "meta_source_line_number") for w in report.written["five"]}
    assert got == {"A": [("1", 1), ("1", 1), ("5", 5), ("5", 5)], "B": [("2", 2)] * 2, "C": [("3", 3)] * 2, "D": [("4", 4)] * 2}
    from quayside.session import shared_dir

    assert not [p for p in storage.child_names(spark, shared_dir(spark)) if "kinds" in p]


def test_nothing_vanishes(spark, land, tmp_path):
    """Hidden, empty and unknown files leave a row; a file that was asked for and cannot be loaded is an error."""
    folder = land({"a.csv": "id\n1\n", "zero.csv": "", "_latest": "x", ".b.csv": "id\n2\n", "_old/deep/c.csv": "id\n3\n", "d.bin": "?", "sub/e[1].csv": "id\n4\n", "_SUCCESS": ""})
    spec, audit = csv_spec(tmp_path), str(tmp_path / "audit")
    report = load(spark, [spec], [str(tmp_path / "in")], RUN, audit=audit)
    log = spark.read.parquet(audit)
    name = F.substring_index("source_path", f"{S1}/", -1)
    got = values(log.select(name.alias("n"), "status", "error", F.size("ingested_details").alias("t")), "n", "status", "error", "t")
    assert [r for r in got if r[1] != "STARTED"] == sorted([
        ("a.csv", "SUCCESS", None, 1), ("sub/e[1].csv", "SUCCESS", None, 1), ("zero.csv", "SUCCESS", None, 0), ("_latest", "SKIPPED", "hidden file", 0),
        (".b.csv", "SKIPPED", "hidden file", 0), ("_old/deep/c.csv", "SKIPPED", "hidden file", 0), ("d.bin", "SKIPPED", "no load spec", 0),
    ], key=repr)
    assert values(stored(spark, spec), "id") == [("1",), ("4",)] and report.files.count() == 3
    for bad, why in (("_latest", "hidden file"), ("d.bin", "no load spec")):
        with pytest.raises(ValueError, match=f"{why} for 1 requested files"):
            load(spark, [spec], [f"{folder}/{bad}"], RUN, audit=audit)
    assert spark.read.parquet(audit).where("status = 'FAILED'").count() == 2


def test_specs_by_environment_and_store(spark, land, tmp_path):
    import dataclasses

    from quayside.plans.load import Environment, resolve_specs

    land({"bank/prod/a.csv": "id\n1\n", "bank/test/a.csv": "id\n2\n", "shop/prod/a.csv": "id\n3\n"})
    target = SnapshotFiles(str(tmp_path / "out") + "/${lineOfBusinessDbPrefix}${environment}")
    spec = csv_spec(tmp_path, target)
    both = [Environment("prod", "bank"), Environment("test", "bank")]
    load(spark, [spec], [str(tmp_path / "in")], RUN, audit=str(tmp_path / "audit"), environments=both)
    read = lambda name: values(storage.read_table_files(spark, str(tmp_path / f"out/{name}.parquet")), "id")
    assert read("bank_prod") == [("1",)] and read("bank_test") == [("2",)]
    log = spark.read.parquet(str(tmp_path / "audit"))
    assert values(log.where("status = 'SUCCESS'"), "configuration_name") == [("orders in bank/prod",), ("orders in bank/test",)]
    assert values(log.where("status = 'SKIPPED'"), "error") == [("no environment",)]
    # a single environment takes everything
    load(spark, [spec], [str(tmp_path / "in")], RUN, environments=[Environment("dev")], reingest=True)
    assert read("dev") == [("1",), ("2",), ("3",)]
    keyed = dataclasses.replace(spec, name="keyed", path="/in/a", container="raw")
    mine = dataclasses.replace(keyed, name="mine", account="lake")
    deep = dataclasses.replace(spec, name="deep", path="/in")
    rows = [(f"abfss://{c}@{a}.x.net{p}/snapshot_date={S1}/f.csv", f"{p}/snapshot_date={S1}/f.csv", "csv") for c, a, p in
            [("raw", "lake", "/in/a"), ("raw", "sea", "/in/a"), ("raw", "lake", "/in/b"), ("other", "lake", "/in/a"), ("raw", "lake", "/out")]]
    found = resolve_specs(spark.createDataFrame(rows, "path string, subject string, extension string"), [keyed, mine, deep])
    assert [r["spec"] for r in found.orderBy(F.monotonically_increasing_id()).collect()] == ["mine", "keyed", "deep", "deep", None]
