import pytest

from conftest import values
from quayside.operators.upsert import latest_per_key, merge_by_key

OLD, MID, NEW = "2024_01_01_00_00_00", "2024_01_02_00_00_00", "2024_01_03_00_00_00"
SIDE = "k string, v string, snapshot_date string"


@pytest.fixture(params=["broadcast", "shuffle"])
def sides(spark, request):
    if request.param == "shuffle":
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    existing = [("a", "1", MID), ("b", "1", MID), ("c", "1", MID), ("d", "1", MID), (None, "1", MID)]
    updates = [("a", "2", NEW), ("b", "2", MID), ("c", "2", OLD), ("e", "2", OLD), (None, "2", NEW)]
    yield spark.createDataFrame(existing, SIDE), spark.createDataFrame(updates, SIDE)
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


MERGED = [("a", "2", NEW), ("b", "2", MID), ("c", "1", MID), ("e", "2", OLD), (None, "2", NEW)]


def test_merge(sides):
    want = MERGED + [("d", "1", MID), (None, "1", MID)]
    assert values(merge_by_key(*sides, ["k"])) == sorted(want, key=repr)


def test_mirror_drops_unmatched(sides):
    assert values(merge_by_key(*sides, ["k"], delete_unmatched=True)) == sorted(MERGED, key=repr)


def test_merge_twice_is_once(spark, sides):
    existing, updates = sides
    updates = updates.where("k is not null")
    once = merge_by_key(existing, updates, ["k"])
    assert values(merge_by_key(once, updates, ["k"])) == values(once)


def test_new_and_missing_columns(spark):
    existing = spark.createDataFrame([("a", 1, "old", MID), ("b", 1, "old", MID)], "k string, v int, only_old string, snapshot_date string")
    updates = spark.createDataFrame([("a", 2, True, NEW), ("c", 3, True, NEW)], "k string, v int, only_new boolean, snapshot_date string")
    merged = merge_by_key(existing, updates, ["k"])
    assert values(merged, "k", "v", "only_old", "only_new") == [
        ("a", 2, "old", True), ("b", 1, "old", None), ("c", 3, None, True)
    ]
    assert merge_by_key(existing, updates, ["k"], evolve=False).columns == existing.columns


def test_repeated_update_keys(sides, spark):
    existing, _ = sides
    twice = spark.createDataFrame([("a", "2", NEW), ("a", "3", NEW)], SIDE)
    with pytest.raises(Exception, match="several updates for existing key"):
        merge_by_key(existing, twice, ["k"]).count()
    fresh = spark.createDataFrame([("z", "2", NEW), ("z", "3", NEW)], SIDE)
    assert [r for r in values(merge_by_key(existing, fresh, ["k"])) if r[0] == "z"] == [("z", "2", NEW), ("z", "3", NEW)]


def test_two_key_columns(spark):
    schema = "a int, b int, v int, snapshot_date string"
    existing = spark.createDataFrame([(1, 1, 0, MID), (1, None, 0, MID)], schema)
    updates = spark.createDataFrame([(1, 1, 9, NEW), (1, None, 9, NEW)], schema)
    assert values(merge_by_key(existing, updates, ["a", "b"]), "a", "b", "v") == [(1, 1, 9), (1, None, 0), (1, None, 9)]


def test_latest_per_key(spark):
    schema = SIDE + ", meta_source_name string"
    rows = [("a", "1", OLD, "f1"), ("a", "2", NEW, "f2"), ("a", "3", NEW, "f3"), ("a", "4", NEW, "f3"), (None, "5", OLD, "f1")]
    kept = latest_per_key(spark.createDataFrame(rows, schema), ["k"])
    assert values(kept, "v") == [("3",), ("4",), ("5",)]
