import json
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from conftest import values
from quayside.plans.load import LoadSpec
from quayside.session import shared_dir
from quayside.sinks import storage
from quayside.sinks.targets import SnapshotFiles
from quayside.sources.delimited import Delimited
from quayside.streaming.arrivals import Arrivals, SpecsUnavailable
from quayside.streaming.ingest import MessageLoader
from quayside.streaming.messages import MESSAGE_SCHEMA, classify, retry_outcome

ENVIRONMENTS = [("prod", "LakeProd"), ("test", "laketest")]
START = datetime(2024, 1, 1, tzinfo=timezone.utc)


# fixed values: the fields of a message body, its event names and envelope
def body(api="PutBlob", topic="/accounts/lakeprod", event="Microsoft.Storage.BlobCreated", subject=None):
    subject = subject or "/blobServices/default/containers/raw/blobs/in/a.csv"
    return json.dumps({"topic": topic, "subject": subject, "eventType": event, "data": {"api": api, "x": 1}, "id": "1"})


def message(name, text, status=None, metadata=None, delays=0):
    return {
        "message_id": name, "enqueued": START.isoformat(), "body": text, "copy_status": status,
        "metadata": metadata, "delay_count": delays,
    }


ENVELOPE = "@\x06string\x083http://schemas.microsoft.com/2003/10/Serialization/��"
CASES = {
    "plain": (message("plain", body()), "ingest"),
    "create": (message("create", body("CreateFile")), "ignore"),
    "pending": (message("pending", body("CopyBlob"), "pending"), "delay"),
    "success": (message("success", body("CopyBlob"), "success"), "ingest"),
    "unset": (message("unset", body("CopyBlob")), "ingest"),
    "aborted": (message("aborted", body("CopyBlob"), "ABORTED"), "ignore"),
    "failed": (message("failed", body("CopyBlob"), "failed"), "ignore"),
    "deleted": (message("deleted", body(event="Microsoft.Storage.BlobDeleted")), "dead_letter"),
    "broken": (message("broken", "{nope"), "dead_letter"),
    "lacking": (message("lacking", '{"topic": "/accounts/lakeprod"}'), "dead_letter"),
    "wrapped": (message("wrapped", ENVELOPE + body() + "\x01"), "ingest"),
    "elsewhere": (message("elsewhere", body(topic="/accounts/other")), "ignore"),
    "homeless": (message("homeless", body(subject="/in/a.csv")), "ignore"),
}


def frame(spark, messages):
    return spark.read.schema(MESSAGE_SCHEMA).json(spark.sparkContext.parallelize([json.dumps(m) for m in messages]))


def test_outcomes(spark):
    out = classify(frame(spark, [m for m, _ in CASES.values()]), ENVIRONMENTS)
    assert {r["message_id"]: r["outcome"] for r in out.collect()} == {k: o for k, (_, o) in CASES.items()}
    row = out.where("message_id = 'deleted'").first()
    assert row["reason"] == "not an event of a new file: Microsoft.Storage.BlobDeleted"
    row = out.where("message_id = 'plain'").first()
    assert (row["environment"], row["container"], row["subject"]) == ("prod", "raw", "/in/a.csv")
    assert out.where("message_id = 'pending'").first()["delay_seconds"] == 300


def test_correlation_id(spark):
    messages = [message("a", body(), metadata={"CORRELATIONID": "c", "x": "y"}), message("b", body(), metadata={"x": "y"}), message("c", body())]
    out = classify(frame(spark, messages), ENVIRONMENTS)
    assert values(out, "message_id", "correlation_id") == [("a", "c"), ("b", "b"), ("c", "c")]


def test_retry_budget(spark):
    df = spark.range(6).select(F.col("id"), retry_outcome(F.col("id")).alias("o"))
    assert [r["o"] for r in df.orderBy("id").collect()] == ["delay"] * 4 + ["dead_letter"] * 2


class Stream:
    """A stream over message files in a folder, with a clock and an ingest log."""

    def __init__(self, spark, folder, ingest=None):
        self.spark, self.folder, self.now, self.loaded = spark, folder, START, []
        self.arrivals = Arrivals(str(folder / "outcomes"), ENVIRONMENTS, ingest or self.ingest, clock=lambda: self.now)
        (folder / "messages").mkdir()
        self.sent = 0

    def ingest(self, messages):
        self.loaded += [r["message_id"] for r in messages.collect()]

    def send(self, *messages):
        self.sent += 1
        text = "".join(json.dumps(m) + "\n" for m in messages)
        (self.folder / "messages" / f"{self.sent}.json").write_text(text)

    def run(self):
        self.arrivals.run(self.spark, str(self.folder / "messages"), str(self.folder / "checkpoint"), 1)

    def outcomes(self, *columns):
        return values(self.arrivals.history(self.spark), *(columns or ("message_id", "outcome")))


def test_each_message_is_handled_once(spark, tmp_path):
    stream = Stream(spark, tmp_path)
    stream.send(CASES["plain"][0], CASES["plain"][0], CASES["broken"][0])
    stream.send(CASES["plain"][0], CASES["create"][0])
    stream.run()
    stream.run()
    stream.send(CASES["plain"][0], CASES["success"][0])
    stream.run()
    assert sorted(stream.loaded) == ["plain", "success"]
    assert stream.outcomes() == [("broken", "dead_letter"), ("create", "ignore"), ("plain", "ingest"), ("success", "ingest")]


def test_a_replayed_batch_leaves_the_same_rows(spark, tmp_path):
    stream = Stream(spark, tmp_path)
    batch = frame(spark, [m for m, _ in CASES.values()])
    stream.arrivals.process(batch, 0)
    once = stream.outcomes()
    stream.arrivals.process(batch, 0)
    assert stream.outcomes() == once and len(once) == len(CASES)


def test_delayed_messages_come_back_when_due(spark, tmp_path):
    stream = Stream(spark, tmp_path)
    stream.send(CASES["pending"][0])
    stream.run()
    stream.now = START + timedelta(minutes=4)
    stream.send(CASES["plain"][0])
    stream.run()
    assert stream.outcomes() == [("pending", "delay"), ("plain", "ingest")]
    stream.now = START + timedelta(minutes=5)
    stream.send(CASES["create"][0])
    stream.run()
    # still pending: waits again under a new id and a higher count
    assert stream.outcomes("message_id", "outcome", "delay_count")[1:] == [("pending", "delay", 0), ("pending-1", "delay", 1), ("plain", "ingest", 0)]
    stream.send(CASES["create"][0])
    stream.run()
    assert len(stream.outcomes()) == 4


def test_missing_specs_delay_then_give_up(spark, tmp_path):
    def unavailable(messages):
        raise SpecsUnavailable("no specs now")

    stream = Stream(spark, tmp_path, unavailable)
    stream.send(message("young", body(), delays=3), message("old", body(), delays=4), CASES["create"][0])
    stream.run()
    assert stream.outcomes("message_id", "outcome", "reason") == [
        ("create", "ignore", "file not written yet"), ("old", "dead_letter", "no specs now"), ("young", "delay", "no specs now")
    ]
    waits = [r["due_at"] for r in stream.arrivals.history(spark).where("message_id = 'young'").collect()]
    assert waits[0].replace(tzinfo=timezone.utc) == START + timedelta(minutes=2)


def test_failed_loads_become_dead_letters(spark, tmp_path):
    stream = Stream(spark, tmp_path, lambda m: spark.createDataFrame([("success", "bad file")], "message_id string, error string"))
    stream.send(CASES["plain"][0], CASES["success"][0])
    stream.run()
    assert stream.outcomes("message_id", "outcome", "reason") == [("plain", "ingest", None), ("success", "dead_letter", "bad file")]


def test_files_are_loaded_on_arrival(spark, tmp_path):
    stamp = "2024_01_01_00_00_00"
    folder = tmp_path / "raw" / "in" / f"snapshot_date={stamp}"
    folder.mkdir(parents=True)
    (folder / "a.csv").write_text("id\n1\n")
    (folder / "b.csv").write_text("id\n2\n")
    (folder / "bad.csv").write_text("a b,a.b\n2\n")
    (folder / "zero.csv").write_text("")
    (folder / "_hidden.csv").write_text("id\n9\n")
    spec = LoadSpec("orders", "/raw/in", "csv", Delimited("erp"), SnapshotFiles(str(tmp_path / "out")))
    loader = MessageLoader(f"{tmp_path}/{{container}}{{subject}}", lambda: [spec], str(tmp_path / "audit"))
    stream = Stream(spark, tmp_path, loader)

    def arrived(name, file):
        path = f"/blobServices/default/containers/raw/blobs/in/snapshot_date={stamp}/{file}"
        return message(name, body(subject=path), metadata={"correlationId": "c-" + name})

    stream.send(arrived("1", "a.csv"), arrived("2", "bad.csv"), arrived("3", "gone.csv"), arrived("4", "x.unknown"))
    stream.send(arrived("5", "b.csv"), arrived("1", "a.csv"), arrived("6", "zero.csv"), arrived("7", "_hidden.csv"))
    stream.run()
    out = storage.read_table_files(spark, spec.target.path({}))
    assert values(out, "id") == [("1",), ("2",)]
    assert stream.outcomes() == [("1", "ingest"), ("2", "dead_letter"), ("3", "dead_letter"), ("4", "ingest"), ("5", "ingest"), ("6", "ingest"), ("7", "dead_letter")]
    log = spark.read.parquet(str(tmp_path / "audit")).where("status <> 'STARTED'")
    assert values(log, "ingest_id", "correlation_id", "status") == [
        ("1", "c-1", "SUCCESS"), ("2", "c-2", "FAILED"), ("5", "c-5", "SUCCESS"), ("6", "c-6", "SUCCESS")
    ]


def test_a_batch_lists_and_reads_the_buckets_of_its_ids_only(spark, tmp_path):
    stream = Stream(spark, tmp_path)
    stream.arrivals.process(frame(spark, [message(f"m{n}", body("CreateFile")) for n in range(200)]), 0)
    asked = frame(spark, [message("m7", body()), message("new", body())]).where("message_id = 'm7'")
    found = stream.arrivals.seen(spark, asked, 1)
    assert values(found, "message_id") == [("m7",)]
    files = [f for f in found.inputFiles() if "/seen/" in f]
    folders = {f.split("/bucket=")[1].split("/")[0] for f in files}
    assert len(folders) == 1 and len(list((tmp_path / "outcomes_state" / "seen").glob("bucket=*"))) > 1
    assert not any("/outcomes/" in f for f in found.inputFiles())
    # a batch that runs again does not count what it noted itself
    assert stream.arrivals.seen(spark, asked, 0).collect() == []


def test_repeats_of_long_ago_are_found_by_day(spark, tmp_path):
    stream = Stream(spark, tmp_path)
    stream.arrivals.process(frame(spark, [CASES["plain"][0]]), 0)
    stream.now = START + timedelta(days=40)
    stream.arrivals.process(frame(spark, [CASES["plain"][0]]), 1)
    assert stream.loaded == ["plain"]
    stream.arrivals.remember_days = 30
    stream.arrivals.process(frame(spark, [CASES["plain"][0]]), 2)
    assert stream.loaded == ["plain", "plain"]


def waiting_hours(stream):
    return sorted(int(p.name.split("=")[1]) for p in (stream.folder / "outcomes_state" / "delayed").glob("due_hour=*"))


def test_hours_leave_when_their_messages_came_back(spark, tmp_path):
    stream = Stream(spark, tmp_path)
    stream.arrivals.process(frame(spark, [CASES["pending"][0]]), 0)
    first = int(START.timestamp()) // 3600
    assert waiting_hours(stream) == [first]
    # a batch that runs again an hour later leaves nothing of its first run
    stream.now = START + timedelta(hours=1)
    stream.arrivals.process(frame(spark, [CASES["pending"][0]]), 0)
    hour = stream.folder / "outcomes_state" / "delayed"
    assert [p.parent.name for p in hour.glob("due_hour=*/batch_id=0")] == [f"due_hour={first + 1}"]
    stream.now = START + timedelta(hours=2)
    # hours to come are not listed
    assert stream.arrivals._hours(spark) == [h for h in waiting_hours(stream) if h <= first + 2]
    stream.arrivals.release(spark)
    assert ("pending-1", "delay") in stream.outcomes()
    stream.now = START + timedelta(hours=4)
    stream.arrivals.release(spark)
    stream.arrivals.process(frame(spark, [CASES["create"][0]]), 1)
    # the message that came back and still waits does so for this very hour
    assert waiting_hours(stream) == [first + 4]
    assert [r[0] for r in stream.outcomes() if r[0].startswith("pending")] == ["pending", "pending-1", "pending-1-2"]


def test_a_release_that_breaks_off_is_done_again(spark, tmp_path, monkeypatch):
    stream = Stream(spark, tmp_path)
    stream.arrivals.process(frame(spark, [CASES["pending"][0]]), 0)
    stream.now = START + timedelta(hours=3)
    with monkeypatch.context() as patch:
        patch.setattr(storage, "make_folder", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            stream.arrivals.release(spark)
    stream.arrivals.release(spark)
    stream.arrivals.release(spark)
    assert stream.outcomes() == [("pending", "delay"), ("pending-1", "delay")]


def test_listening_ends_after_an_idle_time(spark, tmp_path):
    """Messages sent while the stream listens are handled, delayed ones that come due as well; then silence ends it."""
    import threading
    import time

    stream = Stream(spark, tmp_path)
    stream.send(CASES["plain"][0], CASES["pending"][0], CASES["plain"][0])
    begun = time.monotonic()

    def later():
        while not stream.loaded and time.monotonic() - begun < 60:
            time.sleep(0.2)
        stream.send(CASES["success"][0], CASES["plain"][0])
        stream.now = START + timedelta(minutes=6)

    sender = threading.Thread(target=later)
    sender.start()
    listen = {"every": "300 milliseconds", "idle": timedelta(seconds=6)}
    stream.arrivals.listen(spark, str(tmp_path / "messages"), str(tmp_path / "checkpoint"), 1, **listen)
    sender.join()
    assert sorted(stream.loaded) == ["plain", "success"]
    assert [r[0] for r in stream.outcomes()] == ["pending", "pending-1", "plain", "success"]
    assert not spark.streams.active


def test_listening_to_nothing_ends(spark, tmp_path):
    import time

    stream = Stream(spark, tmp_path)
    begun = time.monotonic()
    listen = {"every": "200 milliseconds", "idle": timedelta(seconds=1)}
    stream.arrivals.listen(spark, str(tmp_path / "messages"), str(tmp_path / "checkpoint"), 1, **listen)
    assert time.monotonic() - begun < 60 and stream.outcomes() == []


class Breaking(SnapshotFiles):
    """A target that fails for one record type until it is mended."""

    broken = True

    def write(self, df, tokens, appended=()):
        if tokens.get("type") == "B" and Breaking.broken:
            raise RuntimeError("no room")
        return super().write(df, tokens, appended)


def test_a_failure_half_way_leaves_no_row_twice(spark, tmp_path):
    """One of two frames was appended when the load failed; the batch runs again once the target is mended."""
    from quayside.sources.delimited import DelimitedRecords, RecordType

    stamp = "2024_01_01_00_00_00"
    folder = tmp_path / "raw" / "in" / f"snapshot_date={stamp}"
    folder.mkdir(parents=True)
    (folder / "a.csv").write_text("A,1\nB,2\nA,3\n")
    source = DelimitedRecords("erp", ",", 1, [RecordType("A", "^A", ["kind", "id"]), RecordType("B", "^B", ["kind", "id"])])
    spec = LoadSpec("orders", "/raw/in", "csv", source, Breaking(str(tmp_path / "out-{type}")), notify=True)
    loader = MessageLoader(f"{tmp_path}/{{container}}{{subject}}", lambda: [spec], str(tmp_path / "audit"), notices=str(tmp_path / "notices"))
    stream = Stream(spark, tmp_path, loader)
    subject = f"/blobServices/default/containers/raw/blobs/in/snapshot_date={stamp}/a.csv"
    batch = frame(spark, [message("1", body(subject=subject))])
    Breaking.broken = True
    stream.arrivals.process(batch, 0)
    assert stream.outcomes("message_id", "outcome", "reason") == [("1", "dead_letter", "no room")]
    assert not (tmp_path / "notices").exists()
    Breaking.broken = False
    stream.arrivals.process(batch, 0)
    assert stream.outcomes() == [("1", "ingest")]
    for kind, ids in (("A", [("1",), ("3",)]), ("B", [("2",)])):
        assert values(storage.read_table_files(spark, f"{tmp_path}/out-{kind}.parquet"), "id") == ids
    stream.arrivals.process(batch, 0)
    assert values(storage.read_table_files(spark, f"{tmp_path}/out-A.parquet"), "id") == [("1",), ("3",)]
    notices = spark.read.parquet(str(tmp_path / "notices"))
    assert [(r.message_id, r.configuration_name, sorted(w.rsplit("/", 1)[1] for w in r.written)) for r in notices.collect()] == [("1", "orders", ["out-A.parquet", "out-B.parquet"])]


def test_the_audit_of_a_few_loads_is_found_in_their_folders(spark, tmp_path):
    from quayside.sinks import audit

    files = spark.range(300).selectExpr("concat('/in/', id) as path", "concat('id', id) as ingest_id", "'c' as correlation_id")
    audit.record(audit.audit_rows(files, audit.STARTED, "orders", START), str(tmp_path / "audit"))
    audit.record(audit.audit_rows(files.where("path = '/in/7'"), audit.SUCCESS, "orders", START), str(tmp_path / "audit"))
    asked = spark.createDataFrame([("id7",), ("other",)], "ingest_id string").where("ingest_id = 'id7'")
    rows = audit.read_audit(spark, str(tmp_path / "audit"), asked)
    assert len({f.split("/id_bucket=")[1].split("/")[0] for f in rows.inputFiles() if "id_bucket" in f}) == 1
    assert values(rows, "ingest_id", "status", "day") == [("id7", "STARTED", "2024-01-01"), ("id7", "SUCCESS", "2024-01-01")]
    assert audit.read_audit(spark, str(tmp_path / "audit")).count() == 301
    assert [tuple(r) for r in audit.load_states(spark, str(tmp_path / "audit"), asked).collect()] == [("id7", True)]


def test_a_batch_is_handled_in_the_session_that_started_the_stream(spark, tmp_path):
    """Plans of the stream's own session are not adaptive, and have a task for each part of the state store. A batch leaves no copies of its rows."""
    seen = []

    def ingest(messages):
        seen.append((messages.sparkSession.conf.get("spark.sql.adaptive.enabled"), messages.count()))

    rows = [(str(i), f'{{"topic": "/accounts/lakeprod", "subject": "/blobServices/default/containers/raw/blobs/in/{i}.csv", "eventType": "Microsoft.Storage.BlobCreated", "data": {{"api": "PutBlob"}}}}') for i in range(20)]
    spark.createDataFrame(rows, "message_id string, body string").write.json(str(tmp_path / "messages"))
    before = set(storage.child_names(spark, shared_dir(spark)))
    arrivals = Arrivals(str(tmp_path / "outcomes"), [("prod", "lakeprod")], ingest)
    arrivals.run(spark, str(tmp_path / "messages"), str(tmp_path / "checkpoint"), 100)
    assert seen == [("true", 20)] and arrivals.history(spark).count() == 20
    assert not [n for n in set(storage.child_names(spark, shared_dir(spark))) - before if "batch" in n]
