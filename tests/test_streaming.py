
from ridelake.operators.dedup import latest_per_key
from ridelake.plans.models import flatten_status
from ridelake.sources import adapters as A
from ridelake.sources import landing as L
from ridelake.sources.files import parse_status_messages
from ridelake.schemas import STATUS_DOC
from ridelake.sinks.writers import publish_version, read_version
from ridelake.streaming.status import (latest_status_state, start_latest_status_stream,
                                       start_status_stream)

SF = "/root/testdata/sf0.001"


def test_stream_equals_batch(spark, tmp_dir):
    docs = L.status_documents(A.table(spark, SF, "events"), block=10).repartition(25)
    L.write_json_lines(docs, f"{tmp_dir}/landing")
    q = start_status_stream(spark, f"{tmp_dir}/landing", f"{tmp_dir}/bronze", f"{tmp_dir}/ckpt",
                            available_now=True, max_files_per_trigger=10,
                            ingestion_at="2024-02-01 00:00:00")
    q.awaitTermination()
    assert len(q.recentProgress) >= 3          # 25 files, at most 10 per micro-batch
    stream_rows = spark.read.parquet(f"{tmp_dir}/bronze")
    batch_rows = flatten_status(parse_status_messages(docs), "2024-02-01 00:00:00")
    assert stream_rows.exceptAll(batch_rows).count() == 0
    assert batch_rows.exceptAll(stream_rows).count() == 0
    # restart from the checkpoint: nothing new, nothing duplicated
    q2 = start_status_stream(spark, f"{tmp_dir}/landing", f"{tmp_dir}/bronze", f"{tmp_dir}/ckpt",
                             available_now=True, ingestion_at="2024-02-01 00:00:00")
    q2.awaitTermination()
    assert spark.read.parquet(f"{tmp_dir}/bronze").count() == batch_rows.count()


def test_latest_state_matches_batch(spark, tmp_dir):
    events = A.table(spark, SF, "events")
    L.write_json_lines(L.status_documents(events), f"{tmp_dir}/landing")
    q = start_latest_status_stream(spark, f"{tmp_dir}/landing", f"{tmp_dir}/latest", f"{tmp_dir}/ckpt",
                                   available_now=True)
    q.awaitTermination()
    got = read_version(spark, f"{tmp_dir}/latest")
    assert got.count() == events.select("user_id").distinct().count()
    flat = A.station_status(spark, SF)
    by_state = latest_status_state(flat).select("station_id", "ingestion_at")
    by_window = latest_per_key(flat, ["station_id"], "ingestion_at").select("station_id", "ingestion_at")
    assert by_state.exceptAll(by_window).count() == 0 and by_window.exceptAll(by_state).count() == 0


def test_run_with_restarts_reports_and_resumes():
    import pytest

    from ridelake.streaming.status import run_with_restarts

    class FakeQuery:
        def __init__(self, fail):
            self.fail = fail

        def awaitTermination(self):
            if self.fail:
                raise ConnectionError("source hiccup")

    outcomes = iter([True, True, False])
    logs = []
    used = run_with_restarts(lambda: FakeQuery(next(outcomes)), max_restarts=3,
                             backoff_seconds=0, log=logs.append)
    assert used == 2 and len(logs) == 2 and "restart 1/3" in logs[0]
    always = iter([True] * 5)
    with pytest.raises(ConnectionError):
        run_with_restarts(lambda: FakeQuery(next(always)), max_restarts=1, backoff_seconds=0,
                          log=logs.append)


def test_only_failures_that_may_pass_are_retried(monkeypatch):
    import pytest

    from ridelake.streaming import status
    from ridelake.streaming.report import is_transient

    assert is_transient(ConnectionResetError()) and is_transient(RuntimeError("Job aborted: java.io.IOException: broken"))
    assert not is_transient(ValueError("no such column")) and not is_transient(FileNotFoundError("gone"))

    class Broken:
        def awaitTermination(self):
            raise ValueError("no such column")
    starts = []
    with pytest.raises(ValueError):
        status.run_with_restarts(lambda: starts.append(1) or Broken(), backoff_seconds=0, log=lambda _: None)
    assert len(starts) == 1

    # restarts are counted within a window of time: a stream that ran well has them all again
    clock = iter(range(0, 10_000, 100))
    monkeypatch.setattr(status.time, "monotonic", lambda: next(clock))
    fails = iter([True] * 6 + [False])

    class Flaky:
        def awaitTermination(self):
            if next(fails):
                raise TimeoutError("slow")
    assert status.run_with_restarts(Flaky, max_restarts=2, backoff_seconds=0, log=lambda _: None, within_seconds=150) == 6


def test_quarantine_stream_keeps_malformed_documents(spark, tmp_dir):
    import json
    import os
    from ridelake.streaming.status import start_quarantine_stream, start_status_stream
    os.makedirs(f"{tmp_dir}/landing")
    with open(f"{tmp_dir}/landing/a.json", "w") as f:
        f.write(json.dumps({"last_updated": 1, "data": {"stations": [{"station_id": "u1"}]}}) + "\n")
        f.write(json.dumps({"last_updated": 2}) + "\n")
        f.write("this is not json\n")
    q1 = start_status_stream(spark, f"{tmp_dir}/landing", f"{tmp_dir}/bronze", f"{tmp_dir}/c1",
                             available_now=True, ingestion_at="2024-01-01 00:00:00")
    q2 = start_quarantine_stream(spark, f"{tmp_dir}/landing", f"{tmp_dir}/quarantine", f"{tmp_dir}/c2",
                                 available_now=True)
    q1.awaitTermination()
    q2.awaitTermination()
    assert spark.read.parquet(f"{tmp_dir}/bronze").count() == 1
    bad = spark.read.parquet(f"{tmp_dir}/quarantine").collect()
    assert len(bad) == 2
    assert any(r.raw == "this is not json" for r in bad)


def test_published_versions_stay_whole(spark, tmp_dir):
    import os
    for n in range(1, 5):
        publish_version(spark.range(n), f"{tmp_dir}/t")
        assert read_version(spark, f"{tmp_dir}/t").count() == n
    assert len(os.listdir(f"{tmp_dir}/t")) == 2
    os.makedirs(f"{tmp_dir}/t/version=99")  # an unfinished write is not read, and is written anew in time
    assert read_version(spark, f"{tmp_dir}/t").count() == 4


def _landed(spark, tmp_dir, files=6):
    from pyspark.sql import functions as F
    docs = L.status_documents(A.table(spark, SF, "events"), block=25)
    last = docs.agg(F.max("doc_id")).first()[0] + 1
    assert L.land_in_order(docs.withColumn("file", F.floor(F.col("doc_id") * files / last)), f"{tmp_dir}/landing", files) == files
    return docs


def test_a_batch_that_comes_twice(spark, tmp_dir):
    """With the ledger a replayed batch is written once; a plain append writes it twice."""
    from ridelake.streaming import report
    from ridelake.streaming.ledger import read_batches, read_ledger, start_ledger_stream, total_rows
    from ridelake.streaming.status import _trigger, await_bounded, run_with_restarts, stream_status, valid_documents
    docs = _landed(spark, tmp_dir)
    want = flatten_status(parse_status_messages(docs), "2024-02-01 00:00:00")

    class Lost:
        done = False

        def __call__(self, batch):
            if batch == 1 and not self.done:
                self.done = True
                raise ConnectionError("acknowledgement lost")

    lost = Lost()
    n = report.run_reported(spark, lambda: start_ledger_stream(
        spark, f"{tmp_dir}/landing", f"{tmp_dir}/table", f"{tmp_dir}/c1", available_now=True, max_files_per_trigger=2,
        ingestion_at="2024-02-01 00:00:00", name="twice", after_write=lost), f"{tmp_dir}/report", "twice", backoff_seconds=0)
    got = read_batches(spark, f"{tmp_dir}/table", want.schema)
    assert n == 1 and got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    assert total_rows(spark, f"{tmp_dir}/table") == want.count() == 1000
    assert [r.batch for r in read_ledger(spark, f"{tmp_dir}/table").orderBy("batch").collect()] == [0, 1, 2]
    kinds = [r.kind for r in report.read_report(spark, f"{tmp_dir}/report").orderBy("at").collect() if r.kind not in ("progress", "idle")]
    assert sorted(kinds) == ["ended", "failed", "restarted", "started", "started"]

    lost.done = False

    def append(rows, batch):
        rows.write.mode("append").parquet(f"{tmp_dir}/plain")
        lost(batch)

    def start():
        flat = flatten_status(valid_documents(stream_status(spark, f"{tmp_dir}/landing", 2)), "2024-02-01 00:00:00")
        return _trigger(flat.writeStream.foreachBatch(append).option("checkpointLocation", f"{tmp_dir}/c2"), None, True).start()
    assert run_with_restarts(start, backoff_seconds=0, log=lambda _: None) == 1
    twice = spark.read.parquet(f"{tmp_dir}/plain").count() - want.count()
    assert twice == read_ledger(spark, f"{tmp_dir}/table").filter("batch = 1").first().rows > 0

    # an unfinished write has no entry and isn't read
    want.limit(3).write.parquet(f"{tmp_dir}/table/data/stream=other/batch=0")
    assert read_batches(spark, f"{tmp_dir}/table", want.schema).count() == 1000
    # another stream begins with the same numbers and is taken too
    await_bounded(start_ledger_stream(spark, f"{tmp_dir}/landing", f"{tmp_dir}/table", f"{tmp_dir}/c3", available_now=True,
                                      max_files_per_trigger=6, ingestion_at="2024-02-01 00:00:00"))
    assert read_batches(spark, f"{tmp_dir}/table", want.schema).count() == 2000


def test_windows_leave_the_state_behind_the_watermark(spark, tmp_dir):
    from ridelake.streaming import event_time
    from ridelake.streaming.status import _trigger, await_bounded, stream_status, valid_documents
    _landed(spark, tmp_dir)
    flat = flatten_status(valid_documents(stream_status(spark, f"{tmp_dir}/landing", 1)), "2024-02-01 00:00:00")
    out = event_time.status_windows(flat, "1 hour")
    q = _trigger(out.writeStream.format("parquet").option("path", f"{tmp_dir}/out").option("checkpointLocation", f"{tmp_dir}/c"), None, True).start()
    await_bounded(q)
    state = [s.numRowsTotal for p in q.recentProgress for s in p.stateOperators]
    total = event_time.status_windows(flatten_status(valid_documents(
        spark.read.schema(STATUS_DOC).json(f"{tmp_dir}/landing"))), "1 hour").count()
    written = spark.read.parquet(f"{tmp_dir}/out").count()
    # a file's windows at most are held at once, and at the end only the last hour's
    assert max(state) < 0.5 * total and state[-1] <= 5 and total - written <= 5


def test_late_reports_are_counted(spark, tmp_dir):
    from pyspark.sql import functions as F
    from ridelake.streaming import event_time
    from ridelake.streaming.status import _trigger, await_bounded, stream_status, valid_documents
    docs = L.status_documents(A.table(spark, SF, "events"), block=25)
    once = docs.withColumn("file", F.floor(F.col("doc_id") / 10))
    late = once.filter("file = 0").withColumn("file", F.lit(4))
    L.land_in_order(once.unionByName(late), f"{tmp_dir}/landing", 5)
    flat = flatten_status(valid_documents(stream_status(spark, f"{tmp_dir}/landing", 1)), "2024-02-01 00:00:00")
    q = _trigger(event_time.once_each(flat, "1 day").writeStream.format("parquet").option("path", f"{tmp_dir}/out")
                 .option("checkpointLocation", f"{tmp_dir}/c"), None, True).start()
    await_bounded(q)
    assert sum(s.numRowsDroppedByWatermark for p in q.recentProgress for s in p.stateOperators) == 250
    assert spark.read.parquet(f"{tmp_dir}/out").count() == flatten_status(parse_status_messages(docs)).select(*event_time.REPORT_KEY).distinct().count()
