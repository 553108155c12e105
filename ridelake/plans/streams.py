"""Registered queries on the status stream: a batch that comes twice, the report of a run
with a failure, repeats and late reports, event-time windows. The documents of the
whole ``events`` table land as files in the order of their time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ridelake.functions.scalars import ts_to_epoch_seconds
from ridelake.plans import oracle as O
from ridelake.plans.models import flatten_status
from ridelake.plans.tables import Tables
from ridelake.schemas import STATUS_COUNTERS, STATUS_DOC
from ridelake.session import scratch_path
from ridelake.sources import adapters as A
from ridelake.sources import landing as L
from ridelake.streaming import event_time, report
from ridelake.streaming.ledger import read_batches, read_ledger, start_ledger_stream
from ridelake.streaming.status import _trigger, await_bounded, stream_status, valid_documents

LOADED_AT = "2024-02-01 00:00:00"
FILES = 12
FILES_A_BATCH = 4


def _documents(t: Tables) -> DataFrame:
    """Feed documents with the number of the file that they land in, in the order of time."""
    docs = L.status_documents(A.table(t.spark, t.sf_dir, "events"))
    last = docs.agg(F.max("doc_id")).scalar()
    return docs.withColumn("file", F.floor(F.col("doc_id") * FILES / (last + 1)))


class LostOnce:
    """Loses the connection after the first batch numbered ``batch`` was written."""

    def __init__(self, batch: int):
        self.batch, self.lost = batch, False

    def __call__(self, batch: int) -> None:
        if batch == self.batch and not self.lost:
            self.lost = True
            raise ConnectionError("lost before the batch was acknowledged")


def _run_with_a_loss(t: Tables) -> tuple[str, str]:
    """The table and the report of a run that loses the acknowledgement of its second batch."""
    landing, root, checkpoint, log = (scratch_path(t.spark, p) for p in ("landing", "ledger", "checkpoints", "report"))
    L.land_in_order(_documents(t), landing, FILES)
    lost = LostOnce(1)

    def start():
        return start_ledger_stream(t.spark, landing, root, checkpoint, available_now=True, max_files_per_trigger=FILES_A_BATCH,
                                   ingestion_at=LOADED_AT, name=name, after_write=lost)

    name = "status-" + root.rsplit("/", 1)[-1]
    report.run_reported(t.spark, start, log, name, backoff_seconds=0)
    return root, log


def stream_replayed_batch(t: Tables) -> DataFrame:
    """A batch is written, its acknowledgement is lost, it comes again and isn't written again."""
    root, _ = _run_with_a_loss(t)
    return read_batches(t.spark, root, flatten_status(t.spark.createDataFrame([], STATUS_DOC), LOADED_AT).schema)


def stream_run_report(t: Tables) -> DataFrame:
    """What the report and the ledger of such a run say."""
    root, log = _run_with_a_loss(t)
    rows, taken = report.read_report(t.spark, log), read_ledger(t.spark, root)
    of = lambda kind: F.count(F.when(F.col("kind") == kind, 1))
    said = rows.agg(of(report.STARTED).alias("starts"), of(report.FAILED).alias("failures"), of(report.RESTARTED).alias("restarts"),
                    of(report.ENDED).alias("ends"),
                    F.count_distinct(F.when(F.col("kind") == report.PROGRESS, F.col("batch"))).alias("batches_reported"),
                    F.count(F.when(F.col("message").contains("lost before the batch"), 1)).alias("messages"))
    done = taken.agg(F.count(F.lit(1)).alias("batches_taken"), F.sum("rows").alias("rows_taken"))
    return said.crossJoin(done)  # one row each


def _events_to(t: Tables, docs: DataFrame, files: int, operator, files_a_batch: int) -> DataFrame:
    """The rows that a stream over ``docs`` gives out."""
    landing, target, checkpoint = (scratch_path(t.spark, p) for p in ("landing", "event-time", "checkpoints"))
    L.land_in_order(docs, landing, files)
    flat = flatten_status(valid_documents(stream_status(t.spark, landing, files_a_batch)), LOADED_AT)
    out = operator(flat)
    writer = out.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint).option("path", target)
    await_bounded(_trigger(writer, None, True).start())
    return t.spark.read.schema(out.schema).parquet(target)


def stream_once_each(t: Tables) -> DataFrame:
    """Every third document comes again with the next file, and at the very end the documents of
    the first file come once more: repeats go, and the late ones don't wake the state."""
    docs = _documents(t)
    again = docs.filter("doc_id % 3 = 0").withColumn("file", F.col("file") + 1)
    late = docs.filter("file = 0").withColumn("file", F.lit(FILES + 1))
    out = _events_to(t, docs.unionByName(again).unionByName(late), FILES + 2,
                     lambda flat: event_time.once_each(flat, "6 days").select(*event_time.REPORT_KEY), 2)
    return out


def stream_status_windows(t: Tables) -> DataFrame:
    """Reports by station and five minutes; a last document, a month later, closes all windows."""
    docs = _documents(t)
    counters = ", ".join(f"'{c}', {'newest + 30 * 86400' if c == 'last_reported' else '0'}" for c in STATUS_COUNTERS)
    last = A.table(t.spark, t.sf_dir, "events").agg(F.max(ts_to_epoch_seconds("ts")).alias("newest"))
    closing = last.selectExpr("CAST(-1 AS BIGINT) AS doc_id", f"to_json(named_struct('last_updated', newest, 'data', "
                              f"named_struct('stations', array(named_struct('station_id', 'closing', {counters}))))) AS value",
                              f"CAST({FILES} AS BIGINT) AS file")
    return _events_to(t, docs.unionByName(closing), FILES + 1, lambda flat: event_time.status_windows(flat, "1 hour"), 3)


_EPOCH = "date_sub('second', TIMESTAMP '1970-01-01 00:00:00', ts)"
_FILE = f"(event_id // 100) * {FILES} // (SELECT max(event_id) // 100 + 1 FROM events)"

FOUND = {
    "stream_replayed_batch": (stream_replayed_batch, O.FLAT_STATUS),
    "stream_run_report": (stream_run_report, f"""SELECT 2 AS starts, 1 AS failures, 1 AS restarts, 1 AS ends,
  CAST(ceil(count(DISTINCT {_FILE}) / {FILES_A_BATCH}.0e0) AS BIGINT) AS batches_reported, 1 AS messages,
  CAST(ceil(count(DISTINCT {_FILE}) / {FILES_A_BATCH}.0e0) AS BIGINT) AS batches_taken, count(*) AS rows_taken FROM events"""),
    "stream_once_each": (stream_once_each, f"""SELECT DISTINCT 'uuid-' || CAST(user_id AS VARCHAR) AS station_id,
  {_EPOCH} AS last_reported, event_id % 5 AS num_bikes_available, event_id % 7 AS num_docks_available FROM events"""),
    "stream_status_windows": (stream_status_windows, f"""WITH reports AS (
  SELECT 'uuid-' || CAST(user_id AS VARCHAR) AS station_id, {_EPOCH} AS last_reported, event_id % 5 AS num_bikes_available,
    event_id % 7 AS num_docks_available FROM events
), placed AS (
  SELECT *, last_reported // 300 * 300 AS window_start, count(*) OVER (PARTITION BY station_id, last_reported // 300) AS n_reports FROM reports
)
SELECT station_id, window_start, n_reports, last_reported, num_bikes_available, num_docks_available FROM placed
QUALIFY row_number() OVER (PARTITION BY station_id, window_start
  ORDER BY last_reported DESC, num_bikes_available DESC, num_docks_available DESC) = 1"""),
}
