"""Command-line runner (``spark-submit -m``-style entry point).

  python -m ridelake.run stations      --landing DIR --warehouse DIR [--multi-line] [--extracted-at document] [--by-delivery]
  python -m ridelake.run trips         --landing DIR --warehouse DIR [--months 202401,202402 | --new-only] [--mode append|overwrite_days] [--incremental]
  python -m ridelake.run status-stream --landing DIR --warehouse DIR [--checkpoint DIR] [--trigger "300 seconds" | --available-now]
  python -m ridelake.run status        --warehouse DIR [--as-of "2024-01-30 12:00:00"] [--tz ZONE]

Each batch command loads its raw feed, builds its layers as tables and runs
the layer checks: a failing ``error`` check stops the remaining layers and the
command exits non-zero (``--report-only`` builds every layer and only
reports). The master, executors and ``spark.checkpoint.dir`` come from
spark-submit / the cluster configuration. ``status-stream`` leaves a report of its
starts, batches, failures and restarts under ``_reports/status-stream``.
"""

from __future__ import annotations

import argparse
import json
import sys
import uuid

from ridelake.plans import jobs as J
from ridelake.session import apply_conf, cluster_conf, get_spark
from ridelake.streaming.report import run_reported
from ridelake.streaming.status import DEFAULT_MAX_FILES, start_quarantine_stream, start_status_stream


def _report(rep: J.RunReport) -> int:
    out = {"stopped_at": rep.stopped_at, "errors": rep.errors, "warnings": rep.warnings}
    print(json.dumps(out, default=str))
    return 1 if rep.stopped_at or rep.errors else 0


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="ridelake.run")
    ap.add_argument("command", choices=["stations", "trips", "status-stream", "status"])
    ap.add_argument("--landing")
    ap.add_argument("--warehouse", required=True)
    ap.add_argument("--months", default="")
    ap.add_argument("--mode", default="append", choices=["append", "overwrite_days"])
    ap.add_argument("--multi-line", action="store_true")
    ap.add_argument("--extracted-at", default=None,
                    help='"document" = each document\'s own last_updated; default = run time')
    ap.add_argument("--checkpoint")
    ap.add_argument("--trigger", default="300 seconds")
    ap.add_argument("--available-now", action="store_true")
    ap.add_argument("--max-restarts", type=int, default=3)
    ap.add_argument("--quarantine", action="store_true", help="status-stream: accepted; it is the default")
    ap.add_argument("--no-quarantine", action="store_true",
                    help="status-stream: do not keep malformed documents in a quarantine table")
    ap.add_argument("--max-files", type=int, default=DEFAULT_MAX_FILES,
                    help="status-stream: files taken in by a micro-batch")
    ap.add_argument("--as-of")
    ap.add_argument("--tz")
    ap.add_argument("--report-only", action="store_true")
    ap.add_argument("--input-gb", type=float,
                    help="approximate input size: sizes scan/shuffle partitions (cluster_conf)")
    ap.add_argument("--incremental", action="store_true",
                    help="trips: rebuild only the days present in this load")
    ap.add_argument("--by-delivery", action="store_true",
                    help="stations: take the landing as one delivery into the growing dimension, instead of rebuilding it")
    ap.add_argument("--new-only", action="store_true",
                    help="trips: load the deliveries that are new or changed since they were loaded")
    a = ap.parse_args(argv)
    on_error = "report" if a.report_only else "stop"
    spark = get_spark(app=f"ridelake-{a.command}")
    if a.input_gb:
        apply_conf(spark, cluster_conf(int(a.input_gb * 2 ** 30),
                                       spark.sparkContext.defaultParallelism))

    if a.command == "stations" and a.by_delivery:
        delivery = J.read_station_files(spark, a.landing, a.extracted_at, a.multi_line)
        return _report(J.deliver_stations(spark, a.warehouse, delivery, on_error))
    if a.command == "stations":
        J.load_station_files(spark, a.landing, a.warehouse, a.extracted_at, multi_line=a.multi_line)
        return _report(J.build_station_models(spark, a.warehouse, on_error))
    if a.command == "trips":
        months = [m for m in a.months.split(",") if m] or None
        if a.new_only:
            new = J.load_new_deliveries(spark, a.landing, a.warehouse)
            if not new and not J.unfinished(spark, a.warehouse):
                return _report(J.RunReport())  # nothing to build anew
            return _report(J.build_trip_models(spark, a.warehouse, on_error))
        days = J.load_trip_files(spark, a.landing, a.warehouse, months, mode=a.mode)
        return _report(J.build_trip_models(spark, a.warehouse, on_error,
                                           days=days if a.incremental else None))
    if a.command == "status-stream":
        # beside the table it belongs to: one checkpoint a warehouse, kept over restarts
        ckpt = a.checkpoint or f"{a.warehouse}/_checkpoints/status-stream"
        side = None
        if not a.no_quarantine:
            side = start_quarantine_stream(spark, a.landing, f"{a.warehouse}/{J.QUARANTINE}/station_status",
                                           ckpt + "-quarantine", trigger=a.trigger,
                                           available_now=a.available_now,
                                           max_files_per_trigger=a.max_files)
        name = f"status-stream-{uuid.uuid4().hex[:8]}"
        run_reported(spark, lambda: start_status_stream(
            spark, a.landing, f"{a.warehouse}/{J.BRONZE}/station_status", ckpt,
            trigger=a.trigger, available_now=a.available_now,
            max_files_per_trigger=a.max_files, name=name),
            f"{a.warehouse}/_reports/status-stream", name, max_restarts=a.max_restarts)
        if side is not None:
            side.awaitTermination()
        return 0
    return _report(J.build_status_models(spark, a.warehouse, a.as_of, on_error, tz=a.tz))


if __name__ == "__main__":
    sys.exit(main())
