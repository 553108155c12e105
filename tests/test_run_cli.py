"""End to end through the command-line runner on landed files."""
import os

from ridelake import run
from ridelake.plans import jobs as J
from ridelake.plans.tables import Tables
from ridelake.sources import adapters as A
from ridelake.sources import landing as L

SF = "/root/testdata/sf0.001"


def test_cli_end_to_end(spark, tmp_dir):
    t = Tables(spark, SF)
    land, wh = f"{tmp_dir}/landing", f"{tmp_dir}/wh"
    L.write_trip_csv_landing(t.trips_raw, f"{land}/trips")
    L.write_json_lines(L.station_info_documents(t.snapshots), f"{land}/stations")
    L.write_json_lines(L.status_documents(A.table(spark, SF, "events")), f"{land}/status")

    # all history landed at once stamped with one run time -> duplicate snapshots (error)
    assert run.main(["stations", "--landing", f"{land}/stations", "--warehouse", f"{wh}0"]) == 1
    # the capacity not_null check is an error -> stops unless report-only
    stations = ["stations", "--landing", f"{land}/stations", "--extracted-at", "document"]
    assert run.main(stations + ["--warehouse", wh]) == 1
    assert not os.path.exists(f"{wh}/{J.GOLD}/dim_station")
    assert run.main(stations + ["--warehouse", f"{wh}2", "--report-only"]) == 1
    dim = spark.read.parquet(f"{wh}2/{J.GOLD}/dim_station")
    assert dim.filter("is_current").count() == 150

    wh = f"{wh}2"
    assert run.main(["trips", "--landing", f"{land}/trips", "--warehouse", wh]) == 0
    assert spark.read.parquet(f"{wh}/{J.GOLD}/trips_enriched").count() == 1000
    assert run.main(["status-stream", "--landing", f"{land}/status", "--warehouse", wh,
                     "--checkpoint", f"{tmp_dir}/ckpt", "--available-now", "--quarantine"]) == 0
    assert spark.read.parquet(f"{wh}/{J.BRONZE}/station_status").count() == 1000
    assert run.main(["status", "--warehouse", wh, "--as-of", "2024-01-30 12:00:00"]) == 0
    dvs = spark.read.parquet(f"{wh}/{J.GOLD}/demand_vs_supply")
    assert dvs.count() == 15
    assert {r.current_day_name for r in dvs.select("current_day_name").distinct().collect()} == {"Tuesday"}


def test_cli_by_delivery_and_new_only(spark, tmp_dir):
    from pyspark.sql import functions as F

    from ridelake.streaming.report import read_report
    t = Tables(spark, SF)
    land, wh = f"{tmp_dir}/landing", f"{tmp_dir}/wh"
    full = t.snapshots.withColumn("capacity", F.coalesce("capacity", F.lit(5)))
    late = F.pmod(F.xxhash64("station_id"), F.lit(7)) == 0
    for k, part in enumerate((full.filter(~late), full.filter(late))):
        L.write_json_lines(L.station_info_documents(part), f"{land}/stations{k}")
        assert run.main(["stations", "--landing", f"{land}/stations{k}", "--extracted-at", "document", "--warehouse", wh, "--by-delivery"]) == 0
    # a delivery that fails its checks is not taken
    L.write_json_lines(L.station_info_documents(full.limit(50).withColumn("capacity", F.lit(None).cast("int"))), f"{land}/bad")
    before = J.read_dim_station(spark, wh).count()
    assert run.main(["stations", "--landing", f"{land}/bad", "--extracted-at", "document", "--warehouse", wh, "--by-delivery"]) == 1
    assert J.read_dim_station(spark, wh).count() == before
    from ridelake.plans import models as M
    whole = M.dim_station(M.stg_stations(full))
    got = J.read_dim_station(spark, wh).select(*whole.columns)
    assert got.exceptAll(whole).count() == 0 and whole.exceptAll(got).count() == 0

    L.write_trip_csv_landing(t.trips_raw, f"{land}/trips")
    new = ["trips", "--landing", f"{land}/trips", "--warehouse", wh, "--new-only"]
    assert run.main(new) == 0 and run.main(new) == 0
    assert spark.read.parquet(f"{wh}/{J.GOLD}/trips_enriched").count() == 1000
    assert sorted(os.listdir(f"{wh}/{J.MANIFEST}/trips_raw")) == ["run=0"]
    L.write_json_lines(L.status_documents(A.table(spark, SF, "events")), f"{land}/status")
    assert run.main(["status-stream", "--landing", f"{land}/status", "--warehouse", wh, "--available-now"]) == 0
    kinds = {r.kind for r in read_report(spark, f"{wh}/_reports/status-stream").collect()}
    assert {"started", "progress", "ended"} <= kinds
    assert "dim_station" in J.register_views(spark, wh)
