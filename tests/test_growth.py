"""Loads that take only what is new, layers that are published after their checks, buckets."""

import os
import shutil

import pytest
from pyspark.sql import functions as F

from ridelake.plans import jobs as J
from ridelake.plans import models as M
from ridelake.plans.tables import Tables
from ridelake.sinks.writers import append_snapshot, open_bucketed, promote, write_bucketed
from ridelake.sources import landing as L
from ridelake.sources.files import parse_open_messages, read_station_snapshot_json

SF = "/root/testdata/sf0.001"
AT = "2024-02-01 00:00:00"


def bronze(spark, root):
    return {(r[0], r[1]): r[2] for r in J.read_bronze_trips(spark, root).groupBy("source_month", "date_str").count().collect()}


def test_loads_take_only_new_and_changed_files(spark, tmp_dir):
    t = Tables(spark, SF)
    landing, wh = f"{tmp_dir}/landing", f"{tmp_dir}/wh"
    L.write_trip_csv_landing(t.trips_raw, landing)
    assert J.load_new_deliveries(spark, landing, wh, AT) == ["202401", "202402"]
    first = bronze(spark, wh)
    assert sum(first.values()) == 1167
    assert J.load_new_deliveries(spark, landing, wh, AT) == []
    # one delivery gets another part: it is loaded again whole, the other isn't touched
    extra = t.trips_raw.filter("source_month = '202402'").limit(7)
    extra.select(*[c for c in L.trip_csv_columns(extra).columns if c != "month"]).selectExpr(
        *[f"CAST({c} AS STRING) AS {c}" for c in L.trip_csv_columns(extra).columns if c != "month"]).coalesce(1).write.option(
        "header", True).csv(f"{landing}/month=202402/part2")
    assert J.load_new_deliveries(spark, landing, wh, AT) == ["202402"]
    assert sum(bronze(spark, wh).values()) == 1174
    # a file goes, and with it its rows (also those of days that no other file has)
    shutil.rmtree(f"{landing}/month=202402/part2")
    assert J.load_new_deliveries(spark, landing, wh, AT) == ["202402"]
    assert bronze(spark, wh) == first
    assert J.load_new_deliveries(spark, landing, wh, AT) == []


def test_a_load_that_fails_is_repeated(spark, tmp_dir, monkeypatch):
    t = Tables(spark, SF)
    landing, wh = f"{tmp_dir}/landing", f"{tmp_dir}/wh"
    L.write_trip_csv_landing(t.trips_raw, landing)

    def broken(*_, **__):
        raise OSError("lost")
    with monkeypatch.context() as m:
        m.setattr(J, "load_trip_files", broken)
        with pytest.raises(OSError):
            J.load_new_deliveries(spark, landing, wh, AT)
    assert J.load_new_deliveries(spark, landing, wh, AT) == ["202401", "202402"]
    assert sum(bronze(spark, wh).values()) == 1167


def good_warehouse(spark, tmp_dir):
    t = Tables(spark, SF)
    append_snapshot(t.snapshots.withColumn("capacity", F.coalesce("capacity", F.lit(0))), f"{tmp_dir}/{J.BRONZE}/station_snapshots")
    assert J.build_station_models(spark, tmp_dir).stopped_at is None
    J.load_trips_raw(t.trips_raw, tmp_dir, mode="overwrite_days")
    assert J.build_trip_models(spark, tmp_dir).stopped_at is None
    return t


def test_a_failing_layer_is_never_seen(spark, tmp_dir):
    t = good_warehouse(spark, tmp_dir)
    names = [f"{tmp_dir}/{layer}/{n}" for layer, n in ((J.STAGING, "stg_trips"), (J.SILVER, "int_trips"), (J.GOLD, "trips_enriched"))]
    before = [spark.read.parquet(p).count() for p in names]
    J.load_trips_raw(t.trips_raw.withColumn("member_casual", F.lit("guest")), tmp_dir, mode="overwrite_days")
    report = J.build_trip_models(spark, tmp_dir)
    assert report.stopped_at == "stg_trips"
    assert [spark.read.parquet(p).count() for p in names] == before
    assert not any(spark.read.parquet(p).filter("member_casual = 'guest'").count() for p in names)
    assert spark.read.parquet(f"{tmp_dir}/{J.STAGED}/{J.STAGING}/stg_trips").filter("member_casual = 'guest'").count() == 1000
    # mended, the same days go through
    days = J.load_trips_raw(t.trips_raw, tmp_dir, mode="overwrite_days")
    assert J.build_trip_models(spark, tmp_dir, days=days[:3]).stopped_at is None
    assert [spark.read.parquet(p).count() for p in names] == before


def test_promote_replaces_and_removes_days(spark, tmp_dir):
    def write(path, days):
        spark.createDataFrame([(d, v) for d, v in days], "day string, v int").write.partitionBy("day").parquet(path)
    write(f"{tmp_dir}/t", [("1", 1), ("2", 1), ("3", 1)])
    write(f"{tmp_dir}/s", [("2", 9)])
    promote(spark, f"{tmp_dir}/s", f"{tmp_dir}/t", "day", ["2", "3"])
    assert sorted((str(r.day), r.v) for r in spark.read.parquet(f"{tmp_dir}/t").collect()) == [("1", 1), ("2", 9)]
    assert not os.path.exists(f"{tmp_dir}/s.before")


def test_bucketed_trips_need_no_exchange(spark, tmp_dir):
    t = Tables(spark, SF)
    by = ["started_date", "started_hour", "start_station_id"]
    trips = write_bucketed(t.trips_enriched, "growth_trips", f"{tmp_dir}/b", by, 5)
    hourly = M.hourly_traffic(trips)
    plan = hourly._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Bucketed: true" in plan
    want = t.hourly_traffic
    assert hourly.exceptAll(want).count() == 0 and want.exceptAll(hourly).count() == 0
    assert len([f for f in os.listdir(f"{tmp_dir}/b") if f.endswith(".parquet")]) == 5
    spark.sql("DROP TABLE growth_trips")
    again = open_bucketed(spark, "growth_again", f"{tmp_dir}/b", trips.schema, by, 5)
    assert "Exchange" not in M.hourly_traffic(again)._jdf.queryExecution().executedPlan().toString() and again.count() == 1000
    spark.sql("DROP TABLE growth_again")


def test_open_documents_keep_unknown_fields(spark):
    rows = [('{"last_updated": 5, "data": {"stations": [{"station_id": "a", "n": 3, "f": true, "z": {"q": [1]}, "b": null}]}}',),
            ('{"last_updated": 6, "data": {"stations": [{"station_id": "b", "n": "4", "f": 0}]}}',), ("no document",), ('{"data": {}}',), (None,)]
    docs = parse_open_messages(spark.createDataFrame(rows, "value string"))
    got = {r.station_id: r for r in M.flatten_open_status(docs, ["n", "f"]).collect()}
    assert set(got) == {"a", "b"}
    assert (got["a"].feed_last_updated, got["a"].n, got["a"].f, got["a"].extras) == (5, 3, 1, '{"b":null,"z":"{\\"q\\":[1]}"}')
    assert (got["b"].n, got["b"].f, got["b"].extras) == (4, 0, None)


def test_station_documents_over_several_lines(spark, tmp_dir):
    os.makedirs(f"{tmp_dir}/in")
    with open(f"{tmp_dir}/in/a.json", "w") as f:
        f.write('{\n "last_updated": 1700000000,\n "data": {"stations": [\n  {"station_id": " x ", "name": "N",\n   "lon": "1.5"}\n ]}\n}\n')
    got = M.transform_stations(read_station_snapshot_json(spark, f"{tmp_dir}/in"), "document").collect()
    assert [(r.station_id, r.station_name, r.lon) for r in got] == [("x", "N", 1.5)]
