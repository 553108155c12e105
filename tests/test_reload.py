import json
import os

import pytest
from pyspark.sql import functions as F

from ridelake import run
from ridelake.operators.asof import one_line
from ridelake.operators.joins import enrich_as_of
from ridelake.plans import jobs as J
from ridelake.plans.models import flatten_status, stg_status, transform_trips
from ridelake.sinks.writers import materialize_table
from ridelake.sources.files import parse_status_messages, read_trips_csv
from ridelake.streaming.status import start_status_stream

HEADER = ("ride_id,rideable_type,started_at,ended_at,start_station_name,start_station_id,"
          "end_station_name,end_station_id,start_lat,start_lng,end_lat,end_lng,member_casual")
TRIP = "{},classic_bike,{},2024-02-01 00:20:00,A,S1,B,S2,40.1,-74.1,40.2,-74.2,member"


def _write(path, *lines):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write("\n".join(lines) + "\n")


def test_reloading_a_month_keeps_the_days_of_others(spark, tmp_dir):
    land, wh = f"{tmp_dir}/land", f"{tmp_dir}/wh"
    _write(f"{land}/month=202401/a.csv", HEADER, TRIP.format("r1", "2024-01-31 10:00:00"), TRIP.format("r2", "2024-01-31 11:00:00"))
    _write(f"{land}/month=202402/b.csv", HEADER, TRIP.format("r3", "2024-01-31 23:59:00"), TRIP.format("r4", "2024-02-01 08:00:00"),
           TRIP.format("bad", "never"))
    J.load_trip_files(spark, land, wh, ["202401"], mode="overwrite_days")
    for _ in range(2):
        J.load_trip_files(spark, land, wh, ["202402"], mode="overwrite_days")
    assert sorted(r.ride_id for r in J.read_bronze_trips(spark, wh).collect()) == ["r1", "r2", "r3", "r4"]
    assert spark.read.parquet(f"{wh}/{J.QUARANTINE}/trips_raw").count() == 1


@pytest.mark.parametrize("setting", ["dynamic", "static"])
def test_full_rebuild_leaves_no_old_day(spark, tmp_dir, setting):
    before = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", setting)
    try:
        two = spark.createDataFrame([(1, "20240101"), (2, "20240102")], "v int, day string")
        materialize_table(two, f"{tmp_dir}/t", "day")
        materialize_table(two.filter("v = 2"), f"{tmp_dir}/t", "day")
        assert [r.v for r in spark.read.parquet(f"{tmp_dir}/t").collect()] == [2]
        materialize_table(two.filter("v = 1"), f"{tmp_dir}/t", "day", replace_days=True)
        assert spark.read.parquet(f"{tmp_dir}/t").count() == 2
    finally:
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", before)


def test_stream_refuses_a_table_of_another_checkpoint(spark, tmp_dir):
    doc = {"last_updated": 10, "data": {"stations": [{"station_id": "u1", "num_bikes_available": 1}]}}
    _write(f"{tmp_dir}/land/a.json", json.dumps(doc))
    start_status_stream(spark, f"{tmp_dir}/land", f"{tmp_dir}/t", f"{tmp_dir}/c1", available_now=True).awaitTermination()
    with pytest.raises(ValueError, match="checkpoint"):
        start_status_stream(spark, f"{tmp_dir}/land", f"{tmp_dir}/t", f"{tmp_dir}/c2", available_now=True)


def test_restarts_and_two_warehouses_lose_nothing(spark, tmp_dir):
    doc = {"last_updated": 10, "data": {"stations": [{"station_id": "u1", "num_bikes_available": 1}]}}
    args = lambda wh: ["status-stream", "--landing", f"{tmp_dir}/land", "--warehouse", f"{tmp_dir}/{wh}", "--available-now"]
    _write(f"{tmp_dir}/land/a.json", json.dumps(doc))
    assert run.main(args("w1")) == 0
    _write(f"{tmp_dir}/land/b.json", json.dumps(doc), '{"last_updated": 11}')
    for wh in ("w1", "w2"):
        assert run.main(args(wh)) == 0
        assert spark.read.parquet(f"{tmp_dir}/{wh}/{J.BRONZE}/station_status").count() == 2
        assert spark.read.parquet(f"{tmp_dir}/{wh}/{J.QUARANTINE}/station_status").count() == 1


def test_header_in_another_order_fails(spark, tmp_dir):
    names = HEADER.split(",")
    names[2], names[3] = names[3], names[2]
    _write(f"{tmp_dir}/m/a.csv", ",".join(names), TRIP.format("r1", "2024-01-31 10:00:00"))
    with pytest.raises(Exception, match="(?i)header"):
        read_trips_csv(spark, f"{tmp_dir}/m").collect()


def test_offsets_in_text_are_honoured(spark):
    raw = spark.createDataFrame([("a", "2024-01-05T05:00:00+05:00"), ("b", "2024-01-05 05:00:00"), ("c", "x"), ("d", "2024-01-05T05:00:00.5Z")],
                                "ride_id string, started_at string")
    cols = [c for c in HEADER.split(",") if c not in raw.columns]
    typed = transform_trips(raw.withColumns({c: F.lit(None).cast("string") for c in cols}), "202401", "2024-02-01 00:00:00")
    got = {r.ride_id: str(r.started_at) for r in typed.collect()}
    assert got == {"a": "2024-01-05 00:00:00", "b": "2024-01-05 05:00:00", "c": "None", "d": "2024-01-05 05:00:00.500000"}
    status = flatten_status(parse_status_messages(spark.createDataFrame(
        [(json.dumps({"last_updated": 1, "data": {"stations": [{"station_id": "u"}]}}),)], "value string")), "2024-02-01 00:00:00")
    text = status.withColumn("ingestion_at", F.explode(F.array(F.lit("2024-01-05T05:00:00+05:00"), F.lit("no time"))))
    assert sorted(str(r.ingestion_at) for r in stg_status(text).collect()) == ["2024-01-05 00:00:00", "None"]


def test_unknown_flag_values_reach_the_checks(spark):
    stations = [{"station_id": str(i), "is_renting": v} for i, v in enumerate([0, 1, True, 2, "yes", None])]
    docs = spark.createDataFrame([(json.dumps({"last_updated": 1, "data": {"stations": stations}}),)], "value string")
    flat = flatten_status(parse_status_messages(docs), "2024-02-01 00:00:00")
    assert [r.is_renting for r in flat.orderBy("station_id").collect()] == [0, 1, 1, 2, -1, None]


def test_both_as_of_plans_agree_on_shared_codes_and_ties(spark):
    dim = spark.sql("""SELECT code, sk, to_timestamp_ntz(f) AS valid_from, to_timestamp_ntz(t) AS valid_to FROM VALUES
      ('A', 'sk1', '2024-01-01', '9999-12-31'), ('A', 'sk2', '2024-01-10', '2024-01-20'),
      ('A', 'zero', '2024-01-10', '2024-01-10'), ('B', 'x', '2024-01-05', '2024-01-05'), ('B', 'y', '2024-01-05', '9999-12-31'),
      (NULL, 'n', '2024-01-01', '9999-12-31') AS v(code, sk, f, t)""")
    facts = spark.sql("""SELECT id, code, to_timestamp_ntz(ts) AS ts FROM VALUES (1, 'A', '2024-01-15'), (2, 'A', '2024-01-25'),
      (3, 'A', '2024-01-10'), (4, 'B', '2024-01-05'), (5, 'B', '2024-01-04'), (6, NULL, '2024-01-15'), (7, 'A', '2024-01-02') AS v(id, code, ts)""")
    got = [sorted((r.id, r.sk) for r in enrich_as_of(facts, dim, "code", "code", "ts", {"sk": "sk"}, strategy=s).collect())
           for s in ("auto", "shuffle", "sorted")]
    assert got[0] == got[1] == [(1, "sk2"), (2, None), (3, "sk2"), (4, "y"), (5, None), (6, None), (7, "sk1")]
    assert one_line(dim, "code").count() == 3


def test_a_day_without_rows_any_more_is_removed(spark, tmp_dir):
    rows = spark.createDataFrame([(1, "2024-01-01"), (2, "2024-01-02"), (3, "2024-01-03")], "v int, day string")
    rows = rows.selectExpr("v", "CAST(day AS date) AS day")
    materialize_table(rows, f"{tmp_dir}/t", "day")
    materialize_table(rows.filter("v = 2"), f"{tmp_dir}/t", "day", days=["2024-01-01", "2024-01-02"], laid_out=True)
    assert sorted(r.v for r in spark.read.parquet(f"{tmp_dir}/t").collect()) == [2, 3]
    materialize_table(rows.filter("v > 9"), f"{tmp_dir}/t", "day", days=["2024-01-03"])
    assert sorted(r.v for r in spark.read.parquet(f"{tmp_dir}/t").collect()) == [2]
