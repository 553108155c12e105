from datetime import datetime

from ridelake.operators.dedup import latest_per_key
from helpers import plan_text
from ridelake.plans.models import stg_trips
from ridelake.schemas import TRIPS_RAW_COLUMNS

D = datetime


def _raw(spark, rows):
    base = {c: None for c in TRIPS_RAW_COLUMNS}
    full = []
    for r in rows:
        x = dict(base, **r)
        full.append(tuple(x[c] for c in TRIPS_RAW_COLUMNS))
    schema = ("ingestion_at timestamp_ntz, source_month string, source_data string, ride_id string, "
              "rideable_type string, started_at timestamp_ntz, ended_at timestamp_ntz, "
              "start_station_id string, start_station_name string, end_station_id string, "
              "end_station_name string, start_lat double, end_lat double, start_lng double, "
              "end_lng double, member_casual string")
    return spark.createDataFrame(full, schema)


def test_month_match_beats_newer_delivery(spark):
    s, e = D(2024, 1, 5, 8), D(2024, 1, 5, 9)
    df = _raw(spark, [
        dict(ride_id="r", started_at=s, ended_at=e, source_month="202401", ingestion_at=D(2024, 2, 1), rideable_type="a"),
        dict(ride_id="r", started_at=s, ended_at=e, source_month="202402", ingestion_at=D(2024, 3, 1), rideable_type="b"),
    ])
    out = stg_trips(df).collect()
    assert len(out) == 1 and out[0].rideable_type == "a"


def test_both_months_wrong_newest_wins(spark):
    s, e = D(2024, 1, 5, 8), D(2024, 1, 5, 9)
    df = _raw(spark, [
        dict(ride_id="r", started_at=s, ended_at=e, source_month="202402", ingestion_at=D(2024, 3, 1), rideable_type="old"),
        dict(ride_id="r", started_at=s, ended_at=e, source_month="202403", ingestion_at=D(2024, 4, 1), rideable_type="new"),
    ])
    assert [r.rideable_type for r in stg_trips(df).collect()] == ["new"]


def test_null_key_is_one_group(spark):
    df = _raw(spark, [
        dict(ride_id=None, started_at=None, ended_at=None, source_month="202401", ingestion_at=D(2024, 2, 1)),
        dict(ride_id=None, started_at=None, ended_at=None, source_month="202401", ingestion_at=D(2024, 2, 2)),
    ])
    out = stg_trips(df).collect()
    assert len(out) == 1 and out[0].ingestion_at == D(2024, 2, 2)


def test_latest_per_key_null_ts_last(spark):
    df = spark.createDataFrame([("a", None, 1), ("a", D(2024, 1, 1), 2), ("b", None, 3)],
                               "k string, ts timestamp_ntz, v int")
    got = {r.k: r.v for r in latest_per_key(df, ["k"], "ts").collect()}
    assert got == {"a": 2, "b": 3}


def test_plan_has_partial_group_limit(spark):
    df = spark.createDataFrame([("a", D(2024, 1, 1), 1)], "k string, ts timestamp_ntz, v int")
    assert "WindowGroupLimit" in plan_text(latest_per_key(df, ["k"], "ts"))
