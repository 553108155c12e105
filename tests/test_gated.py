"""Loads whose stations fail their checks: no dimension, no later layer, and no error."""

from datetime import datetime

import pytest

from ridelake.plans import growth
from ridelake.plans import jobs as J
from ridelake.plans.tables import Tables

EVENT = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
ORDER = "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string"


def _tables(spark, folder, orders, types=("view", "purchase")):
    events = [(i, datetime(2024, 1, 1 + i % 3, 8, i), i % 4, types[i % len(types)], 1.0, "{}") for i in range(20)]
    spark.createDataFrame(events, EVENT).write.parquet(f"{folder}/events.parquet")
    spark.createDataFrame(orders, ORDER).write.parquet(f"{folder}/orders.parquet")
    return Tables(spark, folder)


def _order(key, customer):
    return key, customer, "O", 1.0, datetime(1998, 1, 1), "1-URGENT"


def _layers(df):
    return {r.layer: (r.n_rows, r.n_faulty, r.first_stop, r.second_stop) for r in df.collect()}


def test_good_stations_publish_every_layer(spark, tmp_dir):
    got = _layers(growth.gated_layer(_tables(spark, tmp_dir, [_order(i, i) for i in range(4)])))
    assert set(got) == {"stg_trips", "int_trips", "dim_station", "trips_enriched", "hourly_traffic"}
    assert got["trips_enriched"] == (20, 0, "None", "stg_trips")


def test_repeated_snapshots_stop_the_enriched_layer(spark, tmp_dir):
    got = _layers(growth.gated_layer(_tables(spark, tmp_dir, [_order(i, i) for i in (0, 1, 2, 3, 3)])))
    assert got == {n: (20, 0, "stg_stations", "stg_trips") for n in ("stg_trips", "int_trips")}


def test_no_layer_at_all(spark, tmp_dir):
    _tables(spark, tmp_dir, [_order(0, None)])
    bad = spark.read.parquet(f"{tmp_dir}/events.parquet").selectExpr("cast(null as bigint) AS event_id", "* EXCEPT (event_id)")
    bad.write.parquet(f"{tmp_dir}/null/events.parquet")
    spark.read.parquet(f"{tmp_dir}/orders.parquet").write.parquet(f"{tmp_dir}/null/orders.parquet")
    assert growth.gated_layer(Tables(spark, f"{tmp_dir}/null")).collect() == []


@pytest.mark.parametrize("dim, stop", [(False, "dim_station"), (True, "hourly_traffic")])
def test_status_stops_at_what_is_not_published(spark, tmp_dir, dim, stop):
    t = _tables(spark, tmp_dir, [_order(i, i) for i in range(4)])
    t.status_raw.write.parquet(f"{tmp_dir}/w/{J.BRONZE}/station_status")
    if dim:
        t.snapshots.write.parquet(f"{tmp_dir}/w/{J.BRONZE}/station_snapshots")
        assert J.build_station_models(spark, f"{tmp_dir}/w").stopped_at is None
    assert J.build_status_models(spark, f"{tmp_dir}/w", t.as_of).stopped_at == stop
