from datetime import datetime

from pyspark.sql import functions as F

from ridelake.operators.joins import enrich_as_of, enrich_current, fanout_keys, lookup, orphans

DIM = ("station_id string, station_name string, short_name string, lat double, lon double, "
       "valid_from timestamp_ntz, valid_to timestamp_ntz, is_current boolean")
TRIPS = ("ride_id string, start_station_id string, start_station_name string, start_lat double, "
         "start_lng double, end_station_id string, end_station_name string, end_lat double, end_lng double")
OPEN = datetime(9999, 12, 31, 23, 59, 59)


def _dim(spark, rows):
    return spark.createDataFrame(rows, DIM)


def test_code_then_name_fallback(spark):
    dim = _dim(spark, [("u1", "Alpha", "A1", 1.0, 2.0, datetime(2020, 1, 1), OPEN, True),
                       ("u2", "Beta", "B1", 3.0, 4.0, datetime(2020, 1, 1), OPEN, True)])
    trips = spark.createDataFrame([
        ("t1", "A1", None, None, None, None, "Beta", None, None),    # code match / name fallback
        ("t2", "ZZ", "Alpha", None, None, "B1", "Alpha", 9.0, 9.0),   # unknown code: no name fallback
    ], TRIPS)
    got = {r.ride_id: r for r in enrich_current(trips, dim).collect()}
    assert got["t1"].start_station_name == "Alpha" and got["t1"].start_lat == 1.0
    assert got["t1"].end_station_id == "B1" and got["t1"].end_lng == 4.0
    assert got["t2"].start_station_id == "ZZ" and got["t2"].start_lat is None
    assert got["t2"].end_station_name == "Alpha" and got["t2"].end_lat == 9.0


def test_fanout_detected(spark):
    dim = _dim(spark, [("u1", "Alpha", "A1", 1.0, 2.0, datetime(2020, 1, 1), OPEN, True),
                       ("u9", "Alpha2", "A1", 1.0, 2.0, datetime(2020, 1, 1), OPEN, True)])
    trips = spark.createDataFrame([("t1", "A1", None, None, None, "A1", None, None, None)], TRIPS)
    out = enrich_current(trips, dim)
    assert out.count() == 4
    assert fanout_keys(out, ["ride_id"]).count() == 1


def test_as_of_half_open_boundary(spark):
    b = datetime(2024, 1, 10)
    dim = _dim(spark, [("u1", "Old", "A1", 1.0, 1.0, datetime(2024, 1, 1), b, False),
                       ("u1", "New", "A1", 2.0, 2.0, b, OPEN, True)])
    facts = spark.createDataFrame([("f1", "A1", b), ("f2", "A1", datetime(2023, 1, 1)),
                                   ("f3", "A1", datetime(2024, 1, 9, 23))],
                                  "id string, code string, ts timestamp_ntz")
    out = {r.id: r.name for r in
           enrich_as_of(facts, dim, "code", "short_name", "ts", {"station_name": "name"}).collect()}
    assert out == {"f1": "New", "f2": None, "f3": "Old"}


def test_orphans_skip_null_children(spark):
    child = spark.createDataFrame([("A",), ("Z",), (None,)], "c string")
    parent = spark.createDataFrame([("A",), ("A",)], "p string")
    assert [r.c for r in orphans(child, "c", parent, "p").collect()] == ["Z"]


def test_small_side_is_broadcast_without_a_hint(spark):
    left = spark.range(100).withColumn("k", F.col("id") % 10)
    dim = spark.range(10).withColumnRenamed("id", "k2").withColumn("v", F.col("k2") * 2)
    out = lookup(left, dim, {"k": "k2"}, {"v": "v"}, strategy="auto")
    assert out.count() == 100
    from helpers import plan_text
    assert "BroadcastHashJoin" in plan_text(out)


def test_shuffle_strategy_matches_broadcast(spark):
    from ridelake.plans.tables import Tables
    from ridelake.plans import models as M
    spark.catalog.clearCache()  # a frame cached by another test would answer for both plans
    t = Tables(spark, "/root/testdata/sf0.001")
    a = M.trips_enriched(t.int_trips, t.dim_station, strategy="shuffle")
    b = M.trips_enriched(t.int_trips, t.dim_station, strategy="auto")
    assert a.count() == 1000
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    from helpers import plan_text
    assert "SortMergeJoin" in plan_text(a)


def test_as_of_time_buckets_match_plain(spark):
    from ridelake.plans.tables import Tables
    from ridelake.plans import models as M
    t = Tables(spark, "/root/testdata/sf0.01")
    plain = M.trips_station_as_of(t.int_trips, t.dim_station, time_bucket=None)
    for b in ("month", "day"):
        got = M.trips_station_as_of(t.int_trips, t.dim_station, time_bucket=b)
        assert got.count() == 10000
        assert plain.exceptAll(got).count() == 0 and got.exceptAll(plain).count() == 0
    assert plain.filter("start_station_sk IS NOT NULL").count() == 8457


def test_as_of_boundary_with_buckets(spark):
    b = datetime(2024, 2, 1)
    dim = _dim(spark, [("u1", "Old", "A1", 1.0, 1.0, datetime(2023, 12, 15), b, False),
                       ("u1", "New", "A1", 2.0, 2.0, b, OPEN, True)])
    facts = spark.createDataFrame([("f1", "A1", b), ("f3", "A1", datetime(2024, 1, 31, 23)),
                                   ("f4", "A1", None)], "id string, code string, ts timestamp_ntz")
    out = {r.id: r.name for r in enrich_as_of(facts, dim, "code", "short_name", "ts",
                                               {"station_name": "name"}, time_bucket="month").collect()}
    assert out == {"f1": "New", "f3": "Old", "f4": None}


def test_planner_choice_and_salted_shuffle_agree(spark):

    left = spark.range(200).withColumn("k", F.when(F.col("id") % 4 == 0, None).otherwise(F.col("id") % 10))
    dim = spark.range(10).withColumnRenamed("id", "k2").withColumn("v", F.col("k2") * 2)
    small = lookup(left, dim, {"k": "k2"}, {"v": "v"}, strategy="auto")
    big = lookup(left, dim, {"k": "k2"}, {"v": "v"}, strategy="shuffle")
    from helpers import plan_text
    assert "BroadcastHashJoin" in plan_text(small) and "SortMergeJoin" in plan_text(big)
    assert small.exceptAll(big).count() == 0 and big.exceptAll(small).count() == 0
    assert big.filter("v IS NULL").count() == 50


def test_no_job_runs_while_a_plan_is_built(spark):
    """Size checks, spans and totals are part of the plan, not jobs before it."""
    from ridelake.plans.registry import queries
    tracker = spark.sparkContext.statusTracker()
    names = ["enriched_flags", "enrich_as_of", "scd2_stations", "flag_distribution", "status_current",
             "demand_vs_supply", "hourly_traffic", "dq_relationships", "join_fanout"]
    found = {}
    for name in names:
        spark.sparkContext.setJobGroup(f"plan-{name}", name)
        queries()[name](spark, "/root/testdata/sf0.001")
        found[name] = len(tracker.getJobIdsForGroup(f"plan-{name}"))
    spark.sparkContext.setJobGroup("tests", "tests")
    # opening a Parquet table without a schema reads one footer in a job of its own
    assert max(found.values()) <= 3, found
