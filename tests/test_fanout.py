"""Trips whose code many current stations carry: one row until the last step, every match after it."""

from pyspark.sql import functions as F

from ridelake.operators.joins import MATCHES, enrich_current, fill_matches, match_current

TRIPS = ("ride_id string, start_station_id string, start_station_name string, start_lat double, start_lng double, "
         "end_station_id string, end_station_name string, end_lat double, end_lng double")
N = MATCHES + 36


def _dim(spark):
    return spark.range(N).select(F.concat(F.lit("st"), "id").alias("station_name"), F.lit("S1").alias("short_name"),
                                 F.col("id").cast("double").alias("lat"), F.lit(-74.0).alias("lon"), F.lit(True).alias("is_current"))


def _trips(spark):
    return spark.createDataFrame([("whole", "S1", "own", 1.0, 2.0, "S1", "own", 1.0, 2.0),
                                  ("gaps", "S1", None, None, 2.0, None, "st3", None, None),
                                  ("none", None, None, None, None, "S9", None, None, None)], TRIPS)


def test_trips_fan_out_after_both_joins(spark):
    matched = match_current(_trips(spark), _dim(spark))
    rows = {r.ride_id: r for r in matched.groupBy("ride_id").agg(
        F.count("*").alias("rows"), F.sum(F.col("__start_n") * F.col("__end_n")).alias("filled"),
        F.count("__start_m").alias("carried")).collect()}
    parts = -(-N // MATCHES)
    assert {k: (r.rows, r.filled, r.carried) for k, r in rows.items()} == {
        "whole": (parts ** 2, N * N, 0), "gaps": (parts, N, parts), "none": (1, 1, 0)}
    assert fill_matches(matched).columns == _trips(spark).columns


def test_fan_out_loses_no_match(spark):
    out = enrich_current(_trips(spark), _dim(spark))
    assert {r[0]: r[1] for r in out.groupBy("ride_id").count().collect()} == {"whole": N * N, "gaps": N, "none": 1}
    gaps = sorted((r.start_station_name, r.start_lat, r.start_lng, r.end_station_id, r.end_lat)
                  for r in out.filter("ride_id = 'gaps'").collect())
    assert gaps == sorted((f"st{i}", float(i), 2.0, "S1", 3.0) for i in range(N))
