"""Counts from the fixture adapters at sf0.001 (FIXTURES.md B5)."""
from pyspark.sql import functions as F

from ridelake.plans.tables import Tables

SF = "/root/testdata/sf0.001"


def test_b5_counts(spark):
    t = Tables(spark, SF)
    assert t.trips_raw.count() == 1167
    assert t.stg_trips.count() == 1000
    assert t.trips_enriched.count() == 1000
    assert t.snapshots.count() == 1500
    assert t.dim_station.count() == 742
    assert t.dim_station.filter("is_current").count() == 150
    flags = {r[0]: r[1] for r in t.trips_enriched.groupBy("data_quality_flag").count().collect()}
    assert flags == {"valid": 836, "missing_start_data": 48, "missing_end_data": 62,
                     "negative_duration": 19, "zero_duration": 18, "excessive_duration": 17}
    assert t.hourly_traffic.count() == 945
    supply = {r[0]: r[1] for r in t.demand_vs_supply.groupBy("supply_status").count().collect()}
    assert supply == {"empty": 3, "full": 1, "no_historical_data": 7, "normal": 4}


def test_kept_delivery_split(spark):
    t = Tables(spark, SF)
    by = {str(r[0]): r[1] for r in t.stg_trips.groupBy(F.to_date("ingestion_at")).count().collect()}
    assert by == {"2024-02-01": 933, "2024-02-15": 67}
