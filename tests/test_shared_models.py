"""What the checks of all models share is written once, before trips fan out."""

from ridelake.plans import models as M
from ridelake.plans.tables import Tables


def _own_tables(spark, folder):
    """20 trips of a station whose code two customers share (five digits of 123456 and 123457)."""
    spark.range(20).selectExpr("id AS event_id", "TIMESTAMP_NTZ'2024-01-05 10:00:00' + id * INTERVAL '1' HOUR AS ts", "12345L AS user_id",
                               "'view' AS event_type", "1.0D AS value", "'{}' AS props").write.parquet(f"{folder}/events.parquet")
    spark.range(2).selectExpr("id AS o_orderkey", "123456L + id AS o_custkey", "'F' AS o_orderstatus", "1.0D AS o_totalprice",
                              "TIMESTAMP_NTZ'1996-01-01 00:00:00' AS o_orderdate", "'1-URGENT' AS o_orderpriority"
                              ).write.parquet(f"{folder}/orders.parquet")


def test_shared_trips_are_matched_ones(spark, tmp_dir):
    from ridelake.plans.registry import check_results
    _own_tables(spark, tmp_dir)
    t = Tables(spark, tmp_dir)
    whole = Tables(spark, tmp_dir).trips_enriched.count()
    check_results(t, ["unique_combination"])
    assert t.trips_matched.inputFiles() and all("/checked/trips_matched/" in f for f in t.trips_matched.inputFiles())
    assert t.stg_trips.inputFiles() and all("/checked/stg_trips/" in f for f in t.stg_trips.inputFiles())
    assert t.trips_enriched.columns == M.trips_enriched(t.int_trips, t.dim_station).columns
    assert t.trips_matched.count() == 20 < whole == t.trips_enriched.count()
