"""How the layered job writes: no sample of bronze rows, and a task holds trips, not what they are filled to."""

from datetime import date, datetime

from pyspark.sql import functions as F

from ridelake.operators.joins import MATCHES
from ridelake.plans import jobs as J
from ridelake.plans import models as M
from ridelake.sinks.writers import OPEN_DAYS, materialize_table

TRIPS = 100
OPEN_FILES = "spark.sql.maxConcurrentOutputFileWriters"


def _counted(df, seen):
    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b
    return df.mapInArrow(count, df.schema)


def _bronze(spark):
    start = F.make_timestamp_ntz(F.lit(2024), F.lit(1), (F.col("id") % 3 + 1).cast("int"), F.lit(8), F.lit(0), F.lit(0))
    return spark.range(TRIPS).select(
        F.lit(datetime(2024, 2, 1)).cast("timestamp_ntz").alias("ingestion_at"), F.lit("202401").alias("source_month"),
        F.lit("batch").alias("source_data"), F.col("id").cast("string").alias("ride_id"), F.lit("classic_bike").alias("rideable_type"),
        start.alias("started_at"), start.alias("ended_at"),
        F.when(F.col("id") % 4 != 0, F.concat(F.lit("S"), F.col("id") % 2)).alias("start_station_id"), F.lit("N").alias("start_station_name"),
        F.lit("S0").alias("end_station_id"), F.lit(None).cast("string").alias("end_station_name"),
        *[F.lit(1.0).alias(c) for c in ("start_lat", "end_lat", "start_lng", "end_lng")], F.lit("member").alias("member_casual"))


def _dim(spark):
    return spark.range(2 * MATCHES).select(F.lit("N").alias("station_name"), F.concat(F.lit("S"), F.col("id") % 2).alias("short_name"),
                                           F.col("id").cast("double").alias("lat"), F.lit(1.0).alias("lon"), F.lit(True).alias("is_current"))


def test_bronze_rows_are_written_without_a_sample(spark, tmp_dir):
    seen = spark.sparkContext.accumulator(0)
    assert J.load_trips_raw(_counted(_bronze(spark), seen), tmp_dir) == ["20240101", "20240102", "20240103"]
    assert seen.value == 2 * TRIPS  # by the write, and for the days it returns
    assert spark.read.parquet(f"{tmp_dir}/{J.BRONZE}/trips_raw").count() == TRIPS
    assert J.load_trips_raw(_bronze(spark).limit(0), f"{tmp_dir}/none") == []


def test_trips_decide_the_partitions(spark, monkeypatch):
    """The sample of the layout goes to the driver and grows with the partitions; the fan-out doesn't add to it."""
    monkeypatch.setattr(J, "TASK_ROWS", 1000)
    laid = J._laid_out_matches(M.trips_matched(M.int_trips(M.stg_trips(_bronze(spark))), _dim(spark)))
    assert laid.selectExpr("sum(__start_n * __end_n)").first()[0] > TRIPS * MATCHES ** 2 / 2
    assert laid.rdd.getNumPartitions() == 1


def test_filled_rows_are_written_as_they_come(spark, tmp_dir):
    before = spark.conf.get(OPEN_FILES)
    matched = M.trips_matched(M.int_trips(M.stg_trips(_bronze(spark))), _dim(spark))
    want = M.enriched_from(matched)
    materialize_table(M.enriched_from(J._laid_out_matches(matched)), f"{tmp_dir}/t", "started_date", in_order=True)
    got = spark.read.schema(want.schema).parquet(f"{tmp_dir}/t")
    total = [F.count("*").alias("n"), F.sum(F.xxhash64(*want.columns).cast("decimal(38,0)")).alias("h")]
    assert got.select(want.columns).agg(*total).first() == want.agg(*total).first()
    assert spark.conf.get(OPEN_FILES) == before


def test_more_days_than_are_kept_open(spark, tmp_dir):
    days = [date(2024, 1, 1 + k) for k in range(OPEN_DAYS + 5)]
    rows = spark.createDataFrame([(d, i) for i in range(4) for d in days], "day date, i int").coalesce(1)
    materialize_table(rows, f"{tmp_dir}/t", "day", in_order=True)
    got = spark.read.parquet(f"{tmp_dir}/t").groupBy("day").agg(F.sort_array(F.collect_list("i"))).collect()
    assert sorted((r[0], r[1]) for r in got) == [(d, [0, 1, 2, 3]) for d in days]
