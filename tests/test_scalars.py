from datetime import datetime


from ridelake.functions import scalars as S


def _one(spark, rows, schema, expr):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(expr).collect()]


def test_time_of_day_edges(spark):
    hours = [5, 6, 10, 11, 15, 16, 18, 19, 23, 0, None]
    got = _one(spark, [(h,) for h in hours], "h int", S.time_of_day("h"))
    assert got == ["Late Night", "Morning", "Morning", "Afternoon", "Afternoon", "Evening",
                   "Evening", "Night", "Night", "Late Night", "Night"]


def test_weekend_and_weekday_name(spark):
    rows = [(datetime(2024, 1, 6, 9),), (datetime(2024, 1, 7, 9),), (datetime(2024, 1, 8, 9),), (None,)]
    df = spark.createDataFrame(rows, "ts timestamp_ntz")
    got = df.select(S.is_weekend("ts"), S.weekday_name("ts")).collect()
    assert [r[0] for r in got] == [True, True, False, False]
    assert [r[1] for r in got] == ["Saturday", "Sunday", "Monday", None]


def test_elapsed_seconds_truncates(spark):
    rows = [(datetime(2024, 1, 1, 0, 0, 0, 900000), datetime(2024, 1, 1, 0, 0, 2, 100000))]
    df = spark.createDataFrame(rows, "a timestamp_ntz, b timestamp_ntz")
    assert df.select(S.elapsed_seconds("a", "b")).first()[0] == 1
    assert df.select(S.elapsed_seconds("b", "a")).first()[0] == -1


def test_minutes_rounding(spark):
    got = _one(spark, [(1,), (30,), (-30,), (89,), (None,)], "s long", S.minutes_2dp("s"))
    assert got == [0.02, 0.5, -0.5, 1.48, None]


def test_quality_flag_order_and_bounds(spark):
    rows = [  # sid, slat, slng, eid, elat, elng, dur
        (None, 1.0, 1.0, None, None, None, -5),
        ("a", 1.0, 1.0, None, 1.0, 1.0, -5),
        ("a", 1.0, 1.0, "b", 1.0, 1.0, -5),
        ("a", 1.0, 1.0, "b", 1.0, 1.0, 0),
        ("a", 1.0, 1.0, "b", 1.0, 1.0, 86400),
        ("a", 1.0, 1.0, "b", 1.0, 1.0, 86401),
        ("a", 1.0, 1.0, "b", 1.0, 1.0, None),
    ]
    schema = "sid string, slat double, slng double, eid string, elat double, elng double, d long"
    got = _one(spark, rows, schema, S.data_quality_flag("sid", "slat", "slng", "eid", "elat", "elng", "d"))
    assert got == ["missing_start_data", "missing_end_data", "negative_duration", "zero_duration",
                   "valid", "excessive_duration", "valid"]


def test_supply_status_empty_wins(spark):
    rows = [(0, 0, 1.0), (3, 0, 1.0), (3, 2, None), (3, 2, 2.0)]
    got = _one(spark, rows, "b long, d long, h double", S.supply_status("b", "d", "h"))
    assert got == ["empty", "full", "no_historical_data", "normal"]


def test_safe_divide_and_surrogate_key(spark):
    df = spark.createDataFrame([(10, 0), (10, 4)], "a long, b long")
    assert [r[0] for r in df.select(S.safe_divide("a", "b")).collect()] == [None, 2.5]
    df2 = spark.createDataFrame([("x", datetime(2024, 1, 1)), (None, datetime(2024, 1, 1))],
                                "k string, t timestamp_ntz")
    keys = [r[0] for r in df2.select(S.surrogate_key("k", "t")).collect()]
    import hashlib
    assert keys[0] == hashlib.md5(b"x2024-01-01 00:00:00.000000").hexdigest()
    assert keys[1] is None


def test_epoch_round_trip(spark):
    df = spark.createDataFrame([(1706616000,)], "e long")
    r = df.select(S.epoch_seconds_to_ts("e").alias("t")).select("t", S.ts_to_epoch_seconds("t")).first()
    assert r[0] == datetime(2024, 1, 30, 12, 0, 0) and r[1] == 1706616000


def test_zone_independent_at_dst_gap(spark):
    """Wall-clock NTZ arithmetic must not move through the session zone."""
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = spark.createDataFrame([(datetime(2022, 3, 13, 1, 30), datetime(2022, 3, 13, 2, 45, 45, 120000))],
                                   "a timestamp_ntz, b timestamp_ntz")
        r = df.select(S.elapsed_seconds("a", "b"), S.ts_to_epoch_seconds("b"),
                      S.ts_text("b", micros=True), S.ts_text("b"), S.day_key("b")).first()
        assert r[0] == 4545 and r[1] == 1647139545
        assert r[2] == "2022-03-13 02:45:45.120000" and r[3] == "2022-03-13 02:45:45"
        assert r[4] == "20220313"
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
