from datetime import datetime, timedelta

from ridelake.plans.models import dim_station

T0 = datetime(2024, 1, 1)
COLS = ("station_id string, station_name string, short_name string, lon double, lat double, "
        "region_id string, capacity int, rental_uri_android string, rental_uri_ios string, "
        "extracted_at timestamp_ntz")


def snap(sid, day, name="N", short="S1", cap=10, uri="u", lat=1.0):
    return (sid, name, short, 2.0, lat, "r", cap, uri, uri, T0 + timedelta(days=day))


def versions(spark, rows):
    d = dim_station(spark.createDataFrame(rows, COLS))
    return sorted(d.collect(), key=lambda r: (r.station_id, r.valid_from))


def test_a_b_a_gives_three_versions(spark):
    v = versions(spark, [snap("x", 0, cap=10), snap("x", 1, cap=20), snap("x", 2, cap=10)])
    assert [r.capacity for r in v] == [10, 20, 10]
    assert [r.is_current for r in v] == [False, False, True]
    assert v[0].valid_to == v[1].valid_from and v[1].valid_to == v[2].valid_from
    assert v[2].valid_to == datetime(9999, 12, 31, 23, 59, 59)


def test_null_value_transitions_do_not_version(spark):
    v = versions(spark, [snap("x", 0, cap=None), snap("x", 1, cap=10), snap("x", 2, cap=None)])
    assert len(v) == 1 and v[0].capacity is None and v[0].is_current


def test_null_previous_name_counts_as_change(spark):
    v = versions(spark, [snap("x", 0, name=None), snap("x", 1, name="N"), snap("x", 2, name="N")])
    assert len(v) == 2


def test_untracked_change_keeps_first_values(spark):
    v = versions(spark, [snap("x", 0, uri="a"), snap("x", 1, uri="b")])
    assert len(v) == 1 and v[0].rental_uri_android == "a"


def test_absent_station_stays_current(spark):
    v = versions(spark, [snap("x", 0), snap("y", 0), snap("y", 5, cap=99)])
    cur = {r.station_id: r.capacity for r in v if r.is_current}
    assert cur == {"x": 10, "y": 99}


def test_surrogate_keys_unique(spark):
    v = versions(spark, [snap("x", d, cap=10 + d) for d in range(5)])
    assert len({r.station_sk for r in v}) == 5


def test_hot_key_split_matches_single_window(spark):
    from ridelake.operators.scd import scd2
    from ridelake.plans.models import TRACKED_STATION_ATTRS
    import random
    rnd = random.Random(7)
    rows = []
    for sid, n in (("hot", 400), ("warm", 60), ("cold", 5)):
        for d in range(n):
            rows.append(snap(sid, d, name=rnd.choice(["N", "N", None, "M"]),
                             cap=rnd.choice([10, 10, 20, None]), lat=rnd.choice([1.0, 1.0, 2.0])))
    df = spark.createDataFrame(rows, COLS)
    args = (df, "station_id", TRACKED_STATION_ATTRS, "extracted_at")
    one = scd2(*args, hot_key_rows=None)
    for hk, ch in ((50, 7), (0, 3)):
        split = scd2(*args, hot_key_rows=hk, max_chunks=ch)
        assert one.exceptAll(split).count() == 0 and split.exceptAll(one).count() == 0
