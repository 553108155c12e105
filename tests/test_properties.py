"""Operators against brute-force Python implementations on random inputs."""
from datetime import datetime, timedelta

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from ridelake.operators.dedup import dedup_priority
from ridelake.operators.joins import enrich_as_of
from ridelake.operators.scd import scd2
from pyspark.sql import functions as F

T0 = datetime(2024, 1, 1)
SETTINGS = settings(max_examples=12, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])

maybe = lambda s: st.one_of(st.none(), s)


@SETTINGS
@given(st.lists(st.tuples(st.sampled_from(["a", "b", "c", None]), st.integers(0, 2),
                          maybe(st.integers(0, 5)), st.integers(0, 1000)),
                min_size=1, max_size=30, unique_by=lambda r: r[3]))
def test_dedup_priority_brute_force(spark, rows):
    df = spark.createDataFrame(rows, "k string, prio int, rec int, id int")
    got = {r.k: r.id for r in dedup_priority(df, ["k"], F.col("prio"), "rec",
                                             tiebreak=[F.col("id").asc()]).collect()}
    want = {}
    for k in {r[0] for r in rows}:
        grp = [r for r in rows if r[0] == k]
        # prio asc, recency desc with NULL last, then id asc
        grp.sort(key=lambda r: (r[1], r[2] is None, -(r[2] or 0), r[3]))
        want[k] = grp[0][3]
    assert got == want


def brute_scd(rows, tracked_idx):
    """rows: (key, day, attrs...) -> list of (key, day_from, day_to or None, attrs)."""
    out = []
    for k in {r[0] for r in rows}:
        hist = sorted([r for r in rows if r[0] == k], key=lambda r: r[1])
        kept, prev = [], None
        for r in hist:
            if prev is None or prev[tracked_idx[0]] is None:
                change = True
            else:
                change = any(r[i] is not None and prev[i] is not None and r[i] != prev[i]
                             for i in tracked_idx)
            if change:
                kept.append(r)
            prev = r
        for i, r in enumerate(kept):
            nxt = kept[i + 1][1] if i + 1 < len(kept) else None
            out.append((k, r[1], nxt, r[2], r[3]))
    return sorted(out, key=repr)


@SETTINGS
@given(st.lists(st.tuples(st.sampled_from(["x", "y", None]), st.integers(0, 60),
                          maybe(st.sampled_from(["N", "M"])), maybe(st.sampled_from([10, 20]))),
                min_size=1, max_size=40, unique_by=lambda r: (r[0], r[1])),
       st.sampled_from([None, 0, 5]))
def test_scd2_brute_force(spark, rows, hot):
    df = spark.createDataFrame([(k, T0 + timedelta(days=d), n, c) for k, d, n, c in rows],
                               "k string, ts timestamp_ntz, name string, cap int")
    res = scd2(df, "k", ["name", "cap"], "ts", hot_key_rows=hot, max_chunks=3).collect()
    got = sorted([(r.k, (r.valid_from - T0).days,
                   None if r.is_current else (r.valid_to - T0).days, r.name, r.cap) for r in res],
                 key=repr)
    assert got == brute_scd(rows, [2, 3])


@SETTINGS
@given(st.lists(st.tuples(st.sampled_from(["A", "B"]), st.integers(0, 90)), min_size=1,
                max_size=6, unique_by=lambda r: r),
       st.lists(st.tuples(st.sampled_from(["A", "B", None]), maybe(st.integers(-5, 100))),
                min_size=1, max_size=25),
       st.sampled_from([None, "month", "day"]))
def test_as_of_brute_force(spark, versions, facts, bucket):
    open_end = datetime(9999, 12, 31, 23, 59, 59)
    vrows = []
    for k in {v[0] for v in versions}:
        starts = sorted(d for kk, d in versions if kk == k)
        for i, d in enumerate(starts):
            end = T0 + timedelta(days=starts[i + 1]) if i + 1 < len(starts) else open_end
            vrows.append((k, f"{k}{d}", T0 + timedelta(days=d), end))
    dim = spark.createDataFrame(vrows, "code string, label string, valid_from timestamp_ntz, valid_to timestamp_ntz")
    frows = [(i, k, None if d is None else T0 + timedelta(days=d, hours=6)) for i, (k, d) in enumerate(facts)]
    fdf = spark.createDataFrame(frows, "id int, code string, ts timestamp_ntz")
    got = {r.id: r.label for r in enrich_as_of(fdf, dim, "code", "code", "ts", {"label": "label"},
                                               time_bucket=bucket).collect()}
    want = {}
    for i, k, ts in frows:
        m = [v[1] for v in vrows if k is not None and ts is not None and v[0] == k and v[2] <= ts < v[3]]
        assert len(m) <= 1
        want[i] = m[0] if m else None
    assert got == want


def brute_enrich(trips, cur):
    """The four LEFT JOINs + coalesces, literally (row multiset)."""
    out = []
    for t in trips:
        (rid, sid, sname, slat, slng, eid, ename, elat, elng) = t

        def matches(pred):
            m = [d for d in cur if pred(d)]
            return m or [None]

        rows = []
        for a in matches(lambda d: sid is not None and d[1] == sid):
            for b in matches(lambda d: eid is not None and d[1] == eid):
                for c in matches(lambda d: sid is None and sname is not None and d[0] == sname):
                    for e in matches(lambda d: eid is None and ename is not None and d[0] == ename):
                        def co(own, *ds_idx):
                            if own is not None:
                                return own
                            for d, i in ds_idx:
                                if d is not None and d[i] is not None:
                                    return d[i]
                            return None
                        rows.append((rid, co(sid, (a, 1), (c, 1)), co(sname, (a, 0), (c, 0)),
                                     co(slat, (a, 2), (c, 2)), co(slng, (a, 3), (c, 3)),
                                     co(eid, (b, 1), (e, 1)), co(ename, (b, 0), (e, 0)),
                                     co(elat, (b, 2), (e, 2)), co(elng, (b, 3), (e, 3))))
        out += rows
    return sorted(out, key=repr)


names = st.sampled_from(["Alpha", "Beta", "Gamma", None])
codes = st.sampled_from(["A1", "B1", "C1", None])


@SETTINGS
@given(st.lists(st.tuples(names, codes, maybe(st.sampled_from([1.0, 2.0])),
                          maybe(st.sampled_from([3.0, 4.0]))), min_size=0, max_size=5),
       st.lists(st.tuples(codes, names, maybe(st.just(9.0)), codes, names, maybe(st.just(8.0))),
                min_size=1, max_size=12),
       st.sampled_from(["auto", "shuffle"]))
def test_enrich_current_brute_force(spark, cur, trips, strategy):
    from ridelake.operators.joins import enrich_current
    dim_rows = [(f"u{i}", n, c, lat, lon, T0, datetime(9999, 12, 31, 23, 59, 59), True)
                for i, (n, c, lat, lon) in enumerate(cur)]
    dim = spark.createDataFrame(dim_rows, "station_id string, station_name string, short_name string, "
                                "lat double, lon double, valid_from timestamp_ntz, "
                                "valid_to timestamp_ntz, is_current boolean")
    trip_rows = [(f"t{i}", sid, sname, lat, lat, eid, ename, elat, elat)
                 for i, (sid, sname, lat, eid, ename, elat) in enumerate(trips)]
    tdf = spark.createDataFrame(trip_rows, "ride_id string, start_station_id string, "
                                "start_station_name string, start_lat double, start_lng double, "
                                "end_station_id string, end_station_name string, end_lat double, "
                                "end_lng double")
    got = sorted([tuple(r) for r in enrich_current(tdf, dim, strategy=strategy).collect()], key=repr)
    assert got == brute_enrich(trip_rows, [(n, c, lat, lon) for n, c, lat, lon in cur])


@SETTINGS
@given(st.lists(st.tuples(st.sampled_from(["A", "B"]), st.integers(0, 90)), min_size=1,
                max_size=8, unique_by=lambda r: r),
       st.lists(st.tuples(st.sampled_from(["A", "B", None]), maybe(st.integers(-5, 100))),
                min_size=1, max_size=25),
       st.sampled_from([24, 1, 7]))
def test_sorted_as_of_brute_force(spark, versions, facts, hours):
    """``hours``: how many hours apart versions and facts are, so that several meet in one or none do."""
    from ridelake.operators.asof import asof_join_sorted
    open_end = datetime(9999, 12, 31, 23, 59, 59)
    vrows = []
    for k in {v[0] for v in versions}:
        starts = sorted(d for kk, d in versions if kk == k)
        for i, d in enumerate(starts):
            end = T0 + timedelta(minutes=hours * 60 * starts[i + 1] // 7) if i + 1 < len(starts) else open_end
            vrows.append((k, f"{k}{d}", T0 + timedelta(minutes=hours * 60 * d // 7), end))
    dim = spark.createDataFrame(vrows, "code string, label string, valid_from timestamp_ntz, valid_to timestamp_ntz")
    frows = [(i, k, None if d is None else T0 + timedelta(minutes=hours * 60 * d // 7 + (i % 3) * 20))
             for i, (k, d) in enumerate(facts)]
    fdf = spark.createDataFrame(frows, "id int, code string, ts timestamp_ntz")
    out = asof_join_sorted(fdf, dim, "code", "ts", "code", {"label": "label"}).collect()
    got = {r.id: r.label for r in out}
    assert len(out) == len(frows)
    want = {}
    for i, k, ts in frows:
        m = [v[1] for v in vrows if k is not None and ts is not None and v[0] == k and v[2] <= ts < v[3]]
        want[i] = m[0] if m else None
    assert got == want


@SETTINGS
@given(st.lists(st.tuples(st.sampled_from(["u1", "u2", None]), maybe(st.integers(0, 5)),
                          st.integers(0, 3), st.integers(0, 3)), min_size=1, max_size=25))
def test_latest_state_brute_force(spark, rows):
    from ridelake.streaming.status import latest_status_state
    df = spark.createDataFrame([(s, None if d is None else T0 + timedelta(hours=d), a, b)
                                for s, d, a, b in rows],
                               "station_id string, ingestion_at timestamp_ntz, bikes long, docks long")
    got = {r.station_id: (r.ingestion_at, r.bikes, r.docks) for r in latest_status_state(df).collect()}
    want = {}
    for s in {r[0] for r in rows}:
        grp = [(None if d is None else T0 + timedelta(hours=d), a, b) for ss, d, a, b in rows if ss == s]
        # ORDER BY ts DESC NULLS LAST, bikes DESC, docks DESC
        grp.sort(key=lambda g: (g[0] is not None, g[0] or T0, g[1], g[2]), reverse=True)
        want[s] = grp[0]
    assert got == want


@SETTINGS
@given(st.lists(st.sampled_from(["a", "b", "c", None]), min_size=1, max_size=40))
def test_distribution_brute_force(spark, values):
    from ridelake.operators.rollup import distribution
    df = spark.createDataFrame([(v,) for v in values], "v string")
    got = {r.v: (r.n, r.pct) for r in distribution(df, "v").collect()}
    from decimal import ROUND_HALF_UP, Decimal
    total = len(values)

    def half_up(x):  # Spark rounds the double's decimal text half-up
        return float(Decimal(repr(x)).quantize(Decimal("0.01"), rounding=ROUND_HALF_UP))

    want = {v: (values.count(v), half_up(values.count(v) * 100.0 / total)) for v in set(values)}
    assert got == want
    tie = spark.createDataFrame([("a",)] + [("b",)] * 31, "v string")   # 1/32 = 3.125 %
    assert {r.v: r.pct for r in distribution(tie, "v").collect()}["a"] == 3.13


@SETTINGS
@given(st.lists(st.tuples(st.sampled_from(["a", "b", None]), st.sampled_from([1, 2, None])),
                min_size=1, max_size=30),
       st.lists(st.sampled_from(["a", "c", None]), min_size=0, max_size=5))
def test_key_checks_brute_force(spark, rows, parent_keys):
    from collections import Counter

    from ridelake.operators.quality import relationships, unique, unique_combination
    df = spark.createDataFrame(rows, "k string, j int")
    parent = spark.createDataFrame([(p,) for p in parent_keys] or [(None,)], "p string")
    ks = Counter(r[0] for r in rows if r[0] is not None)
    assert unique(df, "m", "k").first().failures == sum(1 for c in ks.values() if c > 1)
    combos = Counter(rows)
    assert unique_combination(df, "m", ["k", "j"]).first().failures == \
        sum(1 for c in combos.values() if c > 1)
    parents = {p for p in parent_keys if p is not None}
    assert relationships(df, "m", "k", parent, "p").first().failures == \
        sum(1 for r in rows if r[0] is not None and r[0] not in parents)


@SETTINGS
@given(st.lists(st.tuples(maybe(st.sampled_from(["r1", "r2"])), st.sampled_from(["S1", "S2", None]),
                          maybe(st.integers(-10, 100)), st.sampled_from(["valid", "zero_duration"])),
                min_size=1, max_size=30))
def test_hourly_rollup_brute_force(spark, rows):
    from datetime import date
    from ridelake.plans.models import HOURLY_KEYS, hourly_traffic
    cols = ("started_date date, started_hour int, started_day_name string, is_weekend boolean, "
            "time_of_day string, start_station_id string, start_station_name string, "
            "member_casual string, rideable_type string, ride_id string, "
            "trip_duration_seconds long, data_quality_flag string")
    data = [(date(2024, 1, 2), 8, "Tuesday", False, "Morning", sid, "N", "member", "classic_bike",
             rid, dur, flag) for rid, sid, dur, flag in rows]
    got = {r.start_station_id: (r.total_trips, r.total_trip_duration_seconds,
                                r.avg_trip_duration_seconds, r.valid_trips_count, r.flagged_trips_count)
           for r in hourly_traffic(spark.createDataFrame(data, cols)).collect()}
    want = {}
    for sid in {r[1] for r in rows if r[1] is not None}:
        g = [r for r in rows if r[1] == sid]
        n = sum(1 for r in g if r[0] is not None)
        durs = [r[2] for r in g if r[2] is not None]
        total = sum(durs) if durs else None
        want[sid] = (n, total, (total / n) if (total is not None and n) else None,
                     sum(1 for r in g if r[3] == "valid"), sum(1 for r in g if r[3] != "valid"))
    assert got == want
    assert len(HOURLY_KEYS) == 9


@SETTINGS
@given(st.lists(st.tuples(st.datetimes(min_value=datetime(2021, 3, 13), max_value=datetime(2021, 3, 15)),
                          st.integers(-100_000_000, 200_000_000)), min_size=1, max_size=20))
def test_time_dims_brute_force_any_zone(spark, rows):
    """Around a daylight-saving change, under a New York session zone."""
    from decimal import ROUND_HALF_UP, Decimal
    from ridelake.plans.models import add_time_dims
    from ridelake.schemas import TRIPS_RAW_COLUMNS
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        recs = []
        for i, (start, micros) in enumerate(rows):
            end = start + timedelta(microseconds=micros)
            rec = {c: None for c in TRIPS_RAW_COLUMNS}
            rec.update(ride_id=f"r{i}", started_at=start, ended_at=end)
            recs.append(tuple(rec[c] for c in TRIPS_RAW_COLUMNS))
        schema = ", ".join(f"{c} {'timestamp_ntz' if c in ('ingestion_at', 'started_at', 'ended_at') else 'double' if c.endswith(('_lat', '_lng')) else 'string'}"
                           for c in TRIPS_RAW_COLUMNS)
        got = {r.ride_id: r for r in add_time_dims(spark.createDataFrame(recs, schema)).collect()}
        bands = [(0, 5, "Late Night"), (6, 10, "Morning"), (11, 15, "Afternoon"), (16, 18, "Evening")]
        for i, (start, micros) in enumerate(rows):
            r = got[f"r{i}"]
            secs = int(micros / 1_000_000) if micros >= 0 else -int(-micros / 1_000_000)
            assert r.trip_duration_seconds == secs
            mins = float((Decimal(secs) / Decimal(60)).quantize(Decimal("0.01"), rounding=ROUND_HALF_UP))
            assert r.trip_duration_minutes == mins
            assert r.started_hour == start.hour and r.started_date == start.date()
            assert r.started_day_name == start.strftime("%A")
            assert r.is_weekend == (start.weekday() >= 5)
            assert r.time_of_day == next((lab for lo, hi, lab in bands if lo <= start.hour <= hi), "Night")
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


@SETTINGS
@given(st.lists(st.tuples(st.sampled_from(["u1", "u2", "u3"]), st.integers(0, 50), st.integers(0, 2),
                          st.integers(0, 2)), min_size=1, max_size=12, unique_by=lambda r: (r[0], r[1])),
       st.lists(st.tuples(st.sampled_from(["S1", "S2", "S9"]), st.sampled_from([11, 12]),
                          st.sampled_from(["Tuesday", "Monday"]), st.integers(0, 5)),
                min_size=0, max_size=15))
def test_demand_vs_supply_brute_force(spark, status, hourly):
    from ridelake.plans.models import demand_vs_supply, status_current
    open_end = datetime(9999, 12, 31, 23, 59, 59)
    dim_rows = [("u1", "One", "S1", 1.0, 1.0, T0, open_end, True),
                ("u2", "Two", "S2", 2.0, 2.0, T0, open_end, True)]   # u3 has no station version
    dim = spark.createDataFrame(dim_rows, "station_id string, station_name string, short_name string, "
                                "lat double, lon double, valid_from timestamp_ntz, "
                                "valid_to timestamp_ntz, is_current boolean")
    stg = spark.createDataFrame(
        [(T0 + timedelta(minutes=m), T0, sid, bikes, 0, docks, 0, 1, 1, 1, T0, 0, 0, 0)
         for sid, m, bikes, docks in status],
        "ingestion_at timestamp_ntz, feed_last_updated timestamp_ntz, station_id string, "
        "num_bikes_available long, num_bikes_disabled long, num_docks_available long, "
        "num_docks_disabled long, is_installed long, is_renting long, is_returning long, "
        "last_reported timestamp_ntz, num_ebikes_available long, num_scooters_available long, "
        "num_scooters_unavailable long")
    hdf = spark.createDataFrame([(code, h, day, n) for code, h, day, n in hourly] or [("S0", 0, "x", 0)],
                                "start_station_id string, started_hour int, started_day_name string, "
                                "total_trips long")
    out = demand_vs_supply(status_current(stg, dim), hdf, dim, "2024-01-30 12:00:00")
    got = {r.station_id: (r.num_bikes_available, r.num_docks_available, r.avg_historical_trips,
                          r.supply_status, r.current_hour, r.current_day_name) for r in out.collect()}
    codes = {"u1": "S1", "u2": "S2"}
    want = {}
    for sid in {s[0] for s in status}:
        latest = max((s for s in status if s[0] == sid), key=lambda s: s[1])
        cells = [n for code, h, day, n in hourly if code == codes.get(sid) and h == 12 and day == "Tuesday"]
        avg = sum(cells) / len(cells) if cells else None
        label = ("empty" if latest[2] == 0 else "full" if latest[3] == 0
                 else "no_historical_data" if avg is None else "normal")
        want[sid] = (latest[2], latest[3], avg, label, 12, "Tuesday")
    assert got == want
