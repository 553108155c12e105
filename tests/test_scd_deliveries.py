"""A dimension fed by deliveries equals the one built from the whole history."""

import random
from datetime import datetime, timedelta

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from ridelake.operators.scd import scd2
from ridelake.operators.scd_deliveries import Dimension, deliver, read_dimension
from ridelake.sinks.writers import published_version

SCHEMA = "k string, a string, b int, note string, at timestamp_ntz"
T0 = datetime(2024, 1, 1)


def row(k, day, a="x", b=1, note="n"):
    return (k, a, b, note, T0 + timedelta(days=day))


def store(tmp_dir, **options):
    return Dimension(f"{tmp_dir}/store", "k", ["a", "b"], "at", **options)


def both(spark, dim, deliveries):
    for rows in deliveries:
        deliver(dim, spark.createDataFrame(rows, SCHEMA))
    whole = spark.createDataFrame([r for d in deliveries for r in d], SCHEMA)
    want = sorted(map(tuple, scd2(whole, "k", ["a", "b"], "at").collect()), key=str)
    got = sorted(map(tuple, read_dimension(spark, dim, whole.schema).collect()), key=str)
    return got, want


def test_versions_are_closed_and_opened(spark, tmp_dir):
    got, want = both(spark, store(tmp_dir), [
        [row("p", 0), row("q", 0)], [row("p", 5, b=2), row("r", 5)], [row("p", 6, b=2, note="later")], [row("q", 9, a="y"), row("p", 9, b=1)]])
    assert got == want and len(got) == 6


def test_nulls_are_compared_with_the_last_snapshot(spark, tmp_dir):
    """x -> NULL -> y opens no version; the last snapshot decides, not the version's first one."""
    got, want = both(spark, store(tmp_dir), [[row("p", 0, b=1)], [row("p", 1, b=None)], [row("p", 2, b=7)],
                                             [row("p", 3, a=None)], [row("p", 4)], [row(None, 0)], [row(None, 1, b=9)]])
    assert got == want


def test_late_snapshots_rebuild_only_their_keys(spark, tmp_dir):
    dim = store(tmp_dir)
    days = [[row("p", 0, b=1), row("q", 0, b=1)], [row("p", 10, b=2), row("q", 10, b=2)], [row("p", 5, b=3)],
            [row("p", 20, b=4), row("q", 20, b=1)], [row("p", 15, b=2), row("p", 20, b=4), row("q", 30, b=1)]]
    got, want = both(spark, dim, days)
    assert got == want
    rebuilt = {tuple(r) for r in spark.read.parquet(f"{dim.root}/rebuilt").select("run", "__k").collect()}
    assert rebuilt == {(2, "p"), (4, "p")}


def test_a_run_in_time_reads_only_heads_and_the_delivery(spark, tmp_dir):
    dim = store(tmp_dir)
    deliver(dim, spark.createDataFrame([row(f"k{i}", d, b=d) for i in range(20) for d in range(5)], SCHEMA))
    deliver(dim, spark.createDataFrame([row("k1", 9, b=9), row("new", 9)], SCHEMA))
    closed = spark.read.parquet(f"{dim.root}/closed/run=1").collect()
    assert [(r.k, r.b) for r in closed] == [("k1", 4)]  # nothing of the other keys' history is written again
    assert spark.read.parquet(f"{dim.root}/open/version=1").count() == 21


def test_a_failed_run_stays_invisible_and_is_repeated(spark, tmp_dir, monkeypatch):
    from ridelake.operators import scd_deliveries as D
    dim = store(tmp_dir)
    deliver(dim, spark.createDataFrame([row("p", 0), row("q", 0)], SCHEMA))
    second = spark.createDataFrame([row("p", 1, b=5), row("q", -1, b=8)], SCHEMA)
    before = sorted(map(tuple, read_dimension(spark, dim, second.schema).collect()))

    def broken(*_):
        raise OSError("lost")
    with monkeypatch.context() as m:
        m.setattr(D, "publish_version", broken)
        with pytest.raises(OSError):
            deliver(dim, second)
    assert published_version(spark, f"{dim.root}/open") == 0
    assert sorted(map(tuple, read_dimension(spark, dim, second.schema).collect())) == before
    assert deliver(dim, second) == 1
    whole = spark.createDataFrame([row("p", 0), row("q", 0), row("p", 1, b=5), row("q", -1, b=8)], SCHEMA)
    assert sorted(map(str, read_dimension(spark, dim, second.schema).collect())) == sorted(map(str, scd2(whole, "k", ["a", "b"], "at").collect()))


def test_hot_keys_in_a_delivery(spark, tmp_dir):
    rnd = random.Random(3)
    rows = [row("hot", i, b=rnd.randrange(3)) for i in range(300)] + [row("cold", i, b=i) for i in range(5)]
    rnd.shuffle(rows)
    got, want = both(spark, store(tmp_dir, hot_key_rows=40), [rows[:150], rows[150:290], rows[290:]])
    assert got == want


@settings(max_examples=3, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.lists(st.tuples(st.sampled_from(["p", "q", None]), st.integers(0, 8), st.sampled_from(["x", "y", None]),
                                   st.sampled_from([1, 2, None])), max_size=6), min_size=1, max_size=2))
def test_any_deliveries(spark, tmp_path_factory, deliveries):
    dim = store(str(tmp_path_factory.mktemp("any")))
    got, want = both(spark, dim, [[row(k, d, a, b) for k, d, a, b in rows] for rows in deliveries] + [[row("z", 0)]])
    assert got == want


def test_empty_deliveries(spark, tmp_dir):
    dim = store(tmp_dir)
    with pytest.raises(FileNotFoundError):
        read_dimension(spark, dim, spark.createDataFrame([], SCHEMA).schema)
    assert both(spark, dim, [[], [row("p", 0)], []])[0]
