"""Source mixing against a plain mix in Python, and the properties of targets and positions."""

import hashlib
import math
import re
from fractions import Fraction

import pytest

from ridelake.llm import curriculum

SF = "/root/testdata/sf0.001"


def plain_targets(sizes, weights=(5, 2, 1), percent=150, most=2):
    """Excess above the limit is shared anew by weight until none is above."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, capped = Fraction(sum(sizes.values()) * percent, 100), {}
    while True:
        free = [s for s in names if s not in capped]
        whole = sum(weight[s] for s in free)
        shares = {s: (left - sum(capped.values())) * weight[s] / Fraction(whole) for s in free}
        over = [s for s in free if shares[s] > most * sizes[s]]
        if not over:
            return {s: float(capped.get(s, shares.get(s))) for s in names}
        capped |= {s: Fraction(most * sizes[s]) for s in over}
        if len(capped) == len(names):
            return {s: float(capped[s]) for s in names}


def plain_mix(rows, most=2, **options):
    size = lambda t: len(re.findall("[^ \t-\r]+", t or ""))
    sizes = {}
    for _, source, text in rows:
        sizes[source] = sizes.get(source, 0) + size(text)
    aims, out = plain_targets(sizes, most=most, **options), []
    for source, total in sizes.items():
        supply = sorted((hashlib.md5(f"curriculum:{'null' if d is None else d}".encode()).hexdigest(), -1 if d is None else d, size(t))
                        for d, s, t in rows if s == source)
        goal, before = math.floor(aims[source] + 0.5), 0
        for _, d, n in supply:
            words = sum(max(0, min(n, goal - c * total - before)) for c in range(most))
            out.append((None if d == -1 else d, n, total, round(aims[source], 6), words))
            before += n
    return sorted(out, key=str)


def mixed(df, **options):
    return sorted(((r.doc_id, r.size, r.source_size, round(r.target, 6), r.taken) for r in curriculum.mix_report(df, **options).collect()), key=str)


ODD = [(1, "b", "one two three"), (1, "b", "one two three"), (2, None, None), (3, None, ""), (None, "a", "x " * 500),
       (None, "a", "x " * 500), (4, "é", "漢字   y"), (5, "zero", " \t\n\x0b "), (6, "\U0001f642", "a b c d"), (7, "￿", "a b"), (8, None, "u v w " * 3)]


def test_mix_is_that_of_a_plain_search(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert mixed(docs) == plain_mix([(r.doc_id, r.source, r.text) for r in docs.collect()])
    odd = spark.createDataFrame(ODD, "doc_id long, source string, text string").selectExpr(
        "*", "1 AS size", "2 AS row", "3 AS mark", "4 AS position", "5 AS turn", "6 AS slice")
    assert mixed(odd) == plain_mix(ODD)
    assert mixed(odd, percent=400) == plain_mix(ODD, percent=400)  # more than there is: all sources at their limit
    assert mixed(odd, most=3, percent=200) == plain_mix(ODD, most=3, percent=200)


def test_sources_meet_their_targets_and_reruns_agree(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "source", "text")
    got = curriculum.mix_report(docs).collect()
    by_target = {}
    for r in got:
        by_target.setdefault((r.source_size, r.target), []).append(r)
        assert 0 <= r.taken <= 2 * r.size
    for (_, target), rows in by_target.items():
        assert abs(sum(r.taken for r in rows) - target) <= 0.5
    again = curriculum.mix_report(docs.repartition(7)).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, again))


def test_order_follows_the_schedules(spark):
    """By any time a source has given its schedule's integral up to there, to a document."""
    rows = [(i, "abc"[i % 3], "w " * (1 + i % 7)) for i in range(900)]
    got = curriculum.training_order(spark.createDataFrame(rows, "doc_id long, source string, text string")).filter("words > 0").collect()
    assert sorted(r.place for r in got) == list(range(len(got)))
    got.sort(key=lambda r: r.place)
    assert [r.position for r in got] == sorted(r.position for r in got) and 0 <= got[0].position and got[-1].position <= 1
    for k, source in enumerate("abc"):
        a, b = curriculum.SHAPES[k][0][1], curriculum.SHAPES[k][1][1]
        own = [r for r in got if r.source == source]
        given = 0
        for r in own:
            t = r.position
            assert abs(own[0].target * (a * t + (b - a) * t * t / 2) - given) < 1e-6 * own[0].target
            given += r.words


@pytest.mark.parametrize("shape", [((0.0, 2.0), (0.25, 0.0), (0.75, 0.0), (1.0, 3.0)), ((0.0, 0.0), (1.0, 1.0)),
                                   ((0.0, 1.0), (0.5, 4.0), (1.0, 0.0)), ((0.0, 0.0), (0.5, 0.0), (1.0, 2.0))])
def test_positions_invert_any_integral(spark, shape):
    shares = [i / 200 for i in range(200)]
    df = spark.createDataFrame([(s,) for s in shares], "share double")
    from pyspark.sql import functions as F
    got = [r.t for r in df.select("share", curriculum.position_of(shape, F.col("share")).alias("t")).orderBy("share").collect()]
    for share, t in zip(shares, got, strict=True):
        done = 0.0
        for (t0, a), (t1, b) in zip(shape, shape[1:]):
            x = min(max(t - t0, 0.0), t1 - t0)
            done += a * x + (b - a) / (t1 - t0) * x * x / 2
        assert abs(done - share * curriculum.integral(shape)) < 1e-9
    assert got == sorted(got)


def test_bad_shapes_and_empty_tables(spark):
    for bad in (((0.0, 1.0),), ((0.0, 1.0), (0.5, 1.0)), ((0.0, -1.0), (1.0, 2.0)), ((0.0, 0.0), (1.0, 0.0))):
        with pytest.raises(ValueError):
            curriculum.check_shape(bad)
    empty = spark.createDataFrame([], "doc_id long, source string, text string")
    assert mixed(empty) == []
    wordless = spark.createDataFrame([(1, "a", None), (2, None, " ")], "doc_id long, source string, text string")
    assert mixed(wordless) == [(1, 0, 0, 0.0, 0), (2, 0, 0, 0.0, 0)]
