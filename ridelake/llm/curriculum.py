"""Operator 12: mixing sources to target weights along a time-varying curriculum.

Every source has a weight schedule over the training time from 0 to 1: its weight
times a shape, linear between knots. The schedule's integral is the source's share of
the words to be trained on (``percent`` of all there are). A target stops at ``most``
times its source's words; what is above is shared among the other sources by weight
until none is above (the level, words for one unit of weight, is found in rounds of one
grouped sum; a round's sums are all that reaches the driver).

Inside a source the documents follow each other in the order of a hash; ``most``
passes over them in a row are its supply. A copy's first word, counted from the start
of the supply, is the source's demand at some time: that time, the inverse of the
schedule's integral there, is the copy's training position. Copies that begin behind the
target aren't taken, and the one that crosses it is cut there, so that each source
gives its target to the word. The copies are sorted by range of position.

Running sums (words before a document, place in the training order, rank of a source)
are taken slice by slice of a range-sorted table, so neither a source with a third of all
rows nor the whole order is ever in one task.

Defined results: null texts have no words; sizes of 0 are never taken but reported;
a null source is a source, last in order; repeated rows are separate documents, each
taken on its own; where ids and sizes tie, rows are alike in all that is returned;
an empty table, or one without a word, takes nothing; extra columns are not read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ridelake.llm.common import materialize, running_total

WEIGHTS = (5.0, 2.0, 1.0)  # of the sources in order, repeating
# factor of a source's weight over time, repeating: heavy sources fade, light ones come
SHAPES = (((0.0, 1.5), (1.0, 0.5)), ((0.0, 1.0), (1.0, 1.0)), ((0.0, 0.5), (1.0, 1.5)))
PERCENT = 150
MOST = 2
SEED = "curriculum"
WORD = r"[^\x20\x09-\x0D]+"


def integral(shape: tuple[tuple[float, float], ...]) -> float:
    return sum((t1 - t0) * (a + b) / 2 for (t0, a), (t1, b) in zip(shape, shape[1:]))


def check_shape(shape: tuple[tuple[float, float], ...]) -> None:
    times, factors = [t for t, _ in shape], [f for _, f in shape]
    if times[0] != 0 or times[-1] != 1 or any(b <= a for a, b in zip(times, times[1:])) or min(factors) < 0 or not integral(shape) > 0:
        raise ValueError("a shape's knots go from time 0 to 1, with factors of 0 or more and an integral above 0")


def position_of(shape: tuple[tuple[float, float], ...], share: Column) -> Column:
    """The time at which the shape's integral reaches ``share`` (0 to 1) of its whole."""
    demand = share * F.lit(integral(shape))
    found, before = None, 0.0
    pieces = list(zip(shape, shape[1:]))
    for k, ((t0, a), (t1, b)) in enumerate(pieces):
        own = (t1 - t0) * (a + b) / 2
        rest = F.greatest(demand - F.lit(before), F.lit(0.0))
        slope = (b - a) / (t1 - t0)
        # a x + slope x^2 / 2 = rest, in the form that loses no digits
        root = F.lit(a) + F.sqrt(F.greatest(F.lit(a * a) + F.lit(2 * slope) * rest, F.lit(0.0)))
        time = F.lit(t0) + F.when(root > 0, rest * F.lit(2.0) / F.nullif(root, F.lit(0.0))).otherwise(F.lit(0.0))
        before += own
        # a stretch without demand is never waited in: the next one begins at its end
        here = demand < F.lit(before) if k < len(pieces) - 1 else F.lit(True)
        found = F.when(here, time) if found is None else found.when(here, time)
    return found


def by_turn(values, turn: str, make) -> Column:
    """``make(value)`` of the value whose turn it is."""
    found = None
    for i, v in enumerate(values):
        here = F.col(turn) % len(values) == i
        found = F.when(here, make(v)) if found is None else found.when(here, make(v))
    return found


def level_of(sources: DataFrame, total: int, percent: float, most: int) -> float:
    """Words for a unit of weight, so that min(level * weight, most * words) sums to the mix."""
    cap = F.col("source_size") * most
    want = total * percent / 100
    level, before = math.inf, -1
    while True:
        above = cap <= F.lit(level) * F.col("weight") if before >= 0 else F.lit(False)
        capped, n, weight = sources.agg(F.sum(F.when(above, cap).otherwise(0)), F.count(F.when(above, 1)),
                                        F.sum(F.when(above, 0.0).otherwise(F.col("weight")))).first()
        if n == before or not weight:
            return level if n == before else math.inf
        level, before = (want - capped) / weight, n


def targets(sized: DataFrame, weights=WEIGHTS, shapes=SHAPES, percent: float = PERCENT, most: int = MOST) -> DataFrame:
    """(source, turn, source_size, target) of every source of (source, size) rows."""
    sums = sized.groupBy("source").agg(F.sum("size").alias("source_size")).select(
        F.col("source").isNull().alias("last"), "source", "source_size", F.lit(1).alias("one"))
    # order by code point, null last
    ranked = running_total(sums, ["last", "source"], "one", "mix-sources").withColumnRenamed("before", "turn")
    weight = by_turn(weights, "turn", F.lit) * by_turn([integral(s) for s in shapes], "turn", F.lit)
    ranked = materialize(ranked.select("source", "turn", "source_size", weight.alias("weight")), "mix-weights")
    total = ranked.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0]
    level = level_of(ranked, total, percent, most) if total else 0.0
    return ranked.select("source", "turn", "source_size", F.least(
        (F.col("source_size") * most).cast("double"), F.col("weight") * F.lit(float(level))).alias("target"))


def training_order(docs: DataFrame, weights=WEIGHTS, shapes=SHAPES, percent: float = PERCENT, most: int = MOST,
                   seed: str = SEED) -> DataFrame:
    """One row a copy, in the order of training: row, doc_id, source, size, source_size, target,
    copy (from 0), words (taken of it), position (0 to 1), place (from 0). Documents of which
    nothing is taken have one row with 0 words, without position, behind all others. ``row``
    numbers the rows of ``docs``."""
    for s in shapes:
        check_shape(s)
    own = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"),
        F.coalesce(F.regexp_count(F.col("text").cast("string"), F.lit(WORD)), F.lit(0)).cast("long").alias("size"))
    mark = F.md5(F.concat(F.lit(seed), F.lit(":"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))))
    sized = materialize(own.withColumn("mark", mark).withColumn("row", F.monotonically_increasing_id()), "mix-sizes")
    aimed = targets(sized, weights, shapes, percent, most)
    joined = sized.join(aimed, sized["source"].eqNullSafe(aimed["source"])).drop(aimed["source"])
    supplied = running_total(joined, ["turn", "mark", "doc_id", "size", "row"], "size", "mix-supply", ["turn"])

    goal = F.floor(F.col("target") + F.lit(0.5)).cast("long")
    copies = (supplied.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(most - 1))))
              .withColumn("start", F.col("copy") * F.col("source_size") + F.col("before"))
              .withColumn("words", F.greatest(F.least(F.col("size"), goal - F.col("start")), F.lit(0)))
              .filter((F.col("words") > 0) | (F.col("copy") == 0)))
    share = F.col("start").cast("double") / F.nullif(F.col("target"), F.lit(0.0))
    position = F.when(F.col("words") > 0, by_turn(shapes, "turn", lambda s: position_of(s, share)))
    placed = copies.select("row", "doc_id", "source", "size", "source_size", "target", "copy", "words",
                           position.alias("position"), (F.col("words") == 0).alias("left_out"), "turn", "start", F.lit(1).alias("one"))
    order = ["left_out", "position", "turn", "start", "doc_id", "size", "row"]
    return running_total(placed, order, "one", "mix-order").select(
        "row", "doc_id", "source", "size", "source_size", "target", "copy", "words", "position", F.col("before").alias("place"))


def mix_report(docs: DataFrame, **options) -> DataFrame:
    """doc_id, size, source_size, target, taken, copies and first_place (-1: none) of every document."""
    taken = F.col("words") > 0
    return (training_order(docs, **options)
            .groupBy("row", "doc_id", "size", "source_size", "target")
            .agg(F.sum("words").alias("taken"), F.count(F.when(taken, 1)).alias("copies"),
                 F.coalesce(F.min(F.when(taken, F.col("place"))), F.lit(-1)).alias("first_place"))
            .drop("row"))
