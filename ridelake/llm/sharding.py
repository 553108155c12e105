"""Operator 8: shards of near-equal bytes by longest-processing-time scheduling.

Rows of equal text are a group that stays together. Groups, largest first, go to the
least-loaded shard through a heap. Groups of one size are interchangeable, so the heap
is fed with (size, number of groups) and gives back how many groups of that size each
shard gets; a group's rank within its size says which shard it is. The schedule is
that of one heap over all groups, whatever their number: what reaches the driver is one
row for each distinct size, and as distinct sizes add up to no more than all bytes, there
are at most ``sqrt(2 * all bytes)`` of them (14 million for 100 TB; texts have far fewer).

Ranks and slots (a row's place in its shard) are running counts over range-dealt slices
(:func:`~ridelake.llm.common.running_total`), so neither a size that a third of all groups
have nor a shard is ever in one task.

Defined results: null text is in one group with empty text (size 1); repeated
rows are separate rows of one group; rows that tie in order are equal in
every column, so which takes which slot cannot be seen; an empty table gives
no rows. A group heavier than a shard's fair share fills a shard alone.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterable, Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ridelake.llm.common import materialize, running_total


def longest_first(items: list[tuple[int, object]], shards: int) -> dict[object, int]:
    """Shard of each (size, name): by falling size, each to the least-loaded shard."""
    heap = [(0, s) for s in range(shards)]
    placed = {}
    for size, name in sorted(items, key=lambda x: (-x[0], x[1])):
        load, shard = heapq.heappop(heap)
        placed[name] = shard
        heapq.heappush(heap, (load + size, shard))
    return placed


def longest_first_counts(sizes: Iterable[tuple[int, int]], shards: int) -> Iterator[tuple[int, list[int]]]:
    """For (size, number of items) by falling size: how many of them each shard gets when one
    after the other goes to the least-loaded shard (of equal ones the first)."""
    heap = [(0, s) for s in range(shards)]
    for size, left in sizes:
        given = [0] * shards
        while left:
            load, shard = heapq.heappop(heap)
            if max(heap, default=(load, shard))[0] - load < size:
                # all within one size: every round gives each shard one
                rounds = left // shards
                if rounds:
                    given = [g + rounds for g in given]
                    heap = [(x + rounds * size, s) for x, s in [*heap, (load, shard)]]
                    heapq.heapify(heap)
                    left -= rounds * shards
                    continue
                n = 1
            else:  # the least-loaded one takes items until another is less loaded
                other, first = heap[0]
                n = min(left, max(1, -(-(other - load + (shard < first)) // size)))
            given[shard] += n
            left -= n
            heapq.heappush(heap, (load + n * size, shard))
        yield size, given


def shard_documents(docs: DataFrame, shards: int = 16) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard of every row."""
    spark = docs.sparkSession
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    sized = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(text).cast("long") + 1).alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.substring(F.unhex(F.sha2(text, 256)), 1, 16).alias("group"))
    sized = materialize(sized, "shard-sizes")
    groups = sized.groupBy("group").agg(F.sum("size").alias("bytes")).withColumn("one", F.lit(1))
    ranked = running_total(groups, ["bytes", "group"], "one", "shard-groups", ["bytes"])

    # one row a distinct size, largest first
    sizes = ranked.groupBy("bytes").agg(F.count("*").alias("n")).orderBy(F.desc("bytes")).toLocalIterator()
    cuts = []
    for size, given in longest_first_counts(((r["bytes"], r["n"]) for r in sizes), shards):
        upto = 0
        for shard, n in enumerate(given):
            if n:
                cuts.append((size, upto, upto + n, shard))
                upto += n
    places = spark.createDataFrame(cuts, "bytes long, low long, high long, shard int").groupBy("bytes").agg(
        F.array_sort(F.collect_list(F.struct("high", "low", "shard"))).alias("cuts"))  # a size has at most ``shards``
    own = F.filter("cuts", lambda c: (c["low"] <= F.col("before")) & (F.col("before") < c["high"]))[0]["shard"]
    placed = ranked.join(places, "bytes").select("group", own.alias("shard"))
    dealt = sized.join(placed, "group").withColumn("one", F.lit(1))
    numbered = running_total(dealt, ["shard", "doc_id", "group"], "one", "shard-slots", ["shard"])
    return numbered.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
                           F.col("before").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
