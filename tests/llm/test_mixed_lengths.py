"""Vectors of several lengths in one table: each is searched among its own."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from ridelake.llm import neighbours


@pytest.mark.parametrize("group_vectors", [8192, 40])
def test_every_length_is_searched_among_its_own(spark, group_vectors):
    rng = np.random.default_rng(1)
    rows = [(i, rng.standard_normal((32, 32, 32, 8, 80)[i % 5]).tolist()) for i in range(500)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {}
    for r in neighbours.nearest(df, F.col("vec_id") % 7 == 0, 3, group_vectors=group_vectors).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id))
    own, hit = dict(rows), 0
    assert set(got) == set(range(0, 500, 7))
    for q, near in got.items():
        ids = np.array([i for i, v in rows if len(v) == len(own[q]) and i != q])
        s = neighbours.cosines(np.array(own[q]), np.array([own[i] for i in ids]))
        want = ids[np.lexsort((ids, -s))][:3].tolist()
        mine = [v for _, v in sorted(near)]
        assert len(mine) == 3 and all(len(own[v]) == len(own[q]) for v in mine)
        hit += len(set(mine) & set(want))
    assert hit >= 0.95 * 3 * len(got)
