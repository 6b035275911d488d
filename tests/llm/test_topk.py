"""Top-k against all inner products."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from drawlake.llm import topk


def vectors(spark, rows):
    raw = spark.createDataFrame(rows, "vec_id long, embedding array<float>, part string, rank string")
    return raw.select(F.col("vec_id").alias("id"), topk.integer_vector(F.col("embedding")).alias("vector"), "part", "rank")


def brute(rows, queries, k):
    ints = [(i, [math.floor(256 * float(np.float32(x))) for x in v]) for i, v, *_ in rows
            if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q, a in {i: v for i, v in ints if i in queries}.items():
        scored = sorted((-sum(x * y for x, y in zip(a, b)), i) for i, b in ints if i != q)[:k]
        out += [(q, r, i, -s) for r, (s, i) in enumerate(scored, 1)]
    return sorted(out)


def check(spark, rows, queries, k=5):
    v = vectors(spark, [(*r, "x", "y") for r in rows])
    got = topk.top_k(v, v.where(F.col("id").isin(list(queries))), k).collect()
    assert sorted((r.query_id, r.rank, r.vec_id, r.score) for r in got) == brute(rows, queries, k)


@pytest.mark.parametrize("block,group", [(256, 512), (3, 2)])
def test_equals_brute_force(spark, monkeypatch, block, group):
    monkeypatch.setattr(topk, "BLOCK", block)
    monkeypatch.setattr(topk, "SUPER", 4)
    monkeypatch.setattr(topk, "QUERY_GROUP", group)
    rng = np.random.default_rng(0)
    rows = [(k, [float(x) for x in rng.normal(size=8) * 0.3]) for k in range(200)]
    rows += [(200 + k, rows[7][1]) for k in range(20)]  # ties
    check(spark, rows, set(range(0, 220, 10)))


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [0.5, -0.5]), (1, None), (2, [nan, 1.0]), (3, [inf, 1.0]), (4, [None, 1.0]), (5, []), (6, [1.0]),
            (None, [1.0, 1.0]), (7, [0.001, -0.001]), (8, [2.0, 2.0, 2.0]), (8, [2.0, 2.0, 2.0])]
    check(spark, rows, {0, 5, 7})
    check(spark, [(0, [1.0])], {0})
    assert topk.top_k(*[vectors(spark, [])] * 2).count() == 0


def test_large_components_stay_exact(spark):
    rows = [(k, [1.0e5 + k, -1.0e5]) for k in range(6)]
    check(spark, rows, {0, 3})
