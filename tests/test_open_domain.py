"""Samples from a large domain, top values of an open domain, counts without a shuffle."""

import hashlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from drawlake.operators.frequency import top_values
from drawlake.operators.picks import sample_numbers
from drawlake.operators.reshape import indicator_counts
from drawlake.schemas import STAR
from tests.conftest import draws_df, random_draws


def floyd(seed, key, lo, hi, k):
    n, taken = hi - lo + 1, []
    for i in range(1, k + 1):
        newest = n - k + i
        drawn = int(hashlib.md5(f"{seed}:{key}:{i}".encode()).hexdigest()[:15], 16) % newest + 1
        taken.append(newest if drawn in taken else drawn)
    return sorted(x + lo - 1 for x in taken)


def test_samples(spark):
    ids = spark.range(300).select(F.when(F.col("id") > 0, F.col("id")).alias("id"))
    for lo, hi, k in ((1, 1_000_000_000_000, 6), (5, 9, 5), (-3, 2, 2), (1, 4, 0)):
        for r in sample_numbers(ids, "id", lo, hi, k, seed=7).collect():
            assert r.numbers == floyd(7, "null" if r.id is None else r.id, lo, hi, k)
            assert len(set(r.numbers)) == k and all(lo <= x <= hi for x in r.numbers)
    with pytest.raises(ValueError):
        sample_numbers(ids, "id", 1, 3, 4)


def test_every_set_is_equally_likely(spark):
    got = sample_numbers(spark.range(20_000), "id", 1, 6, 3).groupBy("numbers").count().collect()
    assert len(got) == 20 and sum((r["count"] - 1000) ** 2 / 1000 for r in got) < 43.8  # chi-square, 19 degrees, 0.001


def test_top_values(spark):
    data = [(g, v, c) for g in ("a", "b", None) for v, c in
            [(None, 4), (1, 4), (2, 9), (3, 4), (7, 1), (9, 2)][: 6 if g == "a" else 4 if g == "b" else 2]]
    counts = spark.createDataFrame(data, "g string, v int, frequency long").repartition(5)
    for n in (1, 3, 6):
        want, groups = [], defaultdict(list)
        for g, v, c in data:
            groups[g].append((-c, v is not None, v or 0, v))
        for g, cells in groups.items():
            cells.sort(key=lambda x: x[:3])
            total = -sum(c[0] for c in cells)
            want += [(g, None if c[3] is None else str(c[3]), False, -c[0], -c[0] * 100.0 / total) for c in cells[:n]]
            if cells[n:]:
                rest = -sum(c[0] for c in cells[n:])
                want.append((g, "Others", True, rest, rest * 100.0 / total))
        assert Counter(map(tuple, top_values(counts, "v", n, by=["g"]).collect())) == Counter(want)
    plain = top_values(counts.groupBy("v").agg(F.sum("frequency").alias("frequency")), "v", 1).collect()
    assert sorted(tuple(r)[:3] for r in plain) == [("2", False, 18), ("Others", True, 35)]
    assert top_values(counts.limit(0), "v", 3).collect() == top_values(counts.limit(0), "v", 3, by=["g"]).collect() == []


def test_ranks_are_limited_before_the_shuffle(spark):
    counts = spark.range(1000).select((F.col("id") % 3).alias("g"), F.col("id").alias("v"), F.lit(1).cast("long").alias("frequency"))
    plan = top_values(counts, "v", 5, by=["g"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2  # partial and final


def test_indicator_counts_of_unique_keys_need_no_shuffle(spark):
    draws = draws_df(spark, random_draws(30, null_every=5, repeat_every=4))
    alone, added = (indicator_counts(draws, "draw_number", STAR, unique_key=u) for u in (True, False))
    assert sorted(map(tuple, alone.collect())) == sorted(map(tuple, added.collect()))
    assert "Exchange" not in alone._jdf.queryExecution().executedPlan().toString()
